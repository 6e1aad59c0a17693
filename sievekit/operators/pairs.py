"""Pair operators (G8-G14, G16) over a scored pair table.

The reference enumerates every unordered pair inside each group and then
looks the pairs up in a score table. Enumerating all pairs is quadratic in
the group size (groups of 15k members give 10^8 pairs), so here the work is
turned around: the score table is the input, each scored pair is checked for
group membership with two key lookups (K15), and the pairs nobody scored are
*counted* per group as n(n-1)/2 minus the scored ones (G9). No operator emits
all pairs of a group.

Near-duplicate removal (G13) is a pure map + distinct: per surviving pair the
smaller member is removed (ties and missing sizes remove the second member);
it never depends on earlier removals, so it is fully parallel. The
"already removed" diagnostic (G14) needs a total order of pairs:
(min_size nulls last, pair_id); it is computed with a per-member ``min``, one
join of the pairs' ends and a regroup instead of a global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.functions.columns import pair_key, pairs_in_group, row_min
from sievekit.functions.skew import MAX_HOT, null_safe_join, salted_lookup
from sievekit.operators.flags import lookup_both_sides


def valid_pairs(
    pairs: DataFrame, members: DataFrame, *, left: str = "genome1", right: str = "genome2",
    member: str = "member", group: str = "group", size: str = "size", few_members: bool = False,
) -> DataFrame:
    """G8 (re-aimed), G10, G11, K14, K15: scored pairs whose two members share a group.

    ``members`` is unique on ``member``. Adds group, size1, size2, min_size and
    the canonical ``pair_key``; drops self pairs and pairs across groups.
    ``few_members``: the caller has counted the members and may broadcast them.
    """
    attrs = members.select(F.col(member).alias("__m"), F.col(group).alias("grp"), F.col(size).alias("size"))
    both = lookup_both_sides(pairs, left, right, attrs, "__m", ["grp", "size"], few=few_members)
    return (both.filter((F.col("grp1") == F.col("grp2")) & (F.col(left) != F.col(right)))
            .withColumn("group", F.col("grp1")).drop("grp1", "grp2")
            .withColumn("min_size", row_min("size1", "size2"))
            .withColumn("pair_key", pair_key(left, right)))


def above_threshold(pairs: DataFrame, score: str, threshold: float) -> DataFrame:
    """Pairs with ``score >= threshold``."""
    return pairs.filter(F.col(score) >= F.lit(threshold))


def removed_members(pairs: DataFrame, *, left: str = "genome1", right: str = "genome2") -> DataFrame:
    """Distinct members removed: the smaller of each pair, else the second."""
    loser = F.when(F.col("size1") < F.col("size2"), F.col(left)).otherwise(F.col(right))
    return pairs.select(loser.alias("member")).distinct()


def _order_key(pair_id: str):
    return F.struct(F.col("min_size").isNull().alias("n"), F.col("min_size").alias("s"),
                    F.col(pair_id).alias("id"))


def already_removed(pairs: DataFrame, *, pair_id: str = "pair_id", left: str = "genome1",
                    right: str = "genome2", salt_buckets: int | None = None, max_hot: int = MAX_HOT,
                    few_members: bool = False) -> DataFrame:
    """Pairs whose member was already removed by an earlier pair.

    Earlier = smaller (min_size nulls last, pair_id). ``first(m)`` is the
    smallest key of a pair removing m (a partial ``min`` aggregate, skew-safe).
    Each pair is split into its two members, joined once with ``first`` and
    counted when either member's first removal comes before the pair.
    That join is salted for members in more than one in ``max_hot`` pair ends,
    or broadcast where the caller has counted the members (``few_members``).
    """
    keyed = pairs.select(
        _order_key(pair_id).alias("__key"),
        F.when(F.col("size1") < F.col("size2"), F.col(left)).otherwise(F.col(right)).alias("__loser"),
        F.col(left).alias("__a"), F.col(right).alias("__b"))
    first = keyed.groupBy(F.col("__loser").alias("__m")).agg(F.min("__key").alias("__first"))
    ends = keyed.select("__key", "__loser", F.explode(F.array("__a", "__b")).alias("__m"))
    if few_members:
        flagged = null_safe_join(ends, F.broadcast(first), ["__m"], "left")
    else:
        flagged = salted_lookup(ends, first, ["__m"], buckets=salt_buckets, max_hot=max_hot)
    flagged = flagged.withColumn(
        "__hit", F.coalesce(F.col("__first") < F.col("__key"), F.lit(False)))
    per_pair = flagged.groupBy("__key", "__loser").agg(F.max("__hit").alias("__hit"))
    return per_pair.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if("__hit").alias("n_already_removed"),
        F.count_distinct("__loser").alias("n_removed"),
    )


def pair_coverage(group_sizes: DataFrame, pairs: DataFrame, *, group: str = "group",
                  n: str = "n_members") -> DataFrame:
    """G9 + G11: expected pairs per group vs distinct scored valid pairs.

    ``missing_pairs`` is what the reference lists as unmatched pairs, counted
    instead of enumerated.
    """
    scored = pairs.groupBy(F.col("group").alias(group)).agg(
        F.count_distinct("pair_key").alias("scored_pairs"))
    out = null_safe_join(group_sizes.select(group, n), scored, [group], "left")  # a null group has pairs too
    return out.select(
        group, n, pairs_in_group(n).alias("expected_pairs"),
        F.coalesce(F.col("scored_pairs"), F.lit(0)).alias("scored_pairs"),
    ).withColumn("missing_pairs", F.col("expected_pairs") - F.col("scored_pairs"))


def size_split(groups: DataFrame, size: str = "n_retained", threshold: int = 500) -> DataFrame:
    """Label groups smaller than ``threshold`` and the rest; ordered by size."""
    return (groups.withColumn("size_class", F.when(F.col(size) < threshold, F.lit("LT")).otherwise(F.lit("GTE")))
            .orderBy(size))
