"""Group/list operators (G1-G7): groups of members, filtered in stages.

Groups are kept in long form — one row per (group, member) — which is what
Spark partitions well. Group sizes are aggregates (partial aggregation makes a
group holding a third of all rows cost one row per map task), and per-member
decisions come back by joining the small per-group table. Lists are rebuilt
only per original row (``regroup``), so a rebuilt list is never larger than
the list that row already held.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.functions.columns import _split
from sievekit.functions.skew import MAX_HOT, null_safe_join, salted_lookup

MIN_GROUP_SIZE = 2  # fixed value: minimum group (clade) size of the curation stages


def explode_members(
    df: DataFrame, list_column: str, sep: str = ",", *, member: str = "member",
    position: str = "position", keep: Sequence[str] = (),
) -> DataFrame:
    """G1: one row per list member, with its 0-based position in the list."""
    cols = [F.col(f"`{c}`") for c in keep]
    return df.select(*cols, F.posexplode(_split(F.col(f"`{list_column}`"), sep)).alias(position, member))


def declared_count_check(
    df: DataFrame, group_cols: Sequence[str], list_column: str, declared: Column, sep: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """Exploded member count vs the sum of declared counts.

    Returns (summary, mismatching groups). The summary is one aggregate; the
    mismatch list is a filter — neither shuffles members.
    """
    sized = df.select(*[F.col(f"`{c}`") for c in group_cols],
                      F.size(_split(F.col(f"`{list_column}`"), sep)).cast("long").alias("n_listed"),
                      declared.cast("long").alias("n_declared"))
    summary = sized.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.sum("n_listed").alias("n_exploded"),
        F.sum("n_declared").alias("n_declared"),
        F.count_if(~F.col("n_listed").eqNullSafe(F.col("n_declared"))).alias("n_mismatched_groups"),
    ).withColumn("matches", F.col("n_exploded").eqNullSafe(F.col("n_declared")))
    mismatches = sized.filter(~F.col("n_listed").eqNullSafe(F.col("n_declared")))
    return summary, mismatches


def group_sizes(members: DataFrame, group_cols: Sequence[str], removed: str = "removed") -> DataFrame:
    """Members, removed and retained per group (retained of an empty group is 0)."""
    return members.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_members"),
        F.count_if(F.col(removed) == 1).alias("n_removed"),
        F.count_if(F.col(removed) == 0).alias("n_retained"),
    )


def _with_all_groups(groups: DataFrame, group_cols: Sequence[str], all_groups: DataFrame | None) -> DataFrame:
    """Add groups that have no member rows (size 0)."""
    if all_groups is None:
        return groups
    return null_safe_join(all_groups.select(*group_cols), groups, group_cols, "left").select(
        *group_cols, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_members", "n_removed", "n_retained")])


def filter_stage(
    members: DataFrame, group_cols: Sequence[str], removed: str = "removed",
    min_size: int = MIN_GROUP_SIZE, all_groups: DataFrame | None = None,
    groups_from_rows: bool = False, salt_buckets: int | None = None, max_hot: int = MAX_HOT,
) -> tuple[DataFrame, DataFrame]:
    """One curation stage.

    ``members`` has a 0/1 ``removed`` flag. Returns (members, groups):
    members gain ``cascade`` (1 when the member was retained but its group fell
    below ``min_size``, G5) and ``retained`` (final); groups carry
    n_members / n_removed / n_retained and ``kept`` (G6). Pass ``all_groups``
    (one row per group) to also report groups without members (a null or
    empty list: size 0, dropped).

    Plans: by default the group sizes are a partial aggregate joined back to
    the members — safe for any group size, including a group holding a third
    of all rows. With ``groups_from_rows=True`` (each group is one exploded
    input row, so it is never larger than that row) the sizes come from a
    window over the group instead: one shuffle and no second pass.

    Groups that hold more than one in ``max_hot`` of all members (so at most
    ``max_hot`` groups; their counts come from the group table) are joined back
    salted: their members get a salt from a hash of the row, and their group
    row is repeated per salt, so a hot group spreads over as many pieces as its
    size asks for (``salt_buckets`` sets the number, 0 for a plain join). A null
    group is a group like any other.
    """
    if groups_from_rows:
        return _filter_stage_window(members, group_cols, removed, min_size, all_groups)
    sizes = group_sizes(members, group_cols, removed)
    groups = _with_all_groups(sizes, group_cols, all_groups)
    groups = groups.withColumn("kept", F.col("n_retained") >= F.lit(min_size))
    small = groups.select(*group_cols, (~F.col("kept")).alias("__small"))
    tagged = salted_lookup(members, small, list(group_cols), sizes, "n_members", buckets=salt_buckets, max_hot=max_hot)
    tagged = tagged.withColumn(
        "cascade", F.when((F.col(removed) == 0) & F.col("__small"), 1).otherwise(0)
    ).withColumn(
        "retained", F.when((F.col(removed) == 0) & (F.col("cascade") == 0), 1).otherwise(0)
    ).drop("__small")
    return tagged, groups


def fold_stages(
    members: DataFrame, group_cols: Sequence[str], flags: Sequence[str], min_size: int = MIN_GROUP_SIZE,
    all_groups: DataFrame | None = None, salt_buckets: int | None = None,
) -> tuple[DataFrame, list[DataFrame]]:
    """G3-G6 over several stages at once, from one grouped count and one join.

    ``flags`` name 0/1 columns, one a stage: the members that the stage itself
    removes (of those it still finds). What a stage finds depends on earlier
    stages only through these flags and through whole groups that fell below
    ``min_size``, so the counts of members without the first i flags decide all
    stages. Members gain, per stage i from 1, ``cascade{i}`` and ``retained{i}``;
    the group table of every stage is as in ``filter_stage``.
    """
    clear = [reduce(Column.__and__, [F.col(f) == 0 for f in flags[: i + 1]]) for i in range(len(flags))]
    counts = members.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_members"), *[
        F.count_if(c).alias(f"__own{i}") for i, c in enumerate(clear, start=1)])
    found = F.lit(True)
    decided = counts
    for i in range(1, len(flags) + 1):
        decided = decided.withColumn(f"__n{i}", F.when(found, F.col(f"__own{i}")).otherwise(F.lit(0).cast("long")))
        decided = decided.withColumn(f"__kept{i}", F.col(f"__n{i}") >= F.lit(min_size))
        found = F.col(f"__kept{i}")
    groups = []
    for i in range(1, len(flags) + 1):
        n_members, n = F.col("n_members"), F.col(f"__n{i}")
        own = decided.select(*group_cols, "n_members", (n_members - n).alias("n_removed"), n.alias("n_retained"))
        own = _with_all_groups(own, group_cols, all_groups) if i == 1 else own
        groups.append(own.withColumn("kept", F.col("n_retained") >= F.lit(min_size)))
    table = decided.select(*group_cols, *[f"__kept{i}" for i in range(1, len(flags) + 1)])
    out = salted_lookup(members, table, list(group_cols), counts, "n_members", buckets=salt_buckets)
    before = F.lit(True)
    for i, c in enumerate(clear, start=1):
        kept, own = F.col(f"__kept{i}"), before & c
        out = out.withColumn(f"cascade{i}", F.when(own & ~kept, 1).otherwise(0)).withColumn(
            f"retained{i}", F.when(own & kept, 1).otherwise(0))
        before = F.col(f"retained{i}") == 1
    return out.drop(*[f"__kept{i}" for i in range(1, len(flags) + 1)]), groups


def _filter_stage_window(members, group_cols, removed, min_size, all_groups):
    from pyspark.sql.window import Window

    w = Window.partitionBy(*group_cols)
    tagged = members.withColumn("__retained_in_group", F.sum(F.when(F.col(removed) == 0, 1).otherwise(0)).over(w))
    small = F.col("__retained_in_group") < F.lit(min_size)
    tagged = tagged.withColumn(
        "cascade", F.when((F.col(removed) == 0) & small, 1).otherwise(0)
    ).withColumn(
        "retained", F.when((F.col(removed) == 0) & ~small, 1).otherwise(0)
    ).drop("__retained_in_group")
    groups = group_sizes(tagged, group_cols, removed)
    groups = _with_all_groups(groups, group_cols, all_groups)
    return tagged, groups.withColumn("kept", F.col("n_retained") >= F.lit(min_size))


def dropped_groups(groups: DataFrame) -> DataFrame:
    """Groups below the minimum, and their count."""
    return groups.filter(~F.col("kept"))


def changed_groups(groups: DataFrame, before: str = "n_members", after: str = "n_retained") -> DataFrame:
    """Number of groups whose size changed (null-safe) and number dropped."""
    return groups.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("n_changed"),
        F.count_if(~F.col("kept")).alias("n_dropped"),
    )


def regroup(
    members: DataFrame, row_cols: Sequence[str], position: str, member: str, flag: str,
    sep: str | None = None,
) -> DataFrame:
    """G3 list form: per original row, the retained and removed members in order.

    ``row_cols`` identify the row the list came from, so each rebuilt list is
    bounded by that row's original list. With ``sep`` the lists are joined to
    strings.
    """
    def ordered(pred: Column) -> Column:
        items = F.array_sort(F.collect_list(F.when(pred, F.struct(F.col(position).alias("p"),
                                                                  F.col(member).alias("m")))))
        lst = F.transform(items, lambda x: x["m"])
        return F.concat_ws(sep, lst) if sep is not None else lst

    return members.groupBy(*row_cols).agg(
        ordered(F.col(flag) == 1).alias("retained_members"),
        ordered(F.col(flag) == 0).alias("removed_members"),
        F.count_if(F.col(flag) == 1).alias("n_retained"),
    )


class GroupBelowMinimum(Exception):
    """Raised by ``require_no_drops``."""


def require_no_drops(groups: DataFrame) -> int:
    """Stop a stage when any group fell below the minimum (the second
    curation stage aborts instead of dropping). Returns the number of groups
    checked; only a count reaches the driver."""
    row = groups.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("kept")).alias("dropped")).first()
    if row["dropped"]:
        raise GroupBelowMinimum(f"{row['dropped']} of {row['n']} groups fell below the minimum size")
    return row["n"]
