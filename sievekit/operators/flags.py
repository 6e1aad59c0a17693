"""Curation flags and key-set membership.

Membership in a key set is always a join against the key DataFrame (never an
``isin`` over a collected list). The key side is de-duplicated first so the
flag join cannot multiply rows, and broadcast only when its estimated size is
under the bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.functions.columns import flag
from sievekit.functions.sizing import is_small
from sievekit.functions.skew import MAX_HOT, salted_lookup


def flag_by_keys(
    df: DataFrame, column: str, keys: DataFrame, key_column: str, flag_name: str,
    *, max_broadcast_bytes: int | None = None, key_expr: Column | None = None,
    salt_buckets: int | None = None, max_hot: int = MAX_HOT, few: bool = False,
) -> DataFrame:
    """K9: add 0/1 ``flag_name``: 1 when ``df[column]`` (or ``key_expr``) is in the key set.

    Where the key set is too large to broadcast, rows of hot values (more than
    one in ``max_hot`` rows, by a partial count) are salted, into as many pieces
    as their number asks for (``salt_buckets`` sets it). ``few``: the caller has
    counted the keys and may broadcast them.
    """
    k = (keys.select(F.col(f"`{key_column}`").alias("__probe")).filter(F.col("__probe").isNotNull())
         .distinct().withColumn("__hit", F.lit(1)))
    probe = key_expr if key_expr is not None else F.col(f"`{column}`")
    left = df.withColumn("__probe", probe)
    if few or is_small(k, max_broadcast_bytes):
        joined = left.join(F.broadcast(k), "__probe", "left")
    else:
        joined = salted_lookup(left, k, ["__probe"], buckets=salt_buckets, max_hot=max_hot)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col("__hit"), F.lit(0)).alias(flag_name))


def flag_rows(df: DataFrame, **predicates: Column) -> DataFrame:
    """K8: one 0/1 column per named predicate."""
    return df.withColumns({name: flag(pred) for name, pred in predicates.items()})


def filter_summary(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows flagged by ``first``; rows flagged by ``second`` but not ``first``."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(first), F.lit(0)).cast("long").alias(f"n_{first}"),
        F.coalesce(F.sum(F.when(F.col(first) == 0, F.col(second))), F.lit(0)).cast("long").alias(f"n_{second}_only"),
    )


def keep_keys(df: DataFrame, column: str, keys: DataFrame, key_column: str) -> DataFrame:
    """Rows whose key is in the key set (left semi join)."""
    k = keys.select(F.col(f"`{key_column}`").alias("__key"))
    return df.join(k, df[f"`{column}`"] == k["__key"], "left_semi")


def drop_keys(df: DataFrame, column: str, keys: DataFrame, key_column: str) -> DataFrame:
    """Rows whose key is not in the key set (left anti join; null keys kept)."""
    k = keys.select(F.col(f"`{key_column}`").alias("__key"))
    return df.join(k, df[f"`{column}`"] == k["__key"], "left_anti")


def completeness(found: DataFrame, found_column: str, expected: DataFrame, expected_column: str) -> DataFrame:
    """Expected keys vs found keys: counts and the number missing."""
    exp = expected.select(F.col(f"`{expected_column}`").alias("k")).distinct().withColumn("__e", F.lit(1))
    got = found.select(F.col(f"`{found_column}`").alias("k")).distinct().withColumn("__g", F.lit(1))
    both = exp.join(got, "k", "full")
    return both.agg(
        F.count_if(F.col("__e").isNotNull()).alias("n_expected"),
        F.count_if(F.col("__g").isNotNull()).alias("n_found"),
        F.count_if(F.col("__e").isNotNull() & F.col("__g").isNull()).alias("n_missing"),
    ).withColumn("complete", F.col("n_missing") == 0)


def lookup_both_sides(
    pairs: DataFrame, left: str, right: str, attrs: DataFrame, key: str, columns: Sequence[str], few: bool = False,
) -> DataFrame:
    """Attach ``columns`` of ``attrs`` to both members of each pair.

    Two left joins; the attribute of ``left`` gets suffix ``1``, of ``right``
    suffix ``2``. ``attrs`` must be unique on ``key``. Attributes too large to
    broadcast are joined salted, so a hot member is no single task's. ``few``:
    the caller has counted the attributes and may broadcast them.
    """
    out = pairs
    for side, suffix in ((left, "1"), (right, "2")):
        known = attrs.filter(F.col(key).isNotNull()).select(
            F.col(key).alias(side), *[F.col(c).alias(f"{c}{suffix}") for c in columns])
        if few or is_small(known):
            out = out.join(F.broadcast(known.withColumnRenamed(side, "__k")), F.col(side) == F.col("__k"), "left").drop("__k")
        else:
            out = salted_lookup(out, known, [side])
    return out


def stack_tables(*frames: DataFrame) -> DataFrame:
    """K4: stack like tables by column name; columns missing on one side are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def select_renamed(df: DataFrame, columns: Sequence[str] | dict) -> DataFrame:
    """K6: keep, reorder and rename columns (a list keeps names; a dict maps old -> new)."""
    if isinstance(columns, dict):
        return df.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in columns])
