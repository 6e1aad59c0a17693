"""Joins whose key may be null, or hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TASK_ROWS = 1_000_000  # rows of one key that a task may get, at most
PIECES = 8  # pieces of a hot key to a fair share of a partition, so that hashing levels them out
MAX_HOT = 1000  # a key is hot with more than one in so many rows, so there are at most so many hot keys
FEW_ROWS = 100_000  # a key with no more rows is no burden for a task, whatever its share


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys, null equal to null; the keys of the left side stay."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"__right_{c}" if c in keys else c) for c in right.columns])
    on = reduce(Column.__and__, [left[f"`{k}`"].eqNullSafe(renamed[f"`__right_{k}`"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__right_{k}" for k in keys])


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str, max_hot: int = MAX_HOT) -> DataFrame:
    """The keys with more than one in ``max_hot`` of the rows that ``counts``
    counts, and that number; fewer than ``max_hot`` rows whatever the data, so
    they may be broadcast."""
    total = counts.agg(F.sum(n).alias("total")).scalar()
    return counts.filter(F.col(n) * max_hot > total).select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{n}`").cast("long").alias("__rows"), total.alias("__total"))


def pieces(rows: Column, total: Column, partitions: int, task_rows: int = TASK_ROWS) -> Column:
    """Into how many pieces a key with ``rows`` of ``total`` rows is cut: as many
    as it has times the rows that a task should get of one key. That target
    follows the data and the number of partitions; ``task_rows`` bounds it."""
    target = F.greatest(F.lit(1), F.least(F.lit(task_rows), F.floor(total / F.lit(partitions * PIECES))))
    return F.greatest(F.lit(1), F.ceil(rows / target)).cast("int")


def is_skewed(n_rows: int, largest: int, partitions: int) -> bool:
    """Whether the largest key burdens a task: more than a fair share, and not few rows."""
    return largest > FEW_ROWS and largest * partitions > n_rows


def content_hash(df: DataFrame) -> Column:
    """A hash of a row's content: a task that runs again computes it again alike."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])


def salted_lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], counts: DataFrame | None = None,
                  n: str = "__n", *, buckets: int | None = None, max_hot: int = MAX_HOT, task_rows: int = TASK_ROWS) -> DataFrame:
    """Left join of ``rows`` with a table of one row per key, null-safe.

    Rows of hot keys get a salt from a hash of their content, and the hot rows
    of the table are repeated per salt, each as often as its key has pieces
    (``pieces``; or ``buckets`` times; not at all with ``buckets`` 0 or 1).
    ``counts`` says how many rows each key has (column ``n``); by default a
    partial count of ``rows``.
    """
    if buckets is not None and buckets <= 1:
        return null_safe_join(rows, table, keys, "left")
    if counts is None:
        counts = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(n))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    cut = F.lit(buckets) if buckets is not None else pieces(F.col("__rows"), F.col("__total"), partitions, task_rows)
    hot = F.broadcast(hot_keys(counts, keys, n, max_hot).withColumn("__pieces", cut).drop("__rows", "__total"))
    salt = F.pmod(F.col("__bucket"), F.coalesce("__pieces", F.lit(1))).cast("int")
    salted = null_safe_join(rows.withColumn("__bucket", content_hash(rows)), hot, keys, "left").withColumn("__salt", salt).drop(
        "__pieces", "__bucket")
    spread = null_safe_join(table, hot, keys, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1))).drop("__pieces")
    return null_safe_join(salted, spread, [*keys, "__salt"], "left").drop("__salt")
