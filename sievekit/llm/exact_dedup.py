"""Exact deduplication by 128-bit content hash with byte comparison.

Rows are grouped by the MD5 of their normalised text; the smallest id of a
group stays. Only (id, hash) pairs travel for that. Texts travel once, for
the byte comparison, already reduced to the distinct texts of each map task,
so a text that a third of all rows share is sent once per task. When the list
of repeated hashes is proven small it is broadcast first and only texts of
repeated hashes move at all.

Defined results
    null or empty text   counts as the empty text; all such rows are one group
    repeated rows        rows with the same id and text are all counted; each
                         row that carries the kept id is ``kept``
    null id              never the smallest unless the whole group has none
    hash collision       texts that differ get groups of their own
    empty table          empty result
    extra columns        ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import BROADCAST_BYTES, SPACE, hinted, small, stage, without_ids


def normalised(text: Column) -> Column:
    """Null as empty; each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hash_128: Callable[[Column], Column] = md5_128,
                 max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    texts = df.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    keyed = texts.withColumn("_h", hash_128(F.col("_text")))
    rows = stage(keyed.select("_id", "_h", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha")),
                 "exact-rows")
    sizes = rows.groupBy("_h").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size"))
    repeated = stage(sizes.filter("group_size > 1"), "exact-repeated")

    if small(repeated, max_broadcast_bytes):
        suspects = keyed.join(F.broadcast(repeated.select("_h")), "_h", "left_semi")
    else:
        suspects = keyed
    # byte comparison: equal hashes with different texts show up as two variants
    variants = suspects.groupBy("_h", "_text").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size"))
    collided = stage(variants.groupBy("_h").count().filter("count > 1").select("_h"), "exact-collided")

    plain = rows.join(hinted(repeated, max_broadcast_bytes), "_h", "left")
    own = F.col("group_size").isNull()
    plain = plain.select(
        "_h", "_id", "_sha",
        F.when(own, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))
    if not collided.isEmpty():
        hot = hinted(collided, max_broadcast_bytes)
        mixed = keyed.join(hot, "_h", "left_semi")
        exact = stage(mixed.groupBy("_h", "_text").agg(F.min("_id").alias("keep_id"),
                                                       F.count("*").alias("group_size")), "exact-variants")
        resolved = mixed.join(exact, ["_h", "_text"]).select(
            "_h", "_id", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha"), "keep_id", "group_size")
        plain = plain.join(hot, "_h", "left_anti").unionByName(resolved)
    return plain.select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    gone = exact_groups(df, id_col, text_col).filter(~F.col("kept"))
    return without_ids(df, id_col, gone.select(id_col), "exact-gone")
