"""Mixing sources to target weights by Pfair scheduling.

Each source is an ordered stream cut into blocks of ``block_bytes``. With
weight w, block j (from 0) of a source is released at slot floor(j / w) and
due by slot ceil((j + 1) / w); earliest deadline first over the released
blocks fills one slot after another, so that at every point each source is
less than one block from its share. Weights are whole numbers, hence the
schedule repeats after their sum; it is worked out once for one such period
(bounded by ``RESOLUTION``, whatever the corpus) and every block's slot
follows by arithmetic. When a source runs out, a new phase goes on with the
others at their weights. Every document gets a place; none is dropped,
repeated or capped.

A document belongs to the block in which its first byte falls; running sums
come from buckets by a hash of id, size and checksum, so no source, and no
mass of rows without an id, is gathered in one task.

Defined results
    null or unlisted source   shares the pool ``REST`` of weight ``rest_weight``
    null text                 one byte, as an empty text
    long documents            begin in one block and pass over the following
                              ones, which count as taken
    ties, repeated rows       ordered by id, size, checksum; each has its own place
    empty table, no weights   empty result; all in the pool
    extra columns             kept by ``mixed_documents``, ignored else
"""

from __future__ import annotations

import heapq
import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import hinted, stage, utf8_bytes

REST = "*"
RESOLUTION = 10_000  # largest sum of weights, so the largest period
BLOCK_BYTES = 64 * 1024
BUCKET_ROWS = 50_000
MIN_BUCKETS = 64


def pfair_period(weights: dict[str, int]) -> list[tuple[str, int, int, int]]:
    """(source, block, release, deadline) for each slot of one period."""
    period = sum(weights.values())
    later = [(0, s, 0) for s in sorted(weights)]  # (release, source, block)
    heapq.heapify(later)
    ready: list[tuple[int, str, int]] = []
    slots = []
    for now in range(period):
        while later and later[0][0] <= now:
            _, s, j = heapq.heappop(later)
            heapq.heappush(ready, (-(-(j + 1) * period // weights[s]), s, j))
        due, s, j = heapq.heappop(ready)
        slots.append((s, j, j * period // weights[s], due))
        if j + 1 < weights[s]:
            heapq.heappush(later, ((j + 1) * period // weights[s], s, j + 1))
    return slots


def phases(weights: dict[str, int], blocks: dict[str, int]) -> list[dict]:
    """Which blocks of which source are scheduled in which phase.

    A phase ends when a source is used up; ``first`` is the source's first
    block in the phase, ``count`` their number, ``begin`` the phase's slot.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    begin, out = 0, []
    while left:
        shrink = math.gcd(*[weights[s] for s in left])
        active = {s: weights[s] // shrink for s in left}
        period = sum(active.values())
        table = pfair_period(active)
        at: dict[str, list[int]] = {s: [] for s in active}
        for slot, (s, *_) in enumerate(table):
            at[s].append(slot)
        length = min((left[s] - 1) // active[s] * period + at[s][(left[s] - 1) % active[s]] + 1 for s in left)
        whole, part = divmod(length, period)
        for s in active:
            count = whole * active[s] + sum(x < part for x in at[s])
            out.append({"source": s, "first": done[s], "count": count, "begin": begin, "period": period,
                        "weight": active[s], "slots": at[s]})
            done[s] += count
            left[s] -= count
        left = {s: n for s, n in left.items() if n > 0}
        begin += length
    return out


def check_weights(weights: dict[str, int], rest_weight: int) -> dict[str, int]:
    full = dict(weights) | {REST: rest_weight}
    if any(w != int(w) or w < 1 for w in full.values()) or sum(full.values()) > RESOLUTION:
        raise ValueError(f"weights are whole numbers from 1, with a sum of at most {RESOLUTION}")
    return full


def pfair_mix(df: DataFrame, weights: dict[str, int], rest_weight: int = 1, source_col: str = "source",
              id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
              carry: bool = False) -> DataFrame:
    """One row per input row: id, mix_source, size, block, release, deadline,
    slot, seq; (slot, seq) orders the mixed stream. ``carry``: with a struct
    ``row`` of all input columns."""
    full = check_weights(weights, rest_weight)
    listed = F.col(source_col).isin(*weights) if weights else F.lit(False)
    rows = df.select(
        F.col(id_col).alias("_id"),
        F.when(listed, F.col(source_col)).otherwise(REST).alias("mix_source"),
        (utf8_bytes(F.col(text_col)) + 1).alias("size"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("_crc"),
        *([F.struct(*[df[c] for c in df.columns]).alias("row")] if carry else []))
    buckets = max(MIN_BUCKETS, math.ceil(df.count() / BUCKET_ROWS))
    # rows without an id, or with equal ones, are spread by their texts
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("_id", "size", "_crc"), F.lit(buckets)).cast("int"))

    sums = stage(rows.groupBy("mix_source", "bucket").agg(F.sum("size").alias("bytes")), "mix-sums")
    before = Window.partitionBy("mix_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(sums.select("mix_source", "bucket", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")), "mix-starts")
    # one row per listed source
    totals = {r["mix_source"]: r["bytes"] for r in sums.groupBy("mix_source").agg(F.sum("bytes").alias("bytes")).collect()}
    plan = phases(full, {s: -(-b // block_bytes) for s, b in totals.items()})

    order = Window.partitionBy("mix_source", "bucket").orderBy("_id", "size", "_crc")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rows.withColumn("inside", inside).join(hinted(starts), ["mix_source", "bucket"])
    placed = placed.withColumn("offset", F.col("start") + F.col("inside"))
    placed = placed.withColumn("block", F.expr(f"offset div {block_bytes}"))

    # at most (listed sources)**2 rows of at most RESOLUTION slots each
    table = df.sparkSession.createDataFrame(
        [(p["source"], p["first"], p["first"] + p["count"], p["begin"], p["period"], p["weight"], p["slots"]) for p in plan],
        "mix_source string, first long, until long, begin long, period long, weight long, slots array<int>")
    timed = placed.join(F.broadcast(table), "mix_source").filter("block >= first and block < until")
    timed = timed.withColumn("_j", F.expr("block - first"))
    timed = timed.withColumn("slot", F.expr("begin + _j div weight * period + element_at(slots, cast(_j % weight as int) + 1)"))
    return timed.select(
        F.col("_id").alias(id_col), "mix_source", "size", "block",
        F.expr("begin + _j * period div weight").alias("release"),
        F.expr("begin + ((_j + 1) * period + weight - 1) div weight").alias("deadline"),
        "slot", F.col("offset").alias("seq"), *(["row"] if carry else []))


def stream_position(df: DataFrame) -> Column | None:
    """The place of each row in the files that ``df`` reads, as ``mixed_documents``
    (or any ordered writer) left them: part, then row. None where ``df`` does
    not read Parquet files."""
    try:
        df.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return None
    part = F.regexp_extract("_metadata.file_name", r"part-([0-9]+)", 1).try_cast("long")
    return F.coalesce(part, F.lit(0)) * (1 << 40) + F.col("_metadata.row_index")


def mixed_documents(df: DataFrame, weights: dict[str, int], **options) -> DataFrame:
    """``df`` itself in the order of the mixed stream (across its partitions)."""
    mixed = pfair_mix(df, weights, carry=True, **options)
    return mixed.repartitionByRange("slot", "seq").sortWithinPartitions("slot", "seq").select("row.*")
