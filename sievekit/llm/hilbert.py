"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``2**bits`` levels: numbers at approximate
quantiles (one aggregate, one row of cut points), strings at their own values
by counted weight, whatever prefixes they share. The levels give a cell of the Hilbert
curve, rows are ordered by (cell, run, id) and the order is cut into shards of
equal row counts, so a shard covers a compact region of all dimensions and its
minima and maxima prune well.

No global sort: a cell is split into runs by a hash of the row, as many as keep
a run near ``RUN_ROWS`` even if one cell held every row; counts per (cell,
run) are summed into start offsets, and a row's place is its run's start plus
its number within the run. Only narrow rows (ids, sizes, checksums) move.

Defined results
    null text        0 bytes plus 1; checksum of the empty text (0)
    null dimension   level 0, with the smallest values
    null, equal ids  spread like others, by checksum, size and dimensions
    ties             ordered by position if there is one, then id, checksum, size
    repeated rows    each has a slot of its own
    empty table      empty result
    extra columns    ignored
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import hinted, stage, utf8_bytes

RUN_ROWS = 50_000
MIN_RUNS = 64
POSITIONS = 1 << 15  # neighbouring positions of a run, where rows have positions


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """Next state and curve digit for (state, orthant), n dimensions, by the
    entry/direction rule of the curve; state = entry point * n + direction."""
    mask = (1 << n) - 1

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def rotate(x: int, k: int) -> int:  # to the left
        k %= n
        return ((x << k) | (x >> (n - k))) & mask if k else x

    def trailing_ones(i: int) -> int:
        return ((i ^ (i + 1)) >> 1).bit_length()

    rank = {gray(i): i for i in range(1 << n)}
    nxt, digit = [], []
    for state in range(n << n):
        entry, direction = divmod(state, n)
        for orthant in range(1 << n):
            w = rank[rotate(orthant ^ entry, -(direction + 1))]
            start = gray(2 * ((w - 1) // 2)) if w else 0
            turn = trailing_ones(w if w % 2 else w - 1) % n if w else 0
            nxt.append((entry ^ rotate(start, direction + 1)) * n + (direction + turn + 1) % n)
            digit.append(w)
    return nxt, digit


def curve_index(levels: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of a point with the given levels."""
    n = len(levels)
    nxt, digit = curve_tables(n)
    next_state, digits = F.array(*[F.lit(x) for x in nxt]), F.array(*[F.lit(x) for x in digit])

    def step(acc: Column, bit: Column) -> Column:
        orthant = reduce(add, [F.call_function("shiftright", c, bit).bitwiseAND(F.lit(1)) * (1 << i)
                               for i, c in enumerate(levels)])
        at = acc["state"] * (1 << n) + orthant + 1
        return F.struct(F.element_at(next_state, at).alias("state"),
                        (acc["index"] * (1 << n) + F.element_at(digits, at)).alias("index"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step)["index"]


def ordinal(df: DataFrame, name: str) -> Column:
    """A dimension that is no string as an order-preserving number; times as microseconds."""
    kind, c = dict(df.dtypes)[name], df[name]
    if kind.startswith("timestamp") or kind == "date":
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def string_cuts(df: DataFrame, name: str, n: int) -> list[str]:
    """At most ``n`` strings that cut the distinct values of a string dimension
    into levels of equal weight, by counted rows.

    Distinct values are counted (partial aggregation, a hot value is one row a
    task), put into order by ranges and summed range by range: exact whatever
    the common prefixes, and nothing but one row a range and the cuts reaches
    the driver."""
    counts = df.filter(df[name].isNotNull()).groupBy(df[name].alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ordered = stage(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("part", F.spark_partition_id()), "hilbert-strings")
    sums = {r["part"]: r["n"] for r in ordered.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    total, before, starts = sum(sums.values()), 0, []
    for part in sorted(sums):
        starts.append((part, before))
        before += sums[part]
    if not total:
        return []
    start = ordered.sparkSession.createDataFrame(starts, "part int, start long")
    running = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = ordered.join(F.broadcast(start), "part").withColumn("upto", F.col("start") + F.sum("n").over(running))
    # a value ends a level when it is the first to reach the level's share; the last value ends none
    share = F.expr(f"upto * {n + 1} div {total}")
    ends = upto.filter((share > F.expr(f"(upto - n) * {n + 1} div {total}")) & (F.col("upto") < total))
    return sorted((r["v"] for r in ends.select("v").collect()), key=lambda v: v.encode("utf-8", "surrogatepass"))


def with_cell(df: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """Add ``cell``, the curve index of the row's levels. A level is how many
    cut points lie below the value. In steps, so that values and levels are
    made once a row and not once for every use.

    Cut points of numbers come from a quantile sketch (rank error 1 in 1,000),
    which depends on the order in which Spark merges partitions: equal inputs
    may be cut at neighbouring values, so cells are fitted, shards are exact."""
    n = (1 << bits) - 1
    kinds = dict(df.dtypes)
    numbers = [d for d in dims if kinds[d] != "string"]
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(F.count(F.lit(1)), *[F.percentile_approx(ordinal(df, d), at, 1000).alias(d) for d in numbers]).first()
    cuts = {d: found[d] or [] for d in numbers} | {d: string_cuts(df, d, n) for d in dims if d not in numbers}
    levels = {}
    for i, d in enumerate(dims):
        c = F.col(f"_v{i}")
        above = [c > F.lit(x if d not in numbers else float(x)) for x in cuts[d]]
        levels[f"_q{i}"] = F.coalesce(reduce(add, [x.cast("int") for x in above], F.lit(0)), F.lit(0))  # null: with the smallest
    rows = df.withColumns({f"_v{i}": ordinal(df, d) if d in numbers else df[d] for i, d in enumerate(dims)}).withColumns(levels)
    return rows.withColumn("cell", curve_index([F.col(f"_q{i}") for i in range(len(dims))], bits))


def hilbert_shards(df: DataFrame, dims: list[str], n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                   bits: int = 4, run_rows: int = RUN_ROWS, position: Column | None = None) -> DataFrame:
    """One row per input row: id, size, text_crc32, cell, shard, slot.

    Shards are runs of the curve order whose row counts differ by one at most;
    slots number a shard's rows without gaps from 0. ``position``, a whole
    number per row (as the place in a stream), orders the rows of a cell in
    place of the hash; runs are then ``POSITIONS`` neighbouring positions.
    """
    base = df.select(
        F.col(id_col).alias("_id"), *[df[d].alias(f"_d{i}") for i, d in enumerate(dims)], df[text_col].alias("_text"),
        *([] if position is None else [position.cast("long").alias("_pos")]))
    names = [f"_d{i}" for i in range(len(dims))]
    total = base.count()
    runs = max(MIN_RUNS, math.ceil(total / run_rows))
    placed = with_cell(base, names, bits).withColumns({
        "size": utf8_bytes(F.col("_text")) + 1, "text_crc32": F.crc32(F.coalesce(F.col("_text"), F.lit("")).cast("binary"))})
    if position is None:
        # rows without an id, or with equal ones, are spread by what else they hold
        placed = placed.withColumn("run", F.pmod(F.xxhash64("_id", "text_crc32", "size", *names), F.lit(runs))).withColumn("_pos", F.lit(0))
    else:
        placed = placed.withColumn("run", F.floor(F.col("_pos") / POSITIONS).cast("long"))
    placed = placed.select("_id", "cell", "run", "_pos", "size", "text_crc32")

    counts = placed.groupBy("cell", "run").agg(F.count("*").alias("n"))
    counts = stage(counts, "hilbert-counts")
    # at most 2**(bits * dims) cells: one small ordered sum
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.groupBy("cell").agg(F.sum("n").alias("n")).select(
        "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_start"))
    inside = Window.partitionBy("cell").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("cell", "run", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("run_start")).join(
        F.broadcast(cells), "cell").select("cell", "run", (F.col("cell_start") + F.col("run_start")).alias("start"))

    order = Window.partitionBy("cell", "run").orderBy("_pos", "_id", "text_crc32", "size")
    ranked = placed.withColumn("nth", F.row_number().over(order)).join(
        hinted(stage(starts, "hilbert-starts")), ["cell", "run"])
    return ranked.withColumn("rank", (F.col("start") + F.col("nth") - 1).cast("long")).withColumn(
        "shard", F.expr(f"cast(rank * {n_shards} div {max(total, 1)} as int)")).select(
        F.col("_id").alias(id_col), "size", "text_crc32", "cell", "shard",
        F.expr(f"rank - (cast(shard as bigint) * {total} + {n_shards} - 1) div {n_shards}").alias("slot"))


def shard_extents(df: DataFrame, dims: list[str]) -> DataFrame:
    """Minimum, maximum and rows per shard: what a reader prunes files by."""
    return df.groupBy("shard").agg(
        F.count("*").alias("n_rows"),
        *[f(d).alias(f"{k}_{d}") for d in dims for k, f in (("min", F.min), ("max", F.max))])


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order, so Parquet statistics prune."""
    (df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
       .write.mode("overwrite").partitionBy("shard").parquet(path))
