"""Files as byte ranges that tasks read themselves.

A folder is listed once into a small staged table of ranges (file_path, begin,
end), ``RANGE_BYTES`` each; the table says which bytes a task reads, so nothing
depends on how Spark would split the files, and no text is copied to number
lines or to look at the heads of files. Tasks open a file at an offset and
read it in blocks. Compressed files are one range each (``end`` null) and are
inflated block by block.

A line belongs to the range in which it starts. Lines end at LF, CR LF or CR,
as in Spark's text source; a byte order mark at the start of a file is no part
of its first line.

Tasks open local and shared folders, and what ``pyarrow.fs`` opens (hdfs, s3,
gs). ``can_open`` asks that of a listing; other stores are left to Spark's
readers by the callers.

Defined results: an empty file has no lines; a missing path is Spark's error;
a last line without an end is a line; a line that is longer than a range is
read whole by the task in whose range it starts; bytes that are no UTF-8 stay.
"""

from __future__ import annotations

import bz2
import gzip
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from pathlib import Path
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievekit.session import ship_package, stage_table

RANGE_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
HEAD_BYTES = 1 << 16  # read at once when only the first lines are wanted
MOST_TASKS = 50_000
BATCH_BYTES = 4 << 20  # of lines handed on together
BATCH_ROWS = 10_000
BOM = b"\xef\xbb\xbf"

#: fixed values: suffixes of the compressions that tasks inflate
INFLATED = {".gz": gzip.open, ".bz2": bz2.open}
#: fixed values: suffixes that Spark's text source inflates and tasks do not
OTHER_CODECS = (".deflate", ".lz4", ".snappy", ".zst", ".zstd", ".lzo")


# ---------------------------------------------------------------- opening

def _suffix(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""


def _local(path: str) -> str | None:
    parts = urlsplit(path)
    return {"": path, "file": unquote(parts.path)}.get(parts.scheme)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(unquote(path).replace("s3a://", "s3://", 1))


def open_raw(path: str):
    """A file opened for reading its bytes; ``path`` as Spark names it."""
    local = _local(path)
    if local is not None:
        return open(local, "rb")  # noqa: SIM115 - closed by the caller
    store, inner = _store(path)
    return store.open_input_file(inner)


def open_file(path: str):
    """A file opened for reading what it holds, inflated."""
    raw, inflate = open_raw(path), INFLATED.get(_suffix(path))
    return inflate(raw, "rb") if inflate else raw


def blocks(path: str, begin: int, end: int | None, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The bytes of [begin, end) in blocks; to the end of the file without ``end``."""
    with open_file(path) as f:
        if begin:
            f.seek(begin)
        left = end - begin if end is not None else None
        while left is None or left > 0:
            block = f.read(size if left is None else min(size, left))
            if not block:
                return
            left = None if left is None else left - len(block)
            yield bytes(block)


def file_facts(path: str) -> tuple[str, int | None, str | None]:
    """(status, length, error) of a path: ``found`` (a file that opens),
    ``not_found``, or ``error`` with the reason."""
    try:
        with open_raw(path) as f:
            f.read(1)
            f.seek(0, 2)
            return "found", f.tell(), None
    except FileNotFoundError:
        return "not_found", None, None
    except Exception as exc:  # noqa: BLE001 - the reason is the result
        return "error", None, f"{type(exc).__name__}: {exc}"


def write_file(path: str, body: bytes) -> None:
    """Write a file whole, making its folder."""
    local = _local(path)
    if local is not None:
        Path(local).parent.mkdir(parents=True, exist_ok=True)
        Path(local).write_bytes(body)
        return
    store, inner = _store(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(inner) as f:
        f.write(body)


# ---------------------------------------------------------------- lines

def lines_from(path: str, begin: int, end: int | None, size: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that start in [begin, end)."""
    at = max(0, begin - 1)
    skipping = begin > 0  # up to the end of the line that holds the byte before
    held: list[bytes] = []
    start = at

    def finished(pieces: list[bytes]) -> bytes:
        line = b"".join(pieces)
        line = line[:-2] if line.endswith(b"\r\n") else line[:-1] if line.endswith((b"\n", b"\r")) else line
        return line.removeprefix(BOM) if not start else line

    carried = b""
    for block in blocks(path, at, None, size):
        data = carried + block
        carried = b""
        if data.endswith(b"\r"):  # the next byte tells whether the line ends here
            data, carried = data[:-1], b"\r"
        for piece in data.splitlines(True):
            if not held and not skipping and end is not None and start >= end:
                return
            held.append(piece)
            if piece.endswith((b"\n", b"\r")):
                if not skipping:
                    yield start, finished(held)
                start += sum(map(len, held))
                held, skipping = [], False
        if not held and not skipping and end is not None and start >= end:
            return
    if carried:
        held.append(carried)
    if held and not skipping and (end is None or start < end):
        yield start, finished(held)


def line_starts(path: str, begin: int, end: int | None) -> int:
    """How many lines start in [begin, end)."""
    found, last = 0, b""
    for block in blocks(path, max(0, begin - 1), end):
        if not begin and not found and not last:
            found = 1
        data = last + block
        known = data[:-1]  # what follows the last byte is not known yet
        found += known.count(b"\n") + known.count(b"\r") - data.count(b"\r\n")
        last = data[-1:]
    return found


# ---------------------------------------------------------------- tables

def listing(spark: SparkSession, path) -> DataFrame:
    """(file_path, size) of the files that a text read of ``path`` reads; no file is opened."""
    return spark.read.format("binaryFile").load(path).select("_metadata.file_path", F.col("_metadata.file_size").alias("size"))


@dataclass(frozen=True)
class Ranges:
    """A staged range table, the number of its rows, and whether tasks can open its files."""

    table: DataFrame
    n: int
    opened: bool

    def spread(self, rows: DataFrame, *keys: str) -> DataFrame:
        """Rows of the table (or made of it) a task each, ``MOST_TASKS`` at most."""
        return rows.repartition(max(1, min(self.n, MOST_TASKS)), *keys)


def byte_ranges(spark: SparkSession, path, range_bytes: int = RANGE_BYTES) -> Ranges:
    """The range table of ``path``: (file_path, begin, end)."""
    ship_package(spark)
    name = F.lower(F.element_at(F.split("file_path", "/"), -1))
    whole, odd = (reduce(Column.__or__, [name.endswith(suffix) for suffix in some]) for some in (INFLATED, OTHER_CODECS))
    begins = F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))
    files = listing(spark, path).filter("size > 0")
    ranges = files.select("file_path", "size", whole.alias("whole"), F.explode(begins).alias("begin"))
    table = stage_table(ranges.select("file_path", "begin", F.when(~F.col("whole"), F.least(
        F.col("begin") + range_bytes, F.col("size"))).alias("end")), "byte-ranges")
    facts = table.agg(F.count(F.lit(1)).alias("n"), F.min("file_path").alias("one"), F.count_if(odd).alias("odd")).first()
    return Ranges(table, facts["n"], can_open(facts["one"]) if not facts["odd"] else False)


def can_open(path: str | None) -> bool:
    """Whether tasks can read such files: the driver opens one of them."""
    try:
        if path is not None:
            next(blocks(path, 0, 1), b"")
    except Exception:  # noqa: BLE001 - a store without a Python client
        return False
    return True


def _lines(keep: Sequence[str], numbered: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                number = row["first_line"] if numbered else None
                held: list[tuple[int, bytes]] = []
                size = 0

                def batch(row=row) -> pa.RecordBatch:
                    columns = [pa.array([row[k]] * len(held), b.schema.field(k).type) for k in keep]
                    columns += [pa.array([o for o, _ in held], pa.int64()), pa.array([v for _, v in held], pa.binary())]
                    names = [*keep, "offset", "value"]
                    if numbered:
                        columns.append(pa.array(range(number, number + len(held)), pa.int64()))
                        names.append("line_number")
                    return pa.record_batch(columns, names=names)

                for line in lines_from(row["file_path"], row["begin"], row["end"]):
                    held.append(line)
                    size += len(line[1])
                    if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                        yield batch()
                        number = number + len(held) if numbered else None
                        held, size = [], 0
                if held:
                    yield batch()

    return run


def read_lines(ranges: Ranges, rows: DataFrame | None = None, keep: Sequence[str] = ("file_path",)) -> DataFrame:
    """The lines of a range table (or of ``rows`` made of it): its columns
    ``keep``, ``offset``, ``value``, and ``line_number`` where it has a ``first_line``."""
    rows = ranges.table if rows is None else rows
    numbered = "first_line" in rows.columns
    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], "offset long, value binary"]) + (", line_number long" if numbered else "")
    out = ranges.spread(rows, "file_path", "begin").mapInArrow(_lines(keep, numbered), schema)
    return out.withColumn("value", F.col("value").cast("string"))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = b.to_pylist()
        yield pa.record_batch([*b.columns, pa.array([line_starts(r["file_path"], r["begin"], r["end"]) for r in rows], pa.int64())],
                              names=[*b.schema.names, "n"])


def numbered_ranges(ranges: Ranges) -> DataFrame:
    """The range table with the number of the first line that starts in each
    range: tasks count line ends, a running sum over a file's ranges adds up."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in ranges.table.dtypes)
    counted = ranges.spread(ranges.table, "file_path", "begin").mapInArrow(_counted, f"{kinds}, n long")
    before = Window.partitionBy("file_path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("first_line", F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).drop("n")


def _heads(n: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("file_path").to_pylist():
                found = []
                for line in lines_from(path, 0, None, HEAD_BYTES):
                    found.append(line)
                    if len(found) > n:  # one more tells where the data after the head begins
                        break
                shown = found[:n]
                after = found[n][0] if len(found) > n else None
                yield pa.record_batch([pa.array([path] * len(shown)), pa.array(range(1, len(shown) + 1), pa.int32()),
                                       pa.array([v for _, v in shown], pa.binary()), pa.array([after] * len(shown), pa.int64())],
                                      names=["file_path", "line_number", "value", "after"])

    return run


def read_heads(ranges: Ranges, n: int) -> DataFrame:
    """The first ``n`` lines of every file, each file opened once for them:
    (file_path, line_number, value, after), ``after`` where the lines behind
    them begin (null: nowhere)."""
    files = ranges.table.filter("begin = 0").select("file_path")
    tasks = max(1, min(ranges.n, 4 * files.sparkSession.sparkContext.defaultParallelism))
    out = files.repartition(tasks, "file_path").mapInArrow(_heads(n), "file_path string, line_number int, value binary, after long")
    return out.withColumn("value", F.col("value").cast("string"))
