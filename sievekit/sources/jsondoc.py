"""Nested JSON documents (S7): a top-level object whose keys become rows.

A document is cut into byte ranges. What a range does to the reader's state is
worked out without knowing where it starts: for each of three states at its
first byte (outside strings, inside one, inside one behind a backslash) the
state behind its last byte and the change of depth. Running through these
summaries (a few numbers a range) gives every range its true state, and then
each range finds the top-level commas in it. An entry belongs to the range in
which it starts, so one file is read by as many tasks as it has ranges, and no
task holds more than a block and one entry.

Defined results: a document that is no object has no rows; an entry that is no
valid JSON gives none; a key that comes twice gives two rows; an empty file
gives none; white space and line breaks anywhere between the parts are fine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.sources import ranges as BR

OUTSIDE, INSIDE, ESCAPED = range(3)
_SPACE = b" \t\r\n"


def _escaped(data: np.ndarray, first: bool) -> np.ndarray:
    """Bytes behind an odd run of backslashes; ``first``: the run before the data was odd."""
    slash = data == 0x5C
    at = np.flatnonzero(slash)
    out = np.zeros(len(data) + 1, dtype=bool)
    if first:
        out[0] = True
    if len(at):
        # a run that starts at an escaped byte counts from the byte after it
        starts = at[np.diff(at, prepend=-2) != 1]
        ends = at[np.diff(at, append=at[-1] + 2) != 1] + 1
        for a, z in zip(starts, ends, strict=True):
            a += 1 if out[a] else 0
            if a < z:
                out[np.arange(a + 1, z + 1, 2)] = True
    return out


class Automaton:
    """State and depth of a JSON reader over successive blocks of bytes."""

    def __init__(self, state: int, depth: int = 0):
        self.state, self.depth = state, depth

    def read(self, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Moves over a block; gives the places outside strings where the depth
        changes or a comma stands, the bytes there and the depths behind them."""
        data = np.frombuffer(block, dtype=np.uint8)
        if self.state == OUTSIDE and 0x5C not in block and 0x22 not in block:
            outside = np.flatnonzero((data == 0x7B) | (data == 0x7D) | (data == 0x5B) | (data == 0x5D) | (data == 0x2C))
        else:
            escaped = _escaped(data, self.state == ESCAPED)
            quote = (data == 0x22) & ~escaped[:-1]
            inside = (np.cumsum(quote) + (self.state != OUTSIDE)) % 2 == 1  # the opening quote counts as inside
            signs = (data == 0x7B) | (data == 0x7D) | (data == 0x5B) | (data == 0x5D) | (data == 0x2C)
            outside = np.flatnonzero(signs & ~inside)
            if len(data):
                self.state = OUTSIDE if not inside[-1] else ESCAPED if escaped[-1] else INSIDE
        kind = data[outside]
        change = ((kind == 0x7B) | (kind == 0x5B)).astype(np.int64) - ((kind == 0x7D) | (kind == 0x5D))
        depth = self.depth + np.cumsum(change)
        if len(depth):
            self.depth = int(depth[-1])
        return outside, kind, depth


_SUMMARY = "file_path string, begin long, end long, first string, states array<int>, depths array<long>"


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for row in b.to_pylist():
            readers = [Automaton(s) for s in (OUTSIDE, INSIDE, ESCAPED)]
            first = ""
            for block in BR.blocks(row["file_path"], row["begin"], row["end"]):
                if not first:
                    first = block.removeprefix(BR.BOM if not row["begin"] else b"").lstrip(_SPACE)[:1].decode("latin-1")
                for r in readers:
                    r.read(block)
            out.append((row["file_path"], row["begin"], row["end"], first, [r.state for r in readers], [r.depth for r in readers]))
        yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())))],
            names=["file_path", "begin", "end", "first", "states", "depths"])


def _resolved(summaries: pa.Table) -> pa.Table:
    """The true state and depth at the start of each range of one file, in
    order; a document that starts with no brace has no entries."""
    state, depth, opened, out = OUTSIDE, 0, "", []
    for r in sorted(summaries.to_pylist(), key=lambda r: r["begin"]):
        out.append((r["file_path"], r["begin"], r["end"], state, depth))
        opened = opened or r["first"]
        depth += r["depths"][state]
        state = r["states"][state]
    out = out if opened == "{" else []
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(
        (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["file_path", "begin", "end", "state", "depth"])


def _entries_of(path: str, begin: int, end: int | None, state: int, depth: int) -> Iterator[bytes]:
    """The entries that start in [begin, end): behind the top-level brace or a top-level comma."""
    reader, at = Automaton(state, depth), begin
    held: list[bytes] | None = None  # the entry being read
    for block in BR.blocks(path, begin, None):
        if held is None and end is not None and at >= end:
            return
        places, kinds, depths = reader.read(block)
        top = ((kinds == 0x2C) & (depths == 1)) | ((kinds == 0x7B) & (depths == 1)) | ((kinds == 0x7D) & (depths == 0))
        start = 0
        for place, kind in zip(places[top].tolist(), kinds[top].tolist(), strict=True):
            if held is not None:
                held.append(block[start:place])
                yield b"".join(held)
                held = None
            if end is not None and at + place >= end:
                return
            if kind != 0x7D:
                held, start = [], place + 1
        if held is not None:
            held.append(block[start:])
        at += len(block)


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            held, size = [], 0
            for entry in _entries_of(row["file_path"], row["begin"], row["end"], row["state"], row["depth"]):
                held.append(entry)
                size += len(entry)
                if size >= BR.BATCH_BYTES or len(held) >= BR.BATCH_ROWS:
                    yield pa.record_batch([pa.array(held, pa.binary())], names=["entry"])
                    held, size = [], 0
            if held:
                yield pa.record_batch([pa.array(held, pa.binary())], names=["entry"])


def _document_entries(ranges: BR.Ranges) -> DataFrame:
    """The entries (``"key": value`` as text) of the top-level objects in a range table."""
    facts = ranges.spread(ranges.table, "file_path", "begin").mapInArrow(_summaries, _SUMMARY)
    placed = facts.groupBy("file_path").applyInArrow(_resolved, "file_path string, begin long, end long, state int, depth long")
    return ranges.spread(placed, "file_path", "begin").mapInArrow(_entries, "entry binary").select(F.col("entry").cast("string").alias("entry"))


def read_keyed_document(spark: SparkSession, path, fields: Sequence[str] = ("genome", "aa", "aux_genome"),
                        range_bytes: int = BR.RANGE_BYTES) -> DataFrame:
    """Transpose ``{key: {field: ...}}`` documents to rows (key, field...).

    Each file is one document of any size, read by a task per byte range;
    nested values are kept as JSON text. Stores that tasks cannot open are read
    a whole file a task.
    """
    ranges = BR.byte_ranges(spark, path, range_bytes)
    if ranges.opened:
        texts = _document_entries(ranges).select(F.concat(F.lit("{"), "entry", F.lit("}")).alias("value"))
    else:
        texts = spark.read.text(path, wholetext=True)
    value_type = "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"
    entries = texts.select(F.explode(F.from_json("value", f"map<string, {value_type}>")).alias("key", "v"))
    return entries.select("key", *[F.col(f"v.`{f}`").alias(f) for f in fields])
