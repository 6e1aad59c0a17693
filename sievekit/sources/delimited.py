"""Delimited and line sources (S1, S2, S6, R9), all values read as strings.

One header for all files: Spark's CSV reader. Files with headers of their own,
files with lines before the header, and rows addressed by line are read as
byte ranges inside tasks (``ranges``): one job looks at the heads of all
files, ranges learn their file's header from it, and lines carry the number of
their header, so no file name and no line reaches the driver (the distinct
headers do: they are the columns).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievekit.functions.sizing import broadcast_if_small
from sievekit.session import stage_table
from sievekit.sources import ranges as BR


def read_delimited(spark: SparkSession, path, sep: str = "\t", header: bool = True,
                   comment: str | None = None) -> DataFrame:
    """Header file, every column a string (no schema inference).

    ``comment`` skips lines starting with that character (for files whose
    leading note is marked and whose header is not)."""
    if header and not comment:
        source = _Headed(spark, path, sep, 1)
        if len(source.headers) > 1:  # the CSV reader would read all files under the first one's header
            return source.parsed(source.lines())
    reader = (spark.read.option("header", str(header).lower()).option("sep", sep)
              .option("inferSchema", "false"))
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(path)


def first_lines(spark: SparkSession, path, n: int = 5) -> DataFrame:
    """The first ``n`` lines of every file: (file_path, line_number, value).

    One job for any number of files; each is opened for its first lines only."""
    ranges = BR.byte_ranges(spark, path)
    if ranges.opened:
        return BR.read_heads(ranges, n).drop("after")
    return _numbered_by_reader(spark, path).filter(F.col("line_number") <= n).select(
        "file_path", F.col("line_number").cast("int").alias("line_number"), "value")


class _Headed:
    """Files whose line ``line`` names their columns; what stands above is no data."""

    def __init__(self, spark: SparkSession, path, sep: str, line: int):
        self.spark, self.path, self.sep, self.line = spark, path, sep, line
        self.ranges = BR.byte_ranges(spark, path)
        heads = BR.read_heads(self.ranges, line) if self.ranges.opened else _numbered_by_reader(spark, path).withColumn(
            "after", F.lit(None).cast("long"))
        names = F.transform(F.split("value", _literal(sep), -1), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
        heads = heads.filter(F.col("line_number") == line).select("file_path", names.alias("names"), "after")
        self.heads = stage_table(heads, "file-heads")
        # as many rows as there are different headers
        found = self.heads.groupBy("names").agg(F.min("file_path").alias("first")).orderBy("first").collect()
        if not found:
            raise ValueError(f"no header line found in {path}")
        self.headers = [tuple(r["names"]) for r in found]
        numbers = spark.createDataFrame([(i, list(h)) for i, h in enumerate(self.headers)], "header int, names array<string>")
        self.files = self.heads.join(F.broadcast(numbers), "names").select("file_path", "header", "after", F.size("names").alias("n_names"))

    def lines(self, numbered: bool = False) -> DataFrame:
        """(file_path, header, n_names, value and, if ``numbered``, line_number) of the data lines."""
        keep = ("file_path", "header", "n_names")
        if not self.ranges.opened:
            every = _numbered_by_reader(self.spark, self.path).filter(F.col("line_number") > self.line)
            return every.join(broadcast_if_small(self.files), "file_path").select(*keep, "value", "line_number")
        mine = BR.numbered_ranges(self.ranges) if numbered else self.ranges.table
        mine = mine.join(self.files.filter("after is not null"), "file_path").filter(F.col("end").isNull() | (F.col("end") > F.col("after")))
        out = BR.read_lines(self.ranges, mine, (*keep, "after")).filter(F.col("offset") >= F.col("after"))
        return out.select(*keep, "value", *(["line_number"] if numbered else []))

    def parsed(self, lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``value`` of each file parsed under the file's own header; files with
        other columns are stacked by name."""
        if len(self.headers) == 1:
            fields = F.from_csv("value", _ddl(self.headers[0]), {"sep": self.sep})
            return lines.select(*keep, fields.alias("r")).select(*[F.col(f"r.`{n}`") for n in self.headers[0]], *keep)
        places = [f"_c{i}" for i in range(max(map(len, self.headers)))]
        fields = F.from_csv("value", _ddl(places), {"sep": self.sep})
        columns = []
        for name in dict.fromkeys(n for h in self.headers for n in h):
            own = [F.when(F.col("header") == i, F.col(f"r.{places[h.index(name)]}")) for i, h in enumerate(self.headers) if name in h]
            columns.append(F.coalesce(*own).alias(name))
        return lines.select("header", *keep, fields.alias("r")).select(*columns, *keep)


def _ddl(names) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in names)


def read_delimited_after_comment(spark: SparkSession, path, sep: str = "\t", skip: int = 1) -> DataFrame:
    """Drop ``skip`` leading lines of each file, take the next as header.

    Each file loses exactly its own head; a file whose columns are in another
    order, or others, keeps its own names. No line is numbered or copied.
    """
    source = _Headed(spark, path, sep, skip + 1)
    return source.parsed(source.lines())


def read_id_list(spark: SparkSession, path) -> DataFrame:
    """One id per line, stripped; blank lines skipped."""
    return (spark.read.text(path).select(F.trim("value").alias("id"))
            .filter(F.col("id") != ""))


def number_lines(spark: SparkSession, path) -> DataFrame:
    """Every line of every file with its exact 1-based line number in its file.

    Line ends are counted per byte range, a running sum over the ranges of each
    file gives every range its first line number, and the lines are read with
    it: two reads of the bytes, no copy, nothing that depends on split settings.
    """
    ranges = BR.byte_ranges(spark, path)
    if not ranges.opened:
        return _numbered_by_reader(spark, path)
    return BR.read_lines(ranges, BR.numbered_ranges(ranges)).select("file_path", "line_number", "value")


SPLIT_TABLE_MAX_BYTES = 64 * 1024 * 1024


def _numbered_by_reader(spark: SparkSession, path) -> DataFrame:
    """``number_lines`` for stores that only Spark's readers open.

    The lines are staged once with their split and their
    ``monotonically_increasing_id``, consecutive within a split; counts per
    split and the lines both come from that copy, so a layout that changes
    between two reads cannot lose lines. The split table is broadcast only
    under ``SPLIT_TABLE_MAX_BYTES``.
    """
    lines = stage_table(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id")), "lines")
    splits = lines.groupBy("file_path", "block_start").agg(
        F.count(F.lit(1)).alias("__n"), F.min("row_id").alias("__first_id"))
    w = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file_path", "block_start", "__first_id",
                            F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__offset"))
    offsets = stage_table(offsets, "line-offsets")
    numbered = lines.join(broadcast_if_small(offsets, SPLIT_TABLE_MAX_BYTES), ["file_path", "block_start"])
    return numbered.select("file_path", (F.col("__offset") + F.col("row_id") - F.col("__first_id") + 1)
                           .alias("line_number"), "value")


def read_delimited_numbered(spark: SparkSession, path, sep: str = "\t", skip: int = 0) -> DataFrame:
    """S1/S2 with row addresses: columns of the file plus ``file_path`` and
    ``line_number`` (the header is line ``skip + 1``), for R8 violation lists
    addressed by line, as the row-at-a-time checker reports them."""
    source = _Headed(spark, path, sep, skip + 1)
    return source.parsed(source.lines(numbered=True), keep=("file_path", "line_number"))


def short_rows(spark: SparkSession, path, sep: str = "\t", skip: int = 0) -> DataFrame:
    """Data lines with fewer fields than the header (a missing trailing
    field), which the CSV reader would silently fill with nulls.

    Rows are (file_path, line_number, n_fields, n_expected, value); each file's
    header is its line ``skip + 1``. Lines are numbered as in ``number_lines``.
    """
    source = _Headed(spark, path, sep, skip + 1)
    data = source.lines(numbered=True).withColumn("n_fields", F.size(F.split("value", _literal(sep), -1)))
    return data.filter(F.col("n_fields") < F.col("n_names")).select(
        "file_path", "line_number", "n_fields", F.col("n_names").alias("n_expected"), "value")


def _literal(sep: str) -> str:
    return re.escape(sep) if sep not in ("\t", "\n") else sep
