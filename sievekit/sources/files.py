"""File-level checks (F1, F2) and per-member file resolution.

Listings come from the ``binaryFile`` source reading only ``path`` and
``length`` (the content column is pruned, so no file body is read).
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Iterator, Mapping, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.session import ship_package
from sievekit.sources import ranges as BR
from sievekit.sources.delimited import first_lines


def _strip_scheme(c: Column) -> Column:
    return F.regexp_replace(c, r"^file:(//)?", "")


def _is_missing(exc: Exception) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "does not exist" in text or "FileNotFound" in text


def list_files(spark: SparkSession, directories: Sequence[str], glob: str | None = None,
               errors: dict | None = None) -> DataFrame:
    """(path, length) of the files in ``directories``; a missing folder lists
    nothing, and any other listing failure is recorded in ``errors``."""
    parts = []
    for d in dict.fromkeys(directories):
        reader = spark.read.format("binaryFile")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        try:
            df = reader.load(d).select(_strip_scheme(F.col("path")).alias("path"), "length")
            df.schema  # resolve now: a missing folder raises here
        except Exception as exc:  # noqa: BLE001 - reported per folder, never fatal
            if errors is not None and not _is_missing(exc):
                errors[d] = f"{type(exc).__name__}: {exc}"
            continue
        parts.append(df)
    if not parts:
        return spark.createDataFrame([], "path string, length long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _manifest_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        facts = [BR.file_facts(p) for p in b.column("file_path").to_pylist()]
        yield pa.record_batch([*b.columns, pa.array([f[0] for f in facts], pa.string()), pa.array([f[1] for f in facts], pa.int64()),
                               pa.array([f[2] for f in facts], pa.string())], names=[*b.schema.names, "status", "length", "error"])


def manifest_check(spark: SparkSession, input_files: Sequence[Mapping] | DataFrame) -> DataFrame:
    """every configured input file exists and opens: status ``found``,
    ``not_found``, or ``error`` with the reason (a folder, a path through a
    file, no right to read).

    ``input_files`` are config entries or a DataFrame of (idx, file_path) of any
    size: tasks look at the files, each path once however often it is listed.
    A null path is ``not_found``. In stores that tasks cannot open, the folders
    of config entries are listed instead.
    """
    if isinstance(input_files, DataFrame):
        manifest = input_files.select("idx", "file_path")
    else:
        rows = [(i, str(f.get("file_path"))) for i, f in enumerate(input_files)]
        if any(not _task_store(p) for _, p in rows):
            return _manifest_by_listing(spark, rows)
        manifest = spark.createDataFrame(rows, "idx int, file_path string")
    ship_package(spark)
    paths = manifest.select("file_path").filter("file_path is not null").distinct()
    facts = paths.mapInArrow(_manifest_rows, "file_path string, status string, length long, error string")
    return manifest.join(facts, "file_path", "left").select(
        "idx", "file_path", F.coalesce("status", F.lit("not_found")).alias("status"), "length", "error")


def _task_store(path: str) -> bool:
    """Whether tasks open this kind of store."""
    return urlsplit(path).scheme in ("", "file", "hdfs", "s3", "s3a", "gs")


def _manifest_by_listing(spark: SparkSession, rows: Sequence[tuple[int, str]]) -> DataFrame:
    folders = {p: posixpath.dirname(p) or "." for _, p in rows}
    errors: dict = {}
    files = list_files(spark, list(folders.values()), errors=errors)
    manifest = spark.createDataFrame([(i, p, errors.get(folders[p])) for i, p in rows], "idx int, file_path string, error string")
    m = manifest.withColumn("__p", _strip_scheme(F.col("file_path")))
    joined = m.join(files, m["__p"] == files["path"], "left")
    status = (F.when(F.col("error").isNotNull(), "error")
              .when(F.col("path").isNotNull(), "found").otherwise("not_found"))
    return joined.select("idx", "file_path", status.alias("status"), "length", "error")


def input_format_checks(spark: SparkSession, input_files: Sequence[Mapping], n: int = 5) -> DataFrame:
    """F2 over a config's inputs: the delimiter check for ``tsv`` entries;
    other file types are reported as ``skipped``."""
    rows = []
    for i, f in enumerate(input_files):
        path, kind = str(f.get("file_path")), str(f.get("file_type", "")).lower()
        if kind != "tsv":
            rows.append(spark.createDataFrame(
                [(i, path, "skipped", None, None)],
                "idx int, file_path string, status string, checked_lines long, is_valid boolean"))
            continue
        skip = str(f.get("ignore_first_line", "no")).strip().lower() == "yes"
        chk = delimiter_check(spark, path, f.get("delimiter", "\t"), n, skip)
        rows.append(chk.select(F.lit(i).alias("idx"), F.lit(path).alias("file_path"),
                               F.when(F.col("is_valid"), "valid").otherwise("invalid").alias("status"),
                               "checked_lines", "is_valid"))
    if not rows:
        return spark.createDataFrame([], "idx int, file_path string, status string, checked_lines long, is_valid boolean")
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def delimiter_check(spark: SparkSession, path, sep: str = "\t", n: int = 5, ignore_first_line: bool = False) -> DataFrame:
    """the delimiter occurs in each of the first ``n`` lines of each file
    (lines 2..n+1 when the first line is ignored).

    Returns one row per file: file_path, checked_lines, invalid_lines
    (array of (line_number, content)) and is_valid.
    """
    skip = 1 if ignore_first_line else 0
    head = first_lines(spark, path, n + skip).filter(F.col("line_number") > skip)
    bad = ~F.col("value").contains(sep)
    return head.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("checked_lines"),
        F.array_sort(F.collect_list(F.when(bad, F.struct(F.col("line_number").alias("line_number"),
                                                         F.col("value").alias("content"))))).alias("invalid_lines"),
    ).withColumn("is_valid", F.size("invalid_lines") == 0)


def lines_without_delimiter(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """F2, whole-file form: every line lacking the delimiter, per file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    return lines.filter(~F.col("value").contains(sep))


def resolve_member_files(
    spark: SparkSession, members: DataFrame, root: str, *, group: str = "group", member: str = "member",
    suffix: str = ".faa.gz", token: Column | None = None,
) -> DataFrame:
    """Exactly one file per (group, member) under ``root/<group>/``.

    A file belongs to a member when the member id equals the file's token;
    by default the token is the file name up to the second ``_`` (for names
    like ``GCF_000006945.2_ASM694v2_protein.faa.gz``). This is an equi-join,
    not a substring scan of every file against every member. Status is
    ``ok`` (one file), ``none`` or ``many``.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", f"*{suffix}").load(root).select(_strip_scheme(F.col("path")).alias("path"))
    parts = F.split("path", "/")
    files = listing.select(
        "path",
        F.element_at(parts, -2).alias("__group"),
        F.element_at(parts, -1).alias("__name"))
    tok = token if token is not None else F.regexp_extract(F.col("__name"), r"^([^_]+_[^_]+)", 1)
    files = files.withColumn("__token", tok)
    m = members.select(F.col(group).alias("__group"), F.col(member).alias("__member"))
    joined = m.join(files, (m["__group"] == files["__group"]) & (m["__member"] == files["__token"]), "left")
    out = joined.groupBy(m["__group"].alias(group), F.col("__member").alias(member)).agg(
        F.count("path").alias("n_matches"), F.min("path").alias("path"))
    return out.withColumn("status", F.when(F.col("n_matches") == 1, "ok")
                          .when(F.col("n_matches") == 0, "none").otherwise("many")) \
        .withColumn("path", F.when(F.col("n_matches") == 1, F.col("path")))
