"""Sinks (S8, S9, S10).

``write_table`` publishes: the rows are written to a folder of their own and
read back before anything that readers see changes, so a write that fails
leaves the old rows where they were. What is replaced is never both at once:

* with a table name, every write is a version folder under ``path``, and the
  table's location is switched to it (one catalog change; the version before is
  kept for readers that are still at it);
* without one, the new folder takes the place of ``path`` by renaming. A
  process that dies between the two renames leaves the old rows beside it, and
  the next write (or ``restore``) puts them back first.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.session import stage_table  # noqa: F401  (S9: typed save/load between stages)


class SchemaConflict(Exception):
    """A column of the old rows has another type in the new ones."""


def _store(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    files, folder = _store(spark, path)
    return files.exists(folder)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    files, folder = _store(spark, old)
    if not files.rename(folder, _store(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _store(spark, path)
    files.delete(folder, True)


def _aside(path: str) -> str:
    """Where the old rows wait while the new ones take their place; hidden from readers."""
    head, name = posixpath.split(path.rstrip("/"))
    return posixpath.join(head, f"_{name}.before")


def restore(spark: SparkSession, path: str) -> bool:
    """Put back rows that a write which died between its renames left aside."""
    if _exists(spark, path) or not _exists(spark, _aside(path)):
        return False
    _rename(spark, _aside(path), path)
    return True


def merged_columns(new: DataFrame, old: DataFrame) -> DataFrame:
    """``new`` with the columns of ``old`` first (null where it lacks them), then its own."""
    kinds = dict(new.dtypes)
    wrong = [c for c, t in old.dtypes if kinds.get(c, t) != t]
    if wrong:
        raise SchemaConflict(f"columns of another type than before: {', '.join(wrong)}")
    kept = [F.col(f"`{c}`") if c in kinds else F.lit(None).cast(t).alias(c) for c, t in old.dtypes]
    return new.select(*kept, *[F.col(f"`{c}`") for c in new.columns if c not in old.columns])


def _name(table: str) -> str:
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in table.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    facts = spark.sql(f"DESCRIBE FORMATTED {_name(table)}").filter("col_name = 'Location'").first()
    return facts["data_type"] if facts else None


def write_table(df: DataFrame, path: str, fmt: str = "parquet", table: str | None = None,
                mode: str = "overwrite", merge_schema: bool = True) -> str:
    """Publish rows at ``path`` (an empty result replaces old rows too) and
    return the folder that holds them.

    ``merge_schema`` keeps the columns of the old rows: the new ones have null
    in those they lack; a column that changed its type is an error, before
    anything is written. ``mode`` "append" adds the rows as files of their own
    (Spark's commit makes them visible at once, or not at all).
    """
    spark = df.sparkSession
    if table is None:
        restore(spark, path)
    here = path if table is None else _location(spark, table)
    before = spark.read.format(fmt).load(here) if here and _exists(spark, here) else None
    if before is not None and merge_schema:
        df = merged_columns(df, before)
    if mode == "append" and here:
        df.write.mode("append").format(fmt).save(here)
        if table is not None:
            _publish(spark, table, fmt, here, df)
        return here
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    unit = uuid.uuid4().hex[:12]
    head, name = posixpath.split(path.rstrip("/"))
    new = posixpath.join(path, f"v-{unit}") if table is not None else posixpath.join(head, f"_{name}.{unit}")
    try:
        df.write.mode("error").format(fmt).save(new)
        spark.read.format(fmt).schema(df.schema).load(new).count()  # every file of it can be opened
    except Exception:
        _delete(spark, new)
        raise
    if table is not None:
        _publish(spark, table, fmt, new, df)
        _forget(spark, path, {new, here})
        return new
    aside = _aside(path)
    _delete(spark, aside)
    if _exists(spark, path):
        _rename(spark, path, aside)
    try:
        _rename(spark, new, path)
    except Exception:
        restore(spark, path)
        raise
    _delete(spark, aside)
    return path


def _publish(spark: SparkSession, table: str, fmt: str, location: str, df: DataFrame) -> None:
    """Point the table at ``location``; columns that it does not have yet are added first."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {_name(table)} USING {fmt} LOCATION {_text(location)}")
        return
    known = {c.lower() for c in spark.table(table).columns}
    added = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {_name(table)} ADD COLUMNS ({', '.join(added)})")
    spark.sql(f"ALTER TABLE {_name(table)} SET LOCATION {_text(location)}")
    spark.catalog.refreshTable(table)


def _forget(spark: SparkSession, path: str, kept: set[str | None]) -> None:
    """Delete version folders but for the published one and the one before."""
    files, folder = _store(spark, path)
    names = {posixpath.basename(k.rstrip("/")) for k in kept if k}
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in names:
            files.delete(status.getPath(), True)


def write_name_list(df: DataFrame, column: str, path: str) -> None:
    """One name per line, as text files."""
    df.select(df[column].cast("string")).write.mode("overwrite").text(path)
