"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.functions.sizing import estimated_bytes
from sievekit.session import ship_package, stage_table

#: the white space of every word and text rule here: space, tab to carriage return
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: sides proven to take at most this much memory may be broadcast
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BYTES, _FIELD_BYTES, _PACKED = 64, 16, 3  # memory of a row and a field, and of a byte of Parquet

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write under the shared checkpoint folder and read back: cuts lineage,
    survives lost executors, and gives the optimizer a size it can trust."""
    return stage_table(df, f"llm-{name}")


def held_bytes(df: DataFrame) -> int | None:
    """Memory that a staged table takes as a broadcast: its rows are counted
    (from file footers), their values taken from its size, unpacked."""
    size = estimated_bytes(df)
    return None if size is None else df.count() * (_ROW_BYTES + _FIELD_BYTES * len(df.columns)) + _PACKED * size


def small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` (a staged table) is known to take at most ``max_bytes`` in memory."""
    size = estimated_bytes(df)
    if size is None or size > max_bytes:
        return False
    return (held_bytes(df) or 0) <= max_bytes


def hinted(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its size is proven small; else as it is,
    so the join shuffles and adaptive execution splits its hot partitions."""
    return F.broadcast(df) if small(df, max_bytes) else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as keep it off the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without_ids(df: DataFrame, id_col: str, ids: DataFrame, name: str) -> DataFrame:
    """``df`` without the rows whose id is in the only column of ``ids``;
    rows without an id stay. The ids are staged and broadcast if proven small."""
    gone = fresh(df, "gone")
    ids = stage(ids.toDF(gone).distinct(), name)
    return df.join(hinted(ids), df[id_col] == ids[gone], "left_anti")


def utf8_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, null counted as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def lower_az(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


#: rows of an Arrow batch: texts are long, and a task holds a batch several times over
ARROW_ROWS = 500


def prepare_python(spark: SparkSession) -> None:
    """Ready a session for Python tasks over texts: Arrow batches of at most
    ``ARROW_ROWS`` rows (the session's setting is lowered, never raised; Spark
    bounds their bytes besides), and this package sent to the executors."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting, "10000")) <= ARROW_ROWS:
        spark.conf.set(setting, str(ARROW_ROWS))
    ship_package(spark)
