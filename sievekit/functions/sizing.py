"""Size-checked broadcast, and rows dealt out by their number.

``broadcast_if_small`` hints a broadcast only when the optimizer's size
estimate of the side is known and under a bound; otherwise it leaves the join
alone, so Spark keeps a shuffle join (and AQE may still switch to a broadcast
from runtime statistics, under ``spark.sql.autoBroadcastJoinThreshold``).
``dealt_out`` is for work whose cost goes by rows, where bytes say little.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's byte units, all binary
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


ROW_BYTES = 64  # memory that a broadcast row takes besides the bytes of its values, counted generously


def parse_bytes(text) -> int | None:
    """A byte setting such as ``10485760``, ``64m``, ``1MB`` or ``-1``; None
    when it cannot be read (then nothing is hinted)."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", str(text).lower())
    return int(m[1]) * _UNITS[m[2]] if m and m[2] in _UNITS else None


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` in bytes, or None if unavailable."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # Spark Connect or a plan without statistics
        return None


def broadcast_limit(spark: SparkSession, max_bytes: int | None = None) -> int:
    """``max_bytes``, or ``spark.sql.autoBroadcastJoinThreshold``; 0 when nothing may be broadcast."""
    if max_bytes is None:
        max_bytes = parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    return max(0, max_bytes or 0)


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the optimizer's size estimate of ``df`` is known and at most
    ``max_bytes`` (default: ``spark.sql.autoBroadcastJoinThreshold``)."""
    limit = broadcast_limit(df.sparkSession, max_bytes)
    size = estimated_bytes(df)
    return limit > 0 and size is not None and size <= limit


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Return ``F.broadcast(df)`` if its estimated size is at most ``max_bytes``."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def dealt_out(df: DataFrame, task_rows: int) -> DataFrame:
    """``df`` in even partitions of about ``task_rows`` rows, which are counted
    first (a table's from file footers). Spark cuts scans by bytes, so rows that are
    packed tightly and cost much would all be one task's."""
    return df.repartition(max(1, -(-df.count() // task_rows)))
