"""Run logs as a stream: new log lines parsed as they arrive.

Parsing (L1, L2) is row-local, so the batch parser applies to a
``readStream`` text source unchanged. ``level_counts`` keeps per-window,
per-level counts with a watermark on the parsed log time, so the state of
closed windows is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.operators.runlog import parse_log_lines


def stream_run_logs(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming parsed log lines (``log_file`` is the file name)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(path).select("value", F.col("_metadata.file_name").alias("log_file"))
    return parse_log_lines(lines)


def level_counts(parsed: DataFrame, window: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Per event-time window and level: parsed lines; bad lines are counted apart."""
    timed = parsed.withColumn("__t", F.col("time").cast("timestamp")).withWatermark("__t", watermark)
    return timed.groupBy(F.window("__t", window).alias("window"), F.col("level")).agg(
        F.count(F.lit(1)).alias("n_lines"))
