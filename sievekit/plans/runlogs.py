"""Pipeline run logs derived from the ``events`` table.

Every event becomes one JSON log line of a daily log file. Error events carry
a non-BMP emoji and every message holds a raw tab (both valid for our parser);
lines of events with value above 200 are cut short and so are malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.operators.runlog import LOG_TIME_FORMAT
from sievekit.plans.tables import load

BAD_VALUE = 200


def _json_text(c):
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), '"', r'\\"')


def event_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(log_file, value): one JSON log line per event, one file per day."""
    e = load(spark, sf, "events")
    level = (F.when(F.col("event_type") == "error", "ERROR")
             .when(F.col("event_type") == "signup", "WARNING").otherwise("INFO"))
    msg = F.concat(F.when(F.col("event_type") == "error", F.lit("\U0001F6A8 ")).otherwise(F.lit("")),
                   F.col("event_type"), F.lit(" value="), F.col("value").cast("string"), F.lit("\t"),
                   F.col("props"))
    json_line = F.concat(
        F.lit('{"time": "'), F.date_format("ts", LOG_TIME_FORMAT),
        F.lit('", "pipeline": "events", "schema": "web", "table": "'), F.col("event_type"),
        F.lit('", "level": "'), level,
        F.lit('", "module": "user_'), F.col("user_id").cast("string"),
        F.lit('", "msg": "'), _json_text(msg), F.lit('"}'))
    log_file = F.concat(F.lit("pipeline_run_"), F.date_format("ts", "yyyyMMdd"), F.lit(".log"))
    lines = e.select(log_file.alias("log_file"), "value", json_line.alias("line"))
    # lines of large values lose their closing brace: malformed on purpose
    cut = F.expr("substring(line, 1, length(line) - 1)")
    return lines.select("log_file", F.when(F.col("value") > BAD_VALUE, cut).otherwise(F.col("line")).alias("value"))
