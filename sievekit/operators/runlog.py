"""Run-log analysis (L1-L7): JSON-lines pipeline logs as a DataFrame.

Each line is one JSON object with time, pipeline, schema, table, level,
module and msg. Lines are parsed with ``from_json`` in PERMISSIVE mode: a
line that is not valid JSON keeps its text in ``_corrupt_record`` and is
reported, not dropped silently. Raw control characters inside strings (tabs)
are accepted; non-BMP characters are kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_FIELDS = ("time", "pipeline", "schema", "table", "level", "module", "msg")
VIEW_COLUMNS = ("time", "pipeline", "schema", "table", "level", "module", "msg", "log_file")
FILTER_FIELDS = ("pipeline", "schema", "table", "level")
# Fixed value: the logger's time format (Java pattern letters).
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
ALL = "ALL"

_SCHEMA = ", ".join(f"`{f}` string" for f in LOG_FIELDS) + ", _corrupt_record string"
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "allowUnquotedControlChars": "true",
}


def parse_time(c: Column) -> Column:
    """L2: the logger format first, any ISO-like form second, else null (no error)."""
    ts = F.coalesce(F.try_to_timestamp(c, F.lit(LOG_TIME_FORMAT)), c.try_cast("timestamp"))
    return ts.cast("timestamp_ntz")


def parse_log_lines(lines: DataFrame, value: str = "value", file_col: str = "log_file") -> DataFrame:
    """L1 + L2: parse JSON lines; adds ``time`` (timestamp), ``raw_time``, ``is_bad``."""
    # The parsed struct is produced by a generator so the optimizer cannot
    # inline ``from_json`` into every later filter and field (it would parse
    # each line once per reference).
    parsed = lines.select(F.col(file_col).alias("log_file"), F.col(value).alias("__line"),
                          F.explode(F.array(F.from_json(F.col(value), _SCHEMA, _OPTIONS))).alias("__r"))
    bad = F.col("__r._corrupt_record").isNotNull() | F.col("__r").isNull()
    out = parsed.select(
        *[F.col(f"__r.`{f}`").alias(f) for f in LOG_FIELDS if f != "time"],
        F.col("__r.time").alias("raw_time"),
        parse_time(F.col("__r.time")).alias("time"),
        "log_file",
        bad.alias("is_bad"),
        F.when(bad, F.col("__line")).alias("bad_line"),
    )
    return out


def read_run_logs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S5 + L3: read one or many log files (or folders); ``log_file`` is the file name."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("log_file"))
    return parse_log_lines(lines)


def bad_line_report(parsed: DataFrame) -> DataFrame:
    """L1: per file, the number of lines and of lines that did not parse."""
    return parsed.groupBy("log_file").agg(F.count(F.lit(1)).alias("n_lines"),
                                          F.count_if("is_bad").alias("n_bad"))


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_bad"))


def select_files(parsed: DataFrame, files: Sequence[str] | None) -> DataFrame:
    """L3: keep the chosen files only (None = all)."""
    return parsed if not files else parsed.filter(F.col("log_file").isin(list(files)))


def filter_logs(
    parsed: DataFrame, *, pipeline: str | None = None, schema: str | None = None,
    table: str | None = None, level: str | None = None,
    start: dt.date | str | None = None, end: dt.date | str | None = None,
) -> DataFrame:
    """L4 + L6: equality filters (None or "ALL" = no filter) and an inclusive day range.

    The day range is ``time >= start`` and ``time < end + 1 day``; a missing
    bound defaults to the data's own min / max day (rows without a time drop
    out, as the comparison is null for them).
    """
    df = good_lines(parsed)
    for name, wanted in (("pipeline", pipeline), ("schema", schema), ("table", table), ("level", level)):
        if wanted is not None and wanted != ALL:
            df = df.filter(F.col(f"`{name}`") == F.lit(wanted))
    # A missing bound defaults to the data's first / last day, which every
    # non-null time satisfies, so it reduces to ``time IS NOT NULL`` — no
    # global min/max pass is needed.
    ts = F.col("time")
    cond = ts.isNotNull()
    if start is not None:
        cond = cond & (ts >= F.to_date(F.lit(str(start))).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (ts < F.date_add(F.to_date(F.lit(str(end))), 1).cast("timestamp_ntz"))
    return df.filter(cond)


def date_bounds(parsed: DataFrame) -> DataFrame:
    """L6 defaults: first and last day present."""
    return good_lines(parsed).agg(F.to_date(F.min("time")).alias("first_day"),
                                  F.to_date(F.max("time")).alias("last_day"))


def option_values(parsed: DataFrame, fields: Sequence[str] = FILTER_FIELDS) -> DataFrame:
    """Distinct non-null values of each filter field, as (field, value), sorted."""
    stacked = good_lines(parsed).select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value")) for f in fields])).alias("o"))
    return stacked.select("o.*").filter(F.col("value").isNotNull()).distinct().orderBy("field", "value")


def log_view(df: DataFrame) -> DataFrame:
    """The eight columns of the viewer table."""
    return df.select(*[F.col(f"`{c}`") for c in VIEW_COLUMNS])
