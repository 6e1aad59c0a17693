"""Expectation suites (E1-E6), evaluated as one aggregate scan.

An expectation is ``{"expectation_type": name, "params": {...}}``; the type is
looked up by name in ``EXPECTATIONS`` (the reference dispatches by method name
on a validator). Value expectations ignore nulls and accept ``mostly``.
Unknown types are reported with status ``unknown`` and left out of the suite
statistics; expectations that cannot be built (missing column or bounds) get
status ``error`` and count as unsuccessful.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievekit.functions.patterns import pattern_error


@dataclass(frozen=True)
class Built:
    unexpected: Column | None = None      # per-row predicate (never null)
    domain: Column | None = None          # rows that count toward the percent
    exists: bool | None = None            # for table-level expectations
    error: str | None = None


def _column(df: DataFrame, params: Mapping) -> tuple[str | None, str | None]:
    name = params.get("column")
    if not name:
        return None, "missing 'column' parameter"
    if name not in df.columns:
        return name, f"column '{name}' not found"
    return name, None


def _not_null(df, params) -> Built:
    name, err = _column(df, params)
    if err:
        return Built(error=err)
    c = F.col(f"`{name}`")
    return Built(unexpected=c.isNull(), domain=F.lit(True))


def _match_regex(df, params) -> Built:
    name, err = _column(df, params)
    if err:
        return Built(error=err)
    regex = params.get("regex")
    if not regex:
        return Built(error="missing 'regex' parameter")
    wrong = pattern_error(df.sparkSession, regex)
    if wrong:
        return Built(error=f"malformed regex: {wrong}")
    c = F.col(f"`{name}`")
    text = c if isinstance(df.schema[name].dataType, T.StringType) else c.cast("string")
    return Built(unexpected=c.isNotNull() & ~F.coalesce(text.rlike(regex), F.lit(False)),
                 domain=c.isNotNull())


def _between(df, params) -> Built:
    name, err = _column(df, params)
    if err:
        return Built(error=err)
    lo, hi = params.get("min_value"), params.get("max_value")
    if lo is None and hi is None:
        return Built(error="min_value and max_value cannot both be None")
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.NumericType)):
        try:
            lo, hi = (None if v is None else v if isinstance(v, (int, float)) else float(v) for v in (lo, hi))
        except (TypeError, ValueError):
            return Built(error="min_value or max_value is no number")
    elif not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) or not _times(df, (lo, hi)):
        return Built(error=f"a {kind.simpleString()} column does not compare with these bounds")
    c = F.col(f"`{name}`")
    x = c.try_cast("double") if isinstance(df.schema[name].dataType, T.StringType) else c
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((x > F.lit(lo)) if params.get("strict_min") else (x >= F.lit(lo)))
    if hi is not None:
        ok = ok & ((x < F.lit(hi)) if params.get("strict_max") else (x <= F.lit(hi)))
    return Built(unexpected=c.isNotNull() & ~F.coalesce(ok, F.lit(False)), domain=c.isNotNull())


def _times(df: DataFrame, bounds) -> bool:
    """Whether every given bound is a date or time, or text that reads as one."""
    given = [b for b in bounds if b is not None]
    if any(isinstance(b, (int, float)) for b in given):
        return False
    row = df.sparkSession.range(1).select(*[F.try_to_timestamp(F.lit(str(b))).alias(f"b{i}") for i, b in enumerate(given)]).first()
    return all(v is not None for v in row)


def _column_exists(df, params) -> Built:
    name = params.get("column")
    if not name:
        return Built(error="missing 'column' parameter")
    return Built(exists=name in df.columns)


EXPECTATIONS: dict[str, Callable[[DataFrame, Mapping], Built]] = {
    "expect_column_values_to_not_be_null": _not_null,
    "expect_column_values_to_match_regex": _match_regex,
    "expect_column_values_to_be_between": _between,
    "expect_column_to_exist": _column_exists,
}

REPORT_SCHEMA = (
    "exp_idx int, expectation_type string, column string, status string, success boolean, "
    "element_count long, missing_count long, unexpected_count long, unexpected_percent double"
)


def expectation_report(df: DataFrame, expectations: Sequence[Mapping]) -> DataFrame:
    """One row per expectation from one aggregate over ``df``."""
    built = []
    aggs = [F.count(F.lit(1)).alias("__n")]
    for idx, exp in enumerate(expectations or []):
        etype = exp.get("expectation_type")
        params = exp.get("params") or {}
        builder = EXPECTATIONS.get(etype)
        b = builder(df, params) if builder else None
        built.append((idx, etype, params, b))
        if b is not None and b.unexpected is not None:
            c = F.col(f"`{params['column']}`")
            aggs += [F.count_if(b.unexpected).alias(f"__u{idx}"),
                     F.count_if(c.isNull()).alias(f"__m{idx}"),
                     F.count_if(b.domain).alias(f"__d{idx}")]
    if not built:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counts = df.agg(*aggs)
    rows = []
    null_long = F.lit(None).cast("long")
    for idx, etype, params, b in built:
        column = F.lit(params.get("column")).cast("string")
        if b is None:
            status, success = F.lit("unknown"), F.lit(None).cast("boolean")
            u = m = null_long
            pct = F.lit(None).cast("double")
            n = null_long
        elif b.error is not None:
            status, success = F.lit("error"), F.lit(False)
            n = u = m = null_long
            pct = F.lit(None).cast("double")
        elif b.exists is not None:
            success = F.lit(b.exists)
            status = F.lit("pass" if b.exists else "fail")
            n = u = m = null_long
            pct = F.lit(None).cast("double")
        else:
            n, u, m, d = F.col("__n"), F.col(f"__u{idx}"), F.col(f"__m{idx}"), F.col(f"__d{idx}")
            pct = F.when(d > 0, F.lit(100.0) * u / d)
            mostly = float(params.get("mostly", 1.0))
            success = F.when(d == 0, F.lit(True)).otherwise(((d - u) / d) >= F.lit(mostly))
            status = F.when(success, F.lit("pass")).otherwise(F.lit("fail"))
        rows.append(F.struct(
            F.lit(idx).alias("exp_idx"), F.lit(etype).cast("string").alias("expectation_type"),
            column.alias("column"), status.alias("status"), success.alias("success"),
            n.alias("element_count"), m.alias("missing_count"), u.alias("unexpected_count"),
            pct.alias("unexpected_percent")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def suite_statistics(report: DataFrame) -> DataFrame:
    """Success, counts and ``success_percent`` (null for an empty suite)."""
    evaluated = report.filter(F.col("status") != "unknown")
    return evaluated.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        F.when(F.count(F.lit(1)) > 0,
               F.lit(100.0) * F.count_if(F.col("success")) / F.count(F.lit(1))).alias("success_percent"),
    )


def expectation_samples(df: DataFrame, expectations: Sequence[Mapping], n: int = 20) -> DataFrame:
    """The partial unexpected list: up to ``n`` unexpected values per value
    expectation, smallest first (as text), with their repeat counts.

    One narrow pass emits (expectation, value) for failing cells; values are
    pre-aggregated to counts, then ``row_number() <= n`` (partial
    WindowGroupLimit before the shuffle) keeps the first ``n`` per expectation.
    """
    from pyspark.sql.window import Window

    hits = []
    for idx, exp in enumerate(expectations or []):
        builder = EXPECTATIONS.get(exp.get("expectation_type"))
        b = builder(df, exp.get("params") or {}) if builder else None
        if b is None or b.unexpected is None:
            continue
        col = exp["params"]["column"]
        hits.append(F.when(b.unexpected, F.struct(F.lit(idx).alias("exp_idx"),
                                                  F.col(f"`{col}`").cast("string").alias("value"))))
    if not hits:
        return df.sparkSession.createDataFrame([], "exp_idx int, value string, n_rows long, rank int")
    cells = df.select(F.explode(F.array(*hits)).alias("h")).filter(F.col("h").isNotNull()).select("h.*")
    counted = cells.groupBy("exp_idx", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy("exp_idx").orderBy(F.col("value").asc_nulls_first())
    return counted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
