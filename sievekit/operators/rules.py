"""Row rules (R1-R11): not_null, regex_match, numeric_range, allowed_values.

All rules of a table are compiled to boolean ``Column`` predicates and counted
in ONE aggregate over the table (``count_if`` per rule), so N rules cost one
scan with map-side partial aggregation, whatever N is. The one-row result is
unpivoted into the report, one row per rule.

Semantics (defaults; see README):
* a null value passes regex/range/allowed rules; ``not_null`` owns nulls
  (``nulls="fail"`` makes null a violation of every rule);
* ``not_null`` also flags the empty string (string columns only);
* regex searches anywhere (``anchored=True`` anchors at the start);
* numeric_range parses with ``try_cast``; non-null text that does not parse is
  a violation (``not_numeric=True``); NaN sorts above every number, so
  ``NaN > max`` is a violation;
* bad rules (unknown type, unknown column, missing or malformed pattern, no
  bounds or bounds that are no numbers, a column that is no number, an empty
  value list or one that does not compare) become report rows with an error
  status; other rules still run.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sievekit.functions.patterns import pattern_error

# The rule type names of the config format, and the message a
# rule gets when its config gives none.
RULE_TYPES = ("not_null", "regex_match", "numeric_range", "allowed_values")
DEFAULT_MESSAGE = "Validation failed for {column}"

REPORT_COLUMNS = (
    "rule_idx", "rule_id", "kind", "column", "status",
    "n_rows", "n_nulls", "n_violations", "message",
)


@dataclass(frozen=True)
class CompiledRule:
    idx: int
    rule_id: str
    kind: str
    column: str | None
    message: str
    violation: Column | None  # boolean, never null; None when status is set
    status: str | None = None
    reason: Column | None = None  # why a violating row fails


def _default_message(column) -> str:
    return DEFAULT_MESSAGE.format(column=column)


def _as_text(value) -> str:
    """A config value as Spark writes it."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def _comparable(kind: T.DataType, values) -> bool:
    """Whether literals compare with a typed column without a failing cast."""
    if isinstance(kind, T.BooleanType):
        return all(isinstance(v, bool) for v in values)
    if isinstance(kind, T.NumericType):
        return all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values)
    return all(isinstance(v, (datetime.date, datetime.datetime)) for v in values) and isinstance(
        kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def compile_rules(
    df: DataFrame,
    rules: Sequence[Mapping],
    *,
    nulls: str = "pass",
    trim: bool = False,
    anchored: bool = False,
    not_numeric: bool = True,
) -> list[CompiledRule]:
    """Turn rule dicts into predicates against ``df``'s schema."""
    if nulls not in ("pass", "fail"):
        raise ValueError("nulls must be 'pass' or 'fail'")
    types = {f.name: f.dataType for f in df.schema.fields}
    out: list[CompiledRule] = []
    for idx, rule in enumerate(rules or []):
        column = rule.get("column")
        kind = rule.get("validation_type")
        rule_id = f"{column} - {kind}"
        message = rule.get("error_message") or _default_message(column)

        def bad(status: str, text: str) -> CompiledRule:
            return CompiledRule(idx, rule_id, str(kind), column, text, None, status)

        if kind not in RULE_TYPES:
            out.append(bad("unknown_type", f"Unknown validation type: {kind}"))
            continue
        if column not in types:
            out.append(bad("unknown_column", f"Unknown column: {column}"))
            continue
        is_string = isinstance(types[column], T.StringType)
        c = F.col(f"`{column}`")
        if trim and is_string:
            c = F.trim(c)
        is_null = c.isNull()

        if kind == "not_null":
            pred = (is_null | (c == F.lit(""))) if is_string else is_null
            reason = F.when(is_null, F.lit("null")).otherwise(F.lit("empty"))
        elif kind == "regex_match":
            pattern = rule.get("pattern")
            if not pattern:
                out.append(bad("error", f"Missing pattern for regex_match on column {column}"))
                continue
            wrong = pattern_error(df.sparkSession, pattern)
            if wrong:
                out.append(bad("error", f"Malformed pattern for regex_match on column {column}: {wrong}"))
                continue
            if anchored:
                pattern = f"^(?:{pattern})"
            text = c if is_string else c.cast("string")
            pred = ~text.rlike(pattern)
            reason = F.lit("no_match")
        elif kind == "numeric_range":
            lo, hi = rule.get("min"), rule.get("max")
            if lo is None and hi is None:
                out.append(bad("error", f"numeric_range on {column} has neither min nor max"))
                continue
            if not (is_string or isinstance(types[column], T.NumericType)):
                out.append(bad("error", f"numeric_range on {column}: a {types[column].simpleString()} column is no number"))
                continue
            try:
                lo, hi = (None if v is None else float(v) for v in (lo, hi))
            except (TypeError, ValueError):
                out.append(bad("error", f"numeric_range on {column}: a bound is no number"))
                continue
            x = c.try_cast("double") if is_string else c.cast("double")
            pred = F.lit(False)
            reason = F.when(c.isNotNull() & x.isNull(), F.lit("not_numeric"))
            if lo is not None:
                pred = pred | (x < F.lit(lo))
                reason = reason.when(x < F.lit(lo), F.lit("below_min"))
            if hi is not None:
                pred = pred | (x > F.lit(hi))
                reason = reason.when(x > F.lit(hi), F.lit("above_max"))
            if not_numeric and is_string:
                pred = pred | (c.isNotNull() & x.isNull())
        else:  # allowed_values
            values = rule.get("values") or []
            if isinstance(values, str) or not hasattr(values, "__iter__"):
                out.append(bad("error", f"allowed_values on {column}: values is not a list"))
                continue
            if not values:
                out.append(bad("error", f"allowed_values on {column} has an empty value list"))
                continue
            reason = F.lit("not_allowed")
            if is_string or any(isinstance(v, str) for v in values):
                # config values are text: compare as text instead of letting
                # ANSI casts turn the literals into the column's type, or the column into theirs
                pred = ~c.cast("string").isin([_as_text(v) for v in values])
            elif not _comparable(types[column], values):
                out.append(bad("error", f"allowed_values on {column}: values do not compare with {types[column].simpleString()}"))
                continue
            else:
                pred = ~c.isin(list(values))

        pred = F.coalesce(pred, F.lit(False))
        if nulls == "fail":
            pred = pred | is_null
        elif kind != "not_null":
            pred = pred & ~is_null
        reason = F.when(is_null, F.lit("null")).otherwise(reason)
        out.append(CompiledRule(idx, rule_id, kind, column, message, pred, reason=reason))
    return out


def _null_count(df: DataFrame, column: str | None) -> Column:
    return F.count_if(F.col(f"`{column}`").isNull())


def _sample_row(r: CompiledRule, key_columns: Sequence[str]) -> Column:
    """What violations of a rule are ordered by: value as text, then the keys."""
    return F.struct(F.col(f"`{r.column}`").cast("string").alias("value"),
                    *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(key_columns)])


THINNED = 16  # one in so many violations is looked at for a cut


def _cut(row: Column, of: Column, n: int) -> Column:
    """A (value, keys) that at least ``n`` violations of a rule do not exceed.

    One in ``THINNED`` violations is dealt into ``n`` classes by a hash; the
    smallest of every class is at most the largest of these ``n`` minima, and
    they are ``n`` different rows. About ``THINNED * n * ln(n)`` rows lie below.
    Null when a class has none: then nothing is cut.
    """
    least = [F.min(F.when(of == i, row)) for i in range(n)]
    every = reduce(Column.__and__, [x.isNotNull() for x in least])
    return F.when(every, F.greatest(*least) if n > 1 else least[0])


def rule_counts(df: DataFrame, rules: Sequence[Mapping], key_columns: Sequence[str] = (), n_samples: int = 0, **options) -> DataFrame:
    """One row: the counts of all rules, and with ``n_samples`` a cut per rule
    below which its first ``n_samples`` violations by (value, keys) lie. Pass
    it (staged) to ``rule_report`` and ``violation_samples``, and both together
    read the table twice, whatever the number of rules."""
    compiled = compile_rules(df, rules, **options)
    aggs = [F.count(F.lit(1)).alias("__n")]
    nulls = _null_names(compiled)
    aggs += [_null_count(df, column).alias(name) for column, name in nulls.items()]
    classes, rows = {}, {}
    for r in compiled:
        if r.violation is not None:
            aggs.append(F.count_if(r.violation).alias(f"__v{r.idx}"))
            if n_samples:
                row_hash = F.xxhash64(F.col(f"`{r.column}`"), *[F.col(f"`{k}`") for k in key_columns])
                of = F.col(f"__of{r.idx}")
                classes[f"__of{r.idx}"] = F.when(r.violation, F.pmod(row_hash, F.lit(THINNED * n_samples)))
                rows[f"__row{r.idx}"] = F.when(of < n_samples, _sample_row(r, key_columns))
                aggs.append(_cut(F.col(f"__row{r.idx}"), of, n_samples).alias(f"__c{r.idx}"))
    if rows:
        df = df.withColumns(classes).withColumns(rows)
    return df.agg(*aggs)


def _null_names(compiled: Sequence[CompiledRule]) -> dict[str, str]:
    """One null count per column, whatever the number of its rules."""
    columns = dict.fromkeys(r.column for r in compiled if r.violation is not None)
    return {column: f"__z{i}" for i, column in enumerate(columns)}


def rule_report(df: DataFrame, rules: Sequence[Mapping], counts: DataFrame | None = None, **options) -> DataFrame:
    """One report row per rule, from a single aggregate scan (or
    from the ``counts`` of ``rule_counts``)."""
    compiled = compile_rules(df, rules, **options)
    nulls = _null_names(compiled)
    if counts is None:
        counts = rule_counts(df, rules, **options)
    rows = []
    for r in compiled:
        if r.violation is not None:
            v, z = F.col(f"__v{r.idx}"), F.col(nulls[r.column])
            status = F.when(v == 0, F.lit("pass")).otherwise(F.lit("fail"))
        else:
            v = z = F.lit(None).cast("long")
            status = F.lit(r.status)
        rows.append(F.struct(
            F.lit(r.idx).alias("rule_idx"),
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.kind).alias("kind"),
            F.lit(r.column).cast("string").alias("column"),
            status.alias("status"),
            F.col("__n").alias("n_rows"),
            z.alias("n_nulls"),
            v.alias("n_violations"),
            F.lit(r.message).alias("message"),
        ))
    if not rows:
        schema = ("rule_idx int, rule_id string, kind string, column string, status string, "
                  "n_rows long, n_nulls long, n_violations long, message string")
        return df.sparkSession.createDataFrame([], schema)
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def passed_rules(report: DataFrame, mode: str = "no_failures") -> DataFrame:
    """Sorted distinct keys of passed rules.

    ``no_failures`` (default): no row violated the rule. ``any_row``: at
    least one row satisfied it (the row-at-a-time checker's reading).
    """
    if mode == "no_failures":
        passed = F.col("status") == "pass"
    elif mode == "any_row":
        passed = F.col("status").isin("pass", "fail") & (F.col("n_rows") > F.col("n_violations"))
    else:
        raise ValueError("mode must be 'no_failures' or 'any_row'")
    # at most one row per configured rule: sort it in one partition instead of
    # a range-partitioned global sort (which samples its input in an extra job)
    return report.filter(passed).select("rule_id").distinct().coalesce(1).sortWithinPartitions("rule_id")


def validation_summary(report: DataFrame, file_path: str | None = None) -> DataFrame:
    """``{file_path, validation_errors[], success}``; the report has one row per rule."""
    bad = F.col("status") != "pass"
    return report.agg(
        F.lit(file_path).cast("string").alias("file_path"),
        F.sort_array(F.collect_list(F.when(bad, F.concat_ws(": ", "rule_id", "message")))).alias("validation_errors"),
        (F.count_if(bad) == 0).alias("success"),
        F.count(F.lit(1)).alias("n_rules"),
    )


def violation_rows(
    df: DataFrame, rules: Sequence[Mapping], key_columns: Sequence[str], **options
) -> DataFrame:
    """One row per (row, failed rule): keys, rule, column, value as text and
    the reason (null, empty, not_numeric, below_min, above_max, not_allowed,
    no_match).

    A single narrow pass: each row emits the array of its failed rules, which is
    exploded. No shuffle.
    """
    compiled = [r for r in compile_rules(df, rules, **options) if r.violation is not None]
    hits = [
        F.when(r.violation, F.struct(
            F.lit(r.idx).alias("rule_idx"),
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.column).alias("column"),
            F.col(f"`{r.column}`").cast("string").alias("value"),
            r.reason.alias("reason"),
        ))
        for r in compiled
    ]
    keys = [F.col(f"`{k}`") for k in key_columns]
    if not hits:
        return df.select(*keys, F.lit(None).cast("int").alias("rule_idx"),
                         F.lit(None).cast("string").alias("rule_id"),
                         F.lit(None).cast("string").alias("column"),
                         F.lit(None).cast("string").alias("value"),
                         F.lit(None).cast("string").alias("reason")).limit(0)
    # explode the per-rule array and drop the nulls afterwards: a higher-order
    # ``filter`` on the array would run outside whole-stage codegen (measured
    # about 4x slower)
    return (df.select(*keys, F.explode(F.array(*hits)).alias("h")).filter(F.col("h").isNotNull())
            .select(*key_columns, "h.*"))


def violation_samples(
    df: DataFrame, rules: Sequence[Mapping], key_columns: Sequence[str], n: int = 5, counts: DataFrame | None = None, **options
) -> DataFrame:
    """The first ``n`` violations per rule by (value, keys) — deterministic.

    The counts (``rule_counts`` with ``n_samples=n``; made here if not given)
    hold a cut per rule. One scan then takes, for all failing rules, the few
    violations below their cuts, which are ranked. A rule without a cut (few
    violations, or masses of equal ones) is ranked over all of them, at most
    ``n`` a task moving on. Clean rules add nothing.
    """
    compiled = [r for r in compile_rules(df, rules, **options) if r.violation is not None]
    if not compiled or n < 1:
        return violation_rows(df, rules, key_columns, **options).drop("reason").withColumn("rank", F.lit(None).cast("int")).limit(0)
    if counts is None:
        counts = rule_counts(df, rules, key_columns, n, **options)
    cut = {r.idx: F.col("__cuts")[f"__c{r.idx}"] for r in compiled}
    hits = [
        F.when(r.violation & (cut[r.idx].isNull() | (_sample_row(r, key_columns) <= cut[r.idx])), F.struct(
            F.lit(r.idx).alias("rule_idx"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.column).alias("column"),
            F.col(f"`{r.column}`").cast("string").alias("value")))
        for r in compiled
    ]
    # the cuts are a column, so that the one row of counts is worked out once
    cuts = counts.select(F.struct(*[f"__c{r.idx}" for r in compiled])).scalar()
    found = df.withColumn("__cuts", cuts).select(*[F.col(f"`{k}`") for k in key_columns], F.explode(F.array(*hits)).alias("h")).filter(
        F.col("h").isNotNull()).select(*[F.col(f"`{k}`") for k in key_columns], "h.*")
    order = [F.col("value").asc_nulls_first()] + [F.col(f"`{k}`").asc_nulls_first() for k in key_columns]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("rule_idx").orderBy(*order))).filter(F.col("rank") <= n)
