"""Config-driven table checks: the whole per-table sequence as one call.

``run_table_sequence`` runs the stages of a config one after another: input
files, their delimiters, columns against the schema, rules, foreign keys,
expectations, and the violation sink. Every stage is executed where it stands
and its result is written as a stage table, so a stage that fails while it runs
becomes an ``error`` row and the next ones still run; so does a single rule.

``run_table_checks`` takes a parsed config document (the JSON format with
``validations``, ``referential_integrity``, ``great_expectations_validations``
and ``transformations`` sections) and returns lazy report DataFrames; stages
are independent, as in the reference, so one failing stage does not stop the
others. ``write_fk_violations`` persists FK violations as the ``logging``
section says.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.operators import expectations as E
from sievekit.operators import integrity as J
from sievekit.operators import rules as R
from sievekit.operators import schema as S
from sievekit.operators.transforms import apply_transformations
from sievekit.session import stage_table
from sievekit.sources import delimited
from sievekit.sources.files import input_format_checks, manifest_check
from sievekit.sources.sinks import write_table


def read_output_file(spark: SparkSession, config: Mapping) -> DataFrame:
    """The configured output file: delimited, all strings; a first line marked
    ``ignore_first_line: yes`` is skipped before the header."""
    out = config.get("output_file") or {}
    sep = out.get("delimiter", "\t")
    if str(out.get("ignore_first_line", "no")).strip().lower() == "yes":
        return delimited.read_delimited_after_comment(spark, out["output_file_path"], sep)
    return delimited.read_delimited(spark, out["output_file_path"], sep)


def _guarded(spark: SparkSession, name: str, schema: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage's report; a stage that cannot be built is one row with status ``error``."""
    try:
        return build()
    except Exception as exc:  # noqa: BLE001 - stages are independent
        empty = spark.createDataFrame([], schema)
        text = f"{name}: {type(exc).__name__}: {exc}"
        given = {"status": F.lit("error"), "message": F.lit(text), "success": F.lit(False)}
        return spark.range(1).select(*[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema.fields])


def run_table_checks(
    spark: SparkSession, config: Mapping, target: DataFrame | None = None,
    resolve: J.Resolver | None = None, **rule_options,
) -> dict[str, DataFrame]:
    """Reports for rules, foreign keys and expectations of one table."""
    if target is None:
        target = spark.table(config["target_table"])
    target = apply_transformations(target, config.get("transformations") or [])
    rules = _guarded(spark, "rules", R.rule_report(target, []).schema.simpleString(),
                     lambda: R.rule_report(target, config.get("validations") or [], **rule_options))
    fks = _guarded(spark, "foreign_keys", J.fk_report(target, []).schema.simpleString(),
                   lambda: J.fk_report(target, config.get("referential_integrity") or [], resolve))
    exps = _guarded(spark, "expectations", E.REPORT_SCHEMA,
                    lambda: E.expectation_report(target, config.get("great_expectations_validations") or []))
    return {
        "rules": rules,
        "rules_summary": R.validation_summary(rules, (config.get("output_file") or {}).get("output_file_path")),
        "foreign_keys": fks,
        "foreign_keys_verdict": J.fk_verdict(fks),
        "expectations": exps,
        "expectation_stats": E.suite_statistics(exps),
    }


def write_fk_violations(spark: SparkSession, config: Mapping, target: DataFrame,
                        resolve: J.Resolver | None = None, fmt: str = "parquet") -> str:
    """Publish all FK violations (an empty result too) and register the
    error table named by the ``logging`` section; returns the folder they are in."""
    log = config.get("logging") or {}
    short = str(config.get("target_table", "table")).split(".")[-1]
    path = log.get("output_delta_path") or f"{short}_errors"
    table = log.get("error_table")
    violations = J.fk_violations(target, config.get("referential_integrity") or [], resolve)
    return write_table(violations, path, fmt=fmt, table=table)


STAGE_REPORT = "stage string, status string, n_failed long, message string"


def _executed(spark: SparkSession, name: str, schema: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage's report, executed; one that fails while it runs is one row with status ``error``."""
    return _guarded(spark, name, schema, lambda: stage_table(build(), f"checks-{name}"))


def _rules_one_by_one(target: DataFrame, rules: list, options: Mapping) -> DataFrame:
    """Every rule executed by itself; one that fails while it runs is an error row, the others keep theirs."""
    schema = R.rule_report(target, []).schema.simpleString()
    parts = []
    for i, rule in enumerate(rules):
        own = _executed(target.sparkSession, "rule", schema, lambda rule=rule: R.rule_report(target, [rule], **options))
        parts.append(own.withColumns({
            "rule_idx": F.lit(i), "rule_id": F.coalesce("rule_id", F.lit(f"{rule.get('column')} - {rule.get('validation_type')}")),
            "kind": F.coalesce("kind", F.lit(str(rule.get("validation_type")))), "column": F.coalesce("column", F.lit(rule.get("column")).cast("string"))}))
    return reduce(DataFrame.unionByName, parts)


def _columns_report(spark: SparkSession, config: Mapping, schema_doc, target: DataFrame) -> DataFrame:
    """One row per column that the output file or the table lacks or has in excess."""
    out, name = config.get("output_file") or {}, str(config.get("target_table"))
    found = []
    if out.get("output_file_path"):
        found.append(("file", S.file_schema_check(spark, out["output_file_path"], schema_doc, name, out.get("delimiter", "\t"),
                                                  str(out.get("ignore_first_line", "no")).strip().lower() == "yes")))
    found.append(("table", S.table_schema_check(target, schema_doc, name)))
    rows = [(where, None, "error", r["error"]) for where, r in found if r.get("error")]
    rows += [(where, c, kind, None) for where, r in found for kind in ("missing", "extra") for c in r[f"{kind}_in_{where}"]]
    return spark.createDataFrame(rows, "place string, column string, status string, message string")


def run_table_sequence(
    spark: SparkSession, config: Mapping, target: DataFrame | None = None, resolve: J.Resolver | None = None,
    schema_doc=None, **rule_options,
) -> dict[str, DataFrame]:
    """All stages of one table, executed in order. The result holds a report per
    stage (``files``, ``delimiters``, ``columns``, ``rules``, ``foreign_keys``,
    ``expectations``, ``violations``) and ``stages``: per stage its status
    (``pass``, ``fail``, ``error`` or ``skipped``), the number of failed entries
    and, for an error, its text.

    Without ``target`` it is the configured output file; without ``schema_doc``
    the column stage is skipped; stages without entries in the config pass.
    """
    files, rules = config.get("input_files") or [], config.get("validations") or []
    fks, suite = config.get("referential_integrity") or [], config.get("great_expectations_validations") or []
    out: dict[str, DataFrame] = {}
    problem = ""
    out["files"] = _executed(spark, "files", "idx int, file_path string, status string, length long, error string",
                             lambda: manifest_check(spark, files))
    out["delimiters"] = _executed(spark, "delimiters", "idx int, file_path string, status string, checked_lines long, is_valid boolean",
                                  lambda: input_format_checks(spark, files))
    try:
        target = read_output_file(spark, config) if target is None else target
        target = apply_transformations(target, config.get("transformations") or [])
    except Exception as exc:  # noqa: BLE001 - the later stages report it
        problem = f"{type(exc).__name__}: {exc}"
        target = None
    if target is not None:
        if schema_doc is not None:
            out["columns"] = _executed(spark, "columns", "place string, column string, status string, message string",
                                       lambda: _columns_report(spark, config, schema_doc, target))
        schema = R.rule_report(target, []).schema.simpleString()
        out["rules"] = _executed(spark, "rules", schema, lambda: R.rule_report(target, rules, **rule_options))
        if rules and isinstance(rules, list) and out["rules"].filter("status = 'error' and rule_id is null").count():
            out["rules"] = _rules_one_by_one(target, rules, rule_options)
        out["foreign_keys"] = _executed(spark, "foreign_keys", J.fk_report(target, []).schema.simpleString(), lambda: J.fk_report(target, fks, resolve))
        out["expectations"] = _executed(spark, "expectations", E.REPORT_SCHEMA, lambda: E.expectation_report(target, suite))
        out["violations"] = _executed(spark, "violations", "failed_fk string, status string, message string", lambda: spark.read.parquet(
            write_fk_violations(spark, config, target, resolve)).groupBy("failed_fk").agg(F.lit("fail").alias("status"), F.count(F.lit(1)).alias("n_rows")))
    good = {"files": ("found",), "delimiters": ("valid", "skipped")}
    rows = []
    for name in ("files", "delimiters", "columns", "rules", "foreign_keys", "expectations", "violations"):
        if name not in out:
            rows.append((name, "error", None, problem) if problem else (name, "skipped", None, None))
            continue
        facts = out[name].agg(F.count_if(~F.col("status").isin(*good.get(name, ("pass",)))).alias("bad"), F.count_if(F.col("status") == "error").alias("errors"),
                              F.max(F.when(F.col("status") == "error", F.col("message" if "message" in out[name].columns else "status"))).alias("text")).first()
        rows.append((name, "error" if facts["errors"] else "fail" if facts["bad"] else "pass", facts["bad"], facts["text"]))
    out["stages"] = spark.createDataFrame(rows, STAGE_REPORT)
    return out
