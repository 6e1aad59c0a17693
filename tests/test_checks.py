"""Config-driven checks, short rows, stacking and renaming."""

import os

from pyspark.sql import functions as F

from sievekit.operators import flags as K
from sievekit.operators import integrity as J
from sievekit.plans.checks import read_output_file, run_table_checks, run_table_sequence, write_fk_violations
from sievekit.sources.delimited import short_rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_table_checks_from_a_config(spark, tmp_dir):
    lines = ["exported on Monday", "o_orderkey,o_custkey,o_totalprice", " 1,10,99.5", "2,77,", "3,11,12000", "4x,10,-1", "5,,5"]
    _write(f"{tmp_dir}/out/orders.csv", "\n".join(lines) + "\n")
    cfg = {
        "target_table": "shop.orders",
        "output_file": {"output_file_path": f"{tmp_dir}/out/orders.csv", "delimiter": ",", "ignore_first_line": "yes"},
        "transformations": [{"column_name": "o_orderkey", "operation": "trim_whitespace"}],
        "validations": [{"column": "o_orderkey", "validation_type": "regex_match", "pattern": "^[0-9]+$"},
                        {"column": "o_totalprice", "validation_type": "numeric_range", "min": 0, "max": 10_000},
                        {"column": "o_orderkey", "validation_type": "regex_match", "pattern": "(("}],
        "referential_integrity": [{"foreign_key": "o_custkey", "reference_table": "customer", "reference_column": "c_custkey",
                                   "database": "shop", "action": "log"}],
        "great_expectations_validations": [
            {"expectation_type": "expect_column_values_to_not_be_null", "params": {"column": "o_orderkey"}}],
        "logging": {"error_table": None, "output_delta_path": f"{tmp_dir}/errors"},
    }
    target = read_output_file(spark, cfg)
    refs = J.mapping_resolver({"customer": spark.createDataFrame([(10,), (11,)], "c_custkey long")})  # numbers against text
    out = run_table_checks(spark, cfg, target, refs)
    assert {r.rule_idx: (r.status, r.n_violations) for r in out["rules"].collect()} == {0: ("fail", 1), 1: ("fail", 2), 2: ("error", None)}
    assert out["foreign_keys"].first().n_violations == 2  # 77 and the missing one
    assert out["expectation_stats"].first().success is True
    assert spark.read.parquet(write_fk_violations(spark, cfg, target, refs)).count() == 2
    # a stage that cannot be built is reported, and the others still run
    broken = run_table_checks(spark, cfg | {"validations": "none"}, target, refs)
    assert broken["rules"].first().status == "error" and broken["foreign_keys"].first().n_violations == 2


def test_short_rows(spark, tmp_dir):
    _write(f"{tmp_dir}/s/a.tsv", "a\tb\tc\n1\t2\t3\n1\t2\n1\t2\t\n")
    rows = short_rows(spark, f"{tmp_dir}/s/a.tsv").collect()
    assert [(r.value, r.n_fields, r.line_number) for r in rows] == [("1\t2", 2, 3)]


def test_stack_and_rename(spark):
    a = spark.createDataFrame([("x", 1)], "accession string, status int")
    b = spark.createDataFrame([("y", "w")], "accession string, warnings string")
    s = K.stack_tables(a, b)
    assert s.columns == ["accession", "status", "warnings"] and s.count() == 2
    r = K.select_renamed(s, {"warnings": "excluded_from_refseq", "accession": "assembly_accession"})
    assert r.columns == ["excluded_from_refseq", "assembly_accession"]
    assert K.select_renamed(s, ["status"]).filter(F.col("status").isNull()).count() == 1


SCHEMA = "classes:\n  orders:\n    slots:\n      - o_orderkey\n      - o_custkey\n      - o_comment\n"


def _sequence_config(tmp_dir):
    _write(f"{tmp_dir}/in/a.tsv", "o_orderkey\to_custkey\n1\t2\n")
    _write(f"{tmp_dir}/in/b.tsv", "o_orderkey,o_custkey\n1,2\n")
    _write(f"{tmp_dir}/out/orders.tsv", "o_orderkey\to_custkey\n1\t10\n2\t77\nx\t10\n")
    entry = {"file_type": "tsv", "delimiter": "\t", "ignore_first_line": "no"}
    return {
        "target_table": "shop.orders",
        "input_files": [{"file_path": f"{tmp_dir}/in/{n}.tsv", **entry} for n in ("a", "b")],
        "output_file": {"output_file_path": f"{tmp_dir}/out/orders.tsv", "delimiter": "\t", "ignore_first_line": "no"},
        "validations": [{"column": "o_orderkey", "validation_type": "regex_match", "pattern": "^[0-9]+$"}, {"column": "o_custkey", "validation_type": "not_null"}],
        "referential_integrity": [{"foreign_key": "o_custkey", "reference_table": "customer", "reference_column": "c_custkey", "database": "shop", "action": "log"}],
        "great_expectations_validations": [{"expectation_type": "expect_column_values_to_not_be_null", "params": {"column": "o_orderkey"}}],
        "logging": {"error_table": None, "output_delta_path": f"{tmp_dir}/errors"},
    }


def test_the_whole_sequence_of_a_table(spark, tmp_dir):
    cfg = _sequence_config(tmp_dir)
    refs = J.mapping_resolver({"customer": spark.createDataFrame([(10,), (11,)], "c_custkey long")})
    out = run_table_sequence(spark, cfg, resolve=refs, schema_doc=SCHEMA)
    stages = {r.stage: (r.status, r.n_failed) for r in out["stages"].collect()}
    assert stages == {"files": ("pass", 0), "delimiters": ("fail", 1), "columns": ("fail", 2), "rules": ("fail", 1), "foreign_keys": ("fail", 1),
                      "expectations": ("pass", 0), "violations": ("fail", 1)}
    assert {(r.place, r.column, r.status) for r in out["columns"].collect()} == {("file", "o_comment", "missing"), ("table", "o_comment", "missing")}
    assert spark.read.parquet(f"{tmp_dir}/errors").count() == 1
    missing = run_table_sequence(spark, cfg | {"output_file": {"output_file_path": f"{tmp_dir}/none.tsv"}}, resolve=refs)
    stages = {r.stage: r.status for r in missing["stages"].collect()}
    assert stages["files"] == "pass" and stages["rules"] == "error" and stages["violations"] == "error"


def test_a_rule_that_fails_while_it_runs_does_not_end_the_run(spark, tmp_dir):
    cfg = _sequence_config(tmp_dir)
    target = read_output_file(spark, cfg).withColumn("o_number", F.when(F.col("o_orderkey") == "x", F.raise_error(F.lit("no number"))).otherwise(F.lit(1)))
    rules = [*cfg["validations"], {"column": "o_number", "validation_type": "numeric_range", "min": 0}]
    refs = J.mapping_resolver({"customer": spark.createDataFrame([(10,)], "c_custkey long")})
    out = run_table_sequence(spark, cfg | {"validations": rules}, target, refs)
    got = {r.rule_idx: (r.status, r.n_violations) for r in out["rules"].collect()}
    assert got == {0: ("fail", 1), 1: ("pass", 0), 2: ("error", None)}
    stages = {r.stage: r.status for r in out["stages"].collect()}
    assert stages["rules"] == "error" and stages["foreign_keys"] == "fail" and stages["columns"] == "skipped" and stages["expectations"] == "pass"
    assert stages["violations"] == "error"  # whole rows cannot be written
