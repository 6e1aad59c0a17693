"""The config audit: one fault at a time, generated from the lists of required keys."""

import json

import pytest
from pyspark.sql import functions as F

from sievekit.operators import audit as A
from sievekit.plans.documents import CONFIG_ROWS, a_config_errors, a_config_verdict, customer_configs

ORDERS = {
    "target_table": "shop.orders",
    "schema_file_path": "/schemas/orders.yaml",
    "input_files": [{k: f"{k} of file {n}" for k in A.INPUT_FILE_KEYS} for n in (1, 2)],
    "output_file": {k: "x" for k in A.OUTPUT_FILE_KEYS},
    "transformations": [{"column_name": "o_orderstatus", "operation": "trim_whitespace", "value": None}],
    "validations": [{k: "o_orderkey" for k in A.VALIDATION_KEYS}, {k: "o_custkey" for k in A.VALIDATION_KEYS}],
    "referential_integrity": [{k: "o_custkey" for k in A.RI_KEYS}],
    "great_expectations_validations": [{"expectation_type": "expect_column_to_exist", "params": {"column": "o_orderkey"}}],
    "schema_drift_handling": {k: "d" for k in A.SCHEMA_DRIFT_KEYS},
    "logging": {k: "l" for k in A.LOGGING_KEYS},
    "versioning": {"version_tag": "7", "created_by": "shop", "created_at": "2024-02-29T23:59:59.123456+02:00"},
}
ITEM_KEYS = {"input_files": A.INPUT_FILE_KEYS, "validations": A.VALIDATION_KEYS, "referential_integrity": A.RI_KEYS}
PAIRED = {"transformations": (("column_name", "operation"), A.MSG_TRANSFORMATION_KEYS),
          "great_expectations_validations": (("expectation_type", "params"), A.MSG_EXPECTATION_KEYS)}
OBJECTS = {"output_file": A.OUTPUT_FILE_KEYS, "schema_drift_handling": A.SCHEMA_DRIFT_KEYS, "logging": A.LOGGING_KEYS,
           "versioning": A.VERSIONING_KEYS}
GOOD_TIMES = ("2024-02-29", "20240229", "2024-02-29T10", "2024-02-29 10:11", "2024-02-29T10:11:12Z", "2024-02-29T10:11:12.123", "2024-02-29T10:11:12-05:30")
BAD_TIMES = ("2024", "2024-02", "2024-02-30", "29.02.2024", "10:11:12", "", "now", "2024-02-29T25:00:00", None)


def cases():
    """(name, config, expected errors)"""

    def changed(**sections):
        return {k: v for k, v in (ORDERS | sections).items() if v is not ...}

    yield "whole", ORDERS, []
    for name in ORDERS:
        wanted = [("required_fields", f"{A.MSG_MISSING_REQUIRED}'{name}'")] if name in A.VALIDATOR_REQUIRED else []
        if name == "output_file":
            wanted += [(name, A.MSG_MISSING_FIELD + k) for k in A.OUTPUT_FILE_KEYS]
        yield f"without {name}", changed(**{name: ...}), wanted
    for name, keys in ITEM_KEYS.items():
        for key in keys:
            items = [*ORDERS[name][:-1], {k: v for k, v in ORDERS[name][-1].items() if k != key}]
            yield f"{name} without {key}", changed(**{name: items}), [(f"{name}[{len(items) - 1}]", A.MSG_MISSING_FIELD + key)]
    for name, (keys, message) in PAIRED.items():
        for key in keys:
            yield f"{name} without {key}", changed(**{name: [*ORDERS[name], {k: 1 for k in keys if k != key}]}), [(f"{name}[1]", message)]
    for name, keys in OBJECTS.items():
        for key in keys:
            errors = [(name, A.MSG_MISSING_FIELD + key)] + [(name, A.MSG_BAD_CREATED_AT)] * (key == "created_at")
            yield f"{name} without {key}", changed(**{name: {k: v for k, v in ORDERS[name].items() if k != key}}), errors
        if name != "output_file":
            yield f"empty {name}", changed(**{name: {}}), []
    for name in (*PAIRED, *ITEM_KEYS):
        yield f"no items in {name}", changed(**{name: []}), []
        for wrong in ("text", {"a": 1}, 5):
            yield f"{name} is {wrong}", changed(**{name: wrong}), [(name, f"{name} must be a list")]
    yield "input_files is null", changed(input_files=None), [("input_files", A.MSG_INPUT_NOT_LIST)]
    for time in GOOD_TIMES:
        yield f"at {time}", changed(versioning=ORDERS["versioning"] | {"created_at": time}), []
    for time in BAD_TIMES:
        yield f"at {time}", changed(versioning=ORDERS["versioning"] | {"created_at": time}), [("versioning", A.MSG_BAD_CREATED_AT)]


def test_every_key_of_every_section(spark):
    wanted = {name: errors for name, _, errors in cases()}
    table = spark.createDataFrame([(name, json.dumps(config)) for name, config, _ in cases()], "config string, json string")
    errors = A.audit_configs(table)
    got = {name: [] for name in wanted}
    for r in errors.orderBy("config", "check_order").collect():
        got[r["config"]].append((r["section"], r["message"]))
    assert {k: (got[k], wanted[k]) for k in wanted if got[k] != wanted[k]} == {}
    assert len(wanted) > 70
    verdict = {r["config"]: (r["n_errors"], r["valid"]) for r in A.audit_verdict(table, errors).collect()}
    assert verdict == {k: (len(v), not v) for k, v in wanted.items()}


def test_one_config_raises_with_all_its_errors(spark):
    broken = {k: v for k, v in ORDERS.items() if k != "target_table"} | {"logging": {"error_table": "e"}}
    errors = A.audit_configs(A.configs_from_dicts(spark, {"good": ORDERS, "broken": broken}))
    assert A.assert_valid(errors, "good") and not A.assert_valid(errors, "broken", dry_run=True)
    with pytest.raises(A.ConfigValidationError) as raised:
        A.assert_valid(errors, "broken")
    assert [e["section"] for e in json.loads(str(raised.value))] == ["required_fields", "logging"]


def test_sections_the_loader_needs(spark):
    table = A.configs_from_dicts(spark, {"some": ORDERS, "all": dict.fromkeys(A.LOADER_REQUIRED), "none": {}})
    missing = {(r["config"], r["missing_section"]) for r in A.loader_missing_sections(table).collect()}
    assert missing == {("none", k) for k in A.LOADER_REQUIRED} | {("some", "bronze"), ("some", "silver")}


def test_configs_are_dealt_out_by_their_number(spark, tmp_dir):
    """customers in one scan task, their configs in tasks of CONFIG_ROWS."""
    n = 2 * CONFIG_ROWS + 8
    customers = spark.range(n).select(F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"), F.lit("BUILDING").alias("c_mktsegment"))
    customers.coalesce(1).write.parquet(f"{tmp_dir}/customer.parquet")
    parts = [r["count"] for r in customer_configs(spark, tmp_dir).groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) == 3 and sum(parts) == n and max(parts) <= CONFIG_ROWS
    per_kind = [0, 1, 1, 1, 1, 3, 2, 1, 1, 2, 1, 2, 1, 1, 2, 0]
    assert a_config_errors(spark, tmp_dir).count() == sum(per_kind[i % 16] for i in range(n))
    bad = a_config_verdict(spark, tmp_dir).groupBy("n_errors", "valid").count().collect()
    kinds = [per_kind[i % 16] for i in range(n)]
    assert {(r["n_errors"], r["valid"], r["count"]) for r in bad} == {(k, k == 0, kinds.count(k)) for k in set(kinds)}


def test_no_configs_are_no_rows(spark, tmp_dir):
    spark.createDataFrame([], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_dir}/customer.parquet")
    assert a_config_errors(spark, tmp_dir).count() == a_config_verdict(spark, tmp_dir).count() == 0


def test_a_section_is_taken_out_of_a_config_once(spark):
    """the checks share what was parsed."""
    plan = A.audit_configs(A.configs_from_dicts(spark, {"whole": ORDERS}))._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(f", $.{name})") for name in A.AUDITED] == [1] * len(A.AUDITED)
