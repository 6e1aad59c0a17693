"""Plan-shape checks for the scale properties the operators promise."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from sievekit.operators import expectations as E
from sievekit.operators import integrity as J
from sievekit.operators import rules as R
from sievekit.operators.stats import group_stats
from sievekit.plans import configs as cfg
from sievekit.plans.tables import load
from sievekit.session import stage_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_rules_and_expectations_are_one_scan(spark):
    li = load(spark, SF, "lineitem")
    for df in (R.rule_report(li, cfg.LINEITEM_RULES),
               E.expectation_report(load(spark, SF, "orders"), cfg.ORDERS_EXPECTATIONS)):
        plan = _plan(df)
        assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1
        assert len(re.findall(r"Exchange SinglePartition", plan)) == 1


def test_samples_are_one_scan_below_the_cuts(spark):
    """One scan for the counts and cuts of all rules, one for all samples; with staged counts, one."""
    li = load(spark, SF, "lineitem")
    assert _plan(R.violation_samples(li, cfg.LINEITEM_RULES, cfg.LINEITEM_KEYS)).count("lineitem.parquet") == 2
    counts = stage_table(R.rule_counts(li, cfg.LINEITEM_RULES, cfg.LINEITEM_KEYS, 5), "counts")
    text = _plan(R.violation_samples(li, cfg.LINEITEM_RULES, cfg.LINEITEM_KEYS, counts=counts))
    assert text.count("lineitem.parquet") == 1 and text.count("WindowGroupLimit") == 2
    assert "lineitem.parquet" not in _plan(R.rule_report(li, cfg.LINEITEM_RULES, counts=counts))


def test_log_lines_parsed_once(spark):
    plan = _plan(queries()["l_log_view"](spark, SF))
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("make", [J.fk_report, J.fk_samples])
@pytest.mark.parametrize("bound", [None, 0])
def test_foreign_keys_are_one_scan_and_one_exchange_of_keys(spark, make, bound):
    """All rules at once: no shuffle join, partial aggregation before the one exchange of keys."""
    refs = J.mapping_resolver({"orders_finished": load(spark, SF, "orders"), "supplier": load(spark, SF, "supplier"),
                               "part_small": load(spark, SF, "part")})
    plan = _plan(make(load(spark, SF, "lineitem"), cfg.LINEITEM_FKS, refs, max_broadcast_bytes=bound))
    assert plan.count("lineitem.parquet") == 1 and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert ("Join" in plan) == (bound is None)
    moved = re.findall(r"Exchange hashpartitioning\((.*?)\), ENSURE", plan)
    assert sum("__k0" in keys for keys in moved) == 1
    below = plan[plan.index("__k0#", plan.index("Exchange hashpartitioning(rule_idx")):]
    assert below.index("partial_sum(") < below.index("FileScan parquet")


def test_large_references_with_few_orphans_are_one_more_scan(spark):
    """No whole row is shuffled when the reference is large and its orphans are few."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        target = spark.range(50000).select("id", (F.col("id") % 40000).alias("fk"))
        ref = spark.range(100000).filter("id % 1000 != 7").select(F.col("id").alias("k"))
        rules = [{"foreign_key": "fk", "reference_table": "ref", "reference_column": "k"}]
        v = J.fk_violations(target, rules, J.mapping_resolver({"ref": ref}))
        assert sorted(r.id for r in v.collect()) == [i for i in range(50000) if i % 40000 % 1000 == 7]
        plan = _plan(v)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_median_uses_bounded_sketch(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"))
    plan = _plan(group_stats(df, ["g"], ["x"]))
    assert "percentile_approx" in plan and " percentile(" not in plan


def test_fk_violations_one_scan_for_small_references(spark):
    plan = _plan(queries()["j_fk_violations"](spark, SF))
    assert plan.count("lineitem.parquet") == 1


def test_hot_fk_key_is_split_by_aqe(spark):
    """A key holding a third of the rows: AQE splits its partition of the anti join."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        target = spark.range(300000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("fk"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))  # incompressible shuffle bytes
        ref = spark.range(0, 100000).select(F.col("id").alias("k"))
        rules = [{"foreign_key": "fk", "reference_table": "ref", "reference_column": "k", "action": "log"}]
        v = J.fk_violations(target, rules, J.mapping_resolver({"ref": ref}), max_broadcast_bytes=0)
        v.tail(1)
        assert "skew=true" in v._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

