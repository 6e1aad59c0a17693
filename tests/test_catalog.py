"""Catalog inventory (S12), database drift (C2 over a database), drift log (C5), R10 modes."""

from sievekit.operators import rules as R
from sievekit.operators import schema as C
from sievekit.sources.tables import catalog_inventory, catalog_table

SCHEMA = {"classes": {"genome": {"slots": ["genome_id", "gtdb_taxonomy_id"]},
                      "sample": {"slots": ["sample_id"]}}}


def test_inventory_and_drift(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS genomes_t")
    spark.createDataFrame([("g1", "t1", "x")], "genome_id string, gtdb_taxonomy_id string, extra string") \
        .write.mode("overwrite").saveAsTable("genomes_t.genome")
    spark.createDataFrame([("s1",)], "other string").write.mode("overwrite").saveAsTable("genomes_t.sample")
    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").saveAsTable("genomes_t.unlisted")
    inv = {r.table: r for r in catalog_inventory(spark, "genomes_t").collect()}
    assert set(inv) == {"genome", "sample", "unlisted"}
    assert inv["genome"].location and inv["genome"].error is None
    assert catalog_table(spark, "genomes_t.genome").count() == 1
    drift = {(r.table, r.column, r.kind) for r in C.database_drift(spark, "genomes_t", SCHEMA).collect()}
    assert drift == {("genomes_t.genome", "extra", "extra_in_table"),
                     ("genomes_t.sample", "sample_id", "missing_in_table"),
                     ("genomes_t.sample", "other", "extra_in_table"),
                     ("genomes_t.unlisted", None, "unknown_class")}
    logged = C.drift_log(C.database_drift(spark, "genomes_t", SCHEMA))
    assert "logged_at" in logged.columns and logged.filter("logged_at IS NULL").count() == 0


def test_passed_rule_modes(spark):
    df = spark.createDataFrame([("a",), ("",), ("b",)], "v string")
    rules = [{"column": "v", "validation_type": "not_null"},
             {"column": "v", "validation_type": "allowed_values", "values": ["a", "b", ""]}]
    rep = R.rule_report(df, rules)
    assert [r.rule_id for r in R.passed_rules(rep).collect()] == ["v - allowed_values"]
    assert [r.rule_id for r in R.passed_rules(rep, "any_row").collect()] == ["v - allowed_values", "v - not_null"]
