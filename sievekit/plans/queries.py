"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Names start with the survey's operator family (r_ rules, j_ foreign keys,
e_ expectations, k_ curation expressions, g_ groups and pairs, l_ run logs,
s_ sources). Every query reads the whole test tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.functions import columns as C
from sievekit.operators import expectations as E
from sievekit.operators import flags as K
from sievekit.operators import groups as G
from sievekit.operators import integrity as J
from sievekit.operators import pairs as P
from sievekit.operators import rules as R
from sievekit.operators import runlog as L
from sievekit.operators.stats import group_stats
from sievekit.operators.transforms import apply_transformations
from sievekit.plans import configs as cfg
from sievekit.plans import curation as CU
from sievekit.plans import documents as DOC
from sievekit.plans import part_clusters as PC
from sievekit.plans.runlogs import event_log_lines
from sievekit.plans.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# ---------------------------------------------------------------- row rules

@query("r_rules_lineitem")
def r_rules_lineitem(spark, sf):
    return R.rule_report(load(spark, sf, "lineitem"), cfg.LINEITEM_RULES)


@query("r_rules_lineitem_text")
def r_rules_lineitem_text(spark, sf):
    # every column as text, as a header CSV is read: numeric rules parse with try_cast
    li = load(spark, sf, "lineitem")
    text = li.select(*[F.col(c).cast("string").alias(c) for c in li.columns])
    return R.rule_report(text, cfg.LINEITEM_RULES)


@query("r_rules_customer")
def r_rules_customer(spark, sf):
    customer = apply_transformations(load(spark, sf, "customer"), cfg.CUSTOMER_TRANSFORMS)
    return R.rule_report(customer, cfg.CUSTOMER_RULES, anchored=True)


@query("r_passed_rules")
def r_passed_rules(spark, sf):
    return R.passed_rules(R.rule_report(load(spark, sf, "lineitem"), cfg.LINEITEM_RULES))


@query("r_violation_rows")
def r_violation_rows(spark, sf):
    return R.violation_rows(load(spark, sf, "lineitem"), cfg.LINEITEM_RULES, cfg.LINEITEM_KEYS)


@query("r_violation_samples")
def r_violation_samples(spark, sf):
    return R.violation_samples(load(spark, sf, "lineitem"), cfg.LINEITEM_RULES, cfg.LINEITEM_KEYS, n=5)


@query("r_validation_summary")
def r_validation_summary(spark, sf):
    report = R.rule_report(load(spark, sf, "lineitem"), cfg.LINEITEM_RULES)
    return R.validation_summary(report, f"{sf}/lineitem.parquet").select(
        "success", "n_rules", F.size("validation_errors").alias("n_errors"))


@query("r_rules_documents")
def r_rules_documents(spark, sf):
    return R.rule_report(load(spark, sf, "documents"), cfg.DOCUMENT_RULES)


@query("r_rules_events")
def r_rules_events(spark, sf):
    return R.rule_report(load(spark, sf, "events"), cfg.EVENT_RULES)


# ---------------------------------------------------------- foreign keys

def _tpch_refs(spark, sf) -> J.Resolver:
    orders = load(spark, sf, "orders")
    part = load(spark, sf, "part")
    customer = load(spark, sf, "customer")
    return J.mapping_resolver({
        "orders_finished": orders.filter(F.col("o_orderstatus") == "F"),
        "part_small": part.filter(F.col("p_size") <= 25),
        "supplier": load(spark, sf, "supplier"),
        "customer_building": customer.filter(F.col("c_mktsegment") == "BUILDING"),
        "lineitem": load(spark, sf, "lineitem"),
    })


def _orders_with_null_fk(spark, sf) -> DataFrame:
    # nullif-style column so the null-FK path is exercised on real rows
    o = load(spark, sf, "orders")
    return o.withColumn("o_custkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")))


@query("j_fk_report")
def j_fk_report(spark, sf):
    return J.fk_report(load(spark, sf, "lineitem"), cfg.LINEITEM_FKS, _tpch_refs(spark, sf))


@query("j_fk_orders_report")
def j_fk_orders_report(spark, sf):
    return J.fk_report(_orders_with_null_fk(spark, sf), cfg.ORDERS_FKS, _tpch_refs(spark, sf))


@query("j_fk_verdict")
def j_fk_verdict(spark, sf):
    return J.fk_verdict(J.fk_report(load(spark, sf, "lineitem"), cfg.LINEITEM_FKS, _tpch_refs(spark, sf)))


@query("j_fk_violations")
def j_fk_violations(spark, sf):
    v = J.fk_violations(load(spark, sf, "lineitem"), cfg.LINEITEM_FKS, _tpch_refs(spark, sf))
    return v.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "failed_fk")


@query("j_fk_null_violations")
def j_fk_null_violations(spark, sf):
    v = J.fk_violations(_orders_with_null_fk(spark, sf), cfg.ORDERS_FKS, _tpch_refs(spark, sf))
    return v.select("o_orderkey", "o_custkey", "o_orderpriority", "failed_fk")


@query("j_fk_samples")
def j_fk_samples(spark, sf):
    return J.fk_samples(load(spark, sf, "lineitem"), cfg.LINEITEM_FKS, _tpch_refs(spark, sf), n=5)


# ---------------------------------------------------------- expectations

def _orders_for_suite(spark, sf) -> DataFrame:
    o = load(spark, sf, "orders")
    return o.withColumn("o_priority_or_null",
                        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))


@query("e_suite_report")
def e_suite_report(spark, sf):
    return E.expectation_report(_orders_for_suite(spark, sf), cfg.ORDERS_EXPECTATIONS)


@query("e_suite_stats")
def e_suite_stats(spark, sf):
    return E.suite_statistics(E.expectation_report(_orders_for_suite(spark, sf), cfg.ORDERS_EXPECTATIONS))


@query("e_suite_samples")
def e_suite_samples(spark, sf):
    return E.expectation_samples(_orders_for_suite(spark, sf), cfg.ORDERS_EXPECTATIONS, n=20)


@query("e_suite_customer")
def e_suite_customer(spark, sf):
    return E.expectation_report(load(spark, sf, "customer"), cfg.CUSTOMER_EXPECTATIONS)


@query("j_fk_clean")
def j_fk_clean(spark, sf):
    refs = J.mapping_resolver({t: load(spark, sf, t) for t in ("nation", "region", "customer", "documents")})
    reports = [J.fk_report(load(spark, sf, target), rules, refs).select(F.lit(target).alias("target"), "*")
               for target, rules in cfg.CLEAN_FKS.items()]
    return reduce(DataFrame.unionByName, reports)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule report on lineitem plus the FK report on lineitem, one table."""
    rules = R.rule_report(load(spark, sf_dir, "lineitem"), cfg.LINEITEM_RULES).select(
        F.lit("rule").alias("check"), F.col("rule_id").alias("name"), "status",
        F.col("n_violations").alias("n_violations"))
    fks = J.fk_report(load(spark, sf_dir, "lineitem"), cfg.LINEITEM_FKS, _tpch_refs(spark, sf_dir)).select(
        F.lit("foreign_key").alias("check"), F.col("reference").alias("name"), "status", "n_violations")
    return rules.unionByName(fks)


# ---------------------------------------------------------- curation: expressions (K)


URL_PARTS = ["scheme", "blank", "host", "lang", "page", "extra"]


@query("k_ani_groups")
def k_ani_groups(spark, sf):
    li = load(spark, sf, "lineitem")
    score = F.lit(100.0) - F.col("l_discount") * F.lit(40.0)
    return li.groupBy(C.bucket_label(score).alias("ani_group")).agg(F.count(F.lit(1)).alias("n"))


@query("k_url_parts")
def k_url_parts(spark, sf):
    pages = load(spark, sf, "pages")
    return pages.select("page_id", *C.split_to_columns("url", "/", URL_PARTS),
                        C.split_width("url", "/").alias("n_parts"))


@query("k_compose_key")
def k_compose_key(spark, sf):
    part = load(spark, sf, "part")
    return part.select("p_partkey", C.compose_key("p_name", "p_brand").alias("clade_key"),
                       C.strip_prefix("p_brand", 6).alias("brand_code"))


def _part_flags(spark, sf):
    part = load(spark, sf, "part").withColumn("words", C.split_list("p_name", " "))
    return K.flag_rows(part,
                       filter_a=F.col("p_size") < 5,
                       filter_b=C.list_overlap("p_brand", ["Brand#1"], "words", ["red", "small"]))


@query("k_part_flags")
def k_part_flags(spark, sf):
    return _part_flags(spark, sf).select("p_partkey", "filter_a", "filter_b")


@query("k_part_flag_summary")
def k_part_flag_summary(spark, sf):
    return K.filter_summary(_part_flags(spark, sf), "filter_a", "filter_b")


@query("k_keep_drop")
def k_keep_drop(spark, sf):
    customer, orders = load(spark, sf, "customer"), load(spark, sf, "orders")
    finished = orders.filter(F.col("o_orderstatus") == "F")
    kept = K.keep_keys(customer, "c_custkey", finished, "o_custkey")
    dropped = K.drop_keys(customer, "c_custkey", finished, "o_custkey")
    check = K.completeness(kept, "c_custkey", finished, "o_custkey")
    metrics = [kept.agg(F.lit("kept").alias("metric"), F.count(F.lit(1)).alias("value")),
               dropped.agg(F.lit("dropped").alias("metric"), F.count(F.lit(1)).alias("value"))]
    metrics += [check.select(F.lit(m).alias("metric"), F.col(f"n_{m}").alias("value"))
                for m in ("expected", "found", "missing")]
    return reduce(DataFrame.unionByName, metrics)


# ---------------------------------------------------------- curation: groups

@query("g_members")
def g_members(spark, sf):
    return CU.doc_lines(spark, sf).select("doc_id", "line_no", "line")


@query("k_line_flags")
def k_line_flags(spark, sf):
    return K.filter_summary(CU.flagged_lines(spark, sf), "filter_a", "filter_b")


@query("g_stage_groups")
def g_stage_groups(spark, sf):
    _, groups = CU.doc_stage(spark, sf)
    return groups.select("doc_id", "n_members", "n_removed", "n_retained", "kept")


@query("g_cascade_members")
def g_cascade_members(spark, sf):
    members, _ = CU.doc_stage(spark, sf)
    return members.filter(F.col("cascade") == 1).select("doc_id", "line_no")


@query("g_changed_groups")
def g_changed_groups(spark, sf):
    _, groups = CU.doc_stage(spark, sf)
    return G.changed_groups(groups)


@query("g_retained_text")
def g_retained_text(spark, sf):
    return CU.retained_text(spark, sf)


# ---------------------------------------------------------- curation: pairs

@query("g_valid_pairs")
def g_valid_pairs(spark, sf):
    return CU.valid_order_pairs(spark, sf).select(
        "pair_id", "genome1", "genome2", "group", "size1", "size2", "min_size", "pair_key", "score")


@query("g_scored_pairs")
def g_scored_pairs(spark, sf):
    return CU.surviving_pairs(spark, sf).select("pair_id", "pair_key", "group", "score")


@query("g_near_dup_removed")
def g_near_dup_removed(spark, sf):
    return P.removed_members(CU.surviving_pairs(spark, sf))


@query("g_already_removed")
def g_already_removed(spark, sf):
    return P.already_removed(CU.surviving_pairs(spark, sf))


@query("g_pair_coverage")
def g_pair_coverage(spark, sf):
    sizes = CU.customer_members(spark, sf).groupBy("group").agg(F.count(F.lit(1)).alias("n_members"))
    return P.pair_coverage(sizes, CU.valid_order_pairs(spark, sf))


@query("g_stage3_groups")
def g_stage3_groups(spark, sf):
    _, groups = CU.customer_stage3(spark, sf, staged=False)
    return groups.select("group", "n_members", "n_removed", "n_retained", "kept")


@query("g_group_stats")
def g_group_stats(spark, sf):
    members, _ = CU.customer_stage3(spark, sf)
    counts = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("member")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    retained = members.filter(F.col("retained") == 1).join(counts, "member", "left").withColumn(
        "n_orders", F.coalesce("n_orders", F.lit(0)))
    return group_stats(retained, ["group"], ["size", "n_orders"])


@query("g_size_split")
def g_size_split(spark, sf):
    _, groups = CU.customer_stage3(spark, sf, staged=False)
    return P.size_split(groups.filter("kept"), "n_retained", CU.SIZE_SPLIT).select(
        "group", "n_retained", "size_class")


# ---------------------------------------------------------- run logs


def _parsed_logs(spark, sf):
    return L.parse_log_lines(event_log_lines(spark, sf))


@query("l_log_view")
def l_log_view(spark, sf):
    return L.log_view(L.filter_logs(_parsed_logs(spark, sf), pipeline="events", schema=L.ALL, table=L.ALL,
                                    level="ERROR", start="2024-01-03", end="2024-01-09"))


@query("l_bad_lines")
def l_bad_lines(spark, sf):
    return L.bad_line_report(_parsed_logs(spark, sf))


@query("l_options")
def l_options(spark, sf):
    return L.option_values(_parsed_logs(spark, sf))


@query("l_date_bounds")
def l_date_bounds(spark, sf):
    return L.date_bounds(_parsed_logs(spark, sf))


@query("l_file_union")
def l_file_union(spark, sf):
    chosen = L.select_files(_parsed_logs(spark, sf), ["pipeline_run_20240105.log", "pipeline_run_20240106.log"])
    return L.good_lines(chosen).groupBy("log_file", "level").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------- sources

@query("s_path_count")
def s_path_count(spark, sf):
    from sievekit.sources.tables import sql_count
    return sql_count(spark, f"{sf}/lineitem.parquet", "parquet")


@query("l_bad_line_list")
def l_bad_line_list(spark, sf):
    bad = _parsed_logs(spark, sf).filter("is_bad")
    return bad.select("log_file", "bad_line")


# ---------------------------------------------------------- files, configs, bad rules (plans/documents.py)

QUERIES.update(DOC.QUERIES)
QUERIES.update(PC.QUERIES)
