"""Queries over files and config documents that Spark derives from the test tables.

Delimited files, id lists, logs and keyed documents are written under the
shared checkpoint folder first, so the sources read real files; configs are
one JSON document per customer, with faults that depend on its key. The work
grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.functions.sizing import dealt_out
from sievekit.operators import audit as A
from sievekit.operators import expectations as E
from sievekit.operators import flags as K
from sievekit.operators import groups as G
from sievekit.operators import integrity as J
from sievekit.operators import rules as R
from sievekit.operators import runlog as L
from sievekit.operators import schema as S
from sievekit.plans.runlogs import event_log_lines
from sievekit.plans.tables import load
from sievekit.session import fresh_folder, stage_table
from sievekit.sources import delimited as D
from sievekit.sources import ranges as BR
from sievekit.sources.files import delimiter_check, lines_without_delimiter, manifest_check, resolve_member_files
from sievekit.sources.jsondoc import read_keyed_document
from sievekit.sources.sinks import write_name_list, write_table

FILE_ROWS = 5_000  # rows of a table in one derived file
CONFIG_ROWS = 10_000  # configs that a task writes and audits


def write_lines_by_file(df: DataFrame, path: str, file_no: Column, order: str, line: Column, head: list[Column]) -> None:
    """One file per ``file_no``: the head lines, then a line per row (``FILE_ROWS`` at most)."""
    rows = df.select(file_no.alias("file_no"), F.struct(F.col(order).alias("k"), line.alias("v")).alias("r"))
    body = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list("r")), lambda r: r["v"]))
    texts = rows.groupBy("file_no").agg(body.alias("body"))
    texts.select("file_no", F.concat_ws("\n", *head, F.col("body")).alias("value")).repartition("file_no").write.partitionBy("file_no").text(path)


# ---------------------------------------------------------------- rules that are wrong themselves

BAD_ORDER_RULES = [
    {"column": "o_orderstatus", "validation_type": "regex_match", "pattern": "([OF", "error_message": "m"},
    {"column": "o_orderdate", "validation_type": "numeric_range", "min": 1, "error_message": "m"},
    {"column": "o_totalprice", "validation_type": "numeric_range", "min": "low", "error_message": "m"},
    {"column": "o_totalprice", "validation_type": "numeric_range", "min": "1000", "error_message": "too cheap"},
    {"column": "o_orderstatus", "validation_type": "allowed_values", "values": [1, 2], "error_message": "no such status"},
    {"column": "o_orderkey", "validation_type": "allowed_values", "values": ["1", "2"], "error_message": "another key"},
    {"column": "o_orderpriority", "validation_type": "regex_match", "pattern": "^[1-3]-", "error_message": "low priority"},
]

TEXT_FKS = [
    {"foreign_key": "l_orderkey", "reference_table": "orders_finished", "reference_column": "o_orderkey"},
    {"foreign_key": "l_shipdate", "reference_table": "supplier", "reference_column": "s_suppkey"},
    {"foreign_key": "l_partkey", "reference_table": "part_small", "reference_column": "p_partkey"},
]

BAD_EXPECTATIONS = [
    {"expectation_type": "expect_column_values_to_match_regex", "params": {"column": "c_name", "regex": "*Customer"}},
    {"expectation_type": "expect_column_values_to_be_between", "params": {"column": "c_acctbal", "min_value": "none"}},
    {"expectation_type": "expect_column_values_to_be_between", "params": {"column": "c_acctbal", "min_value": "0"}},
    {"expectation_type": "expect_column_values_to_not_be_null", "params": {"column": "c_mktsegment"}},
]


def r_bad_rules_orders(spark, sf):
    return R.rule_report(load(spark, sf, "orders"), BAD_ORDER_RULES).select("rule_idx", "status", "n_violations")


def j_fk_text_keys(spark, sf):
    li = load(spark, sf, "lineitem")
    text = li.select(F.col("l_orderkey").cast("string").alias("l_orderkey"), "l_shipdate",
                     F.concat(F.when(F.col("l_linenumber") == 1, "x").otherwise(""), F.col("l_partkey").cast("string")).alias("l_partkey"))
    refs = J.mapping_resolver({
        "orders_finished": load(spark, sf, "orders").filter(F.col("o_orderstatus") == "F"),
        "supplier": load(spark, sf, "supplier"),
        "part_small": load(spark, sf, "part").filter(F.col("p_size") <= 25)})
    return J.fk_report(text, TEXT_FKS, refs).select("rule_idx", "status", "n_violations", "n_orphan_keys")


def e_bad_suite(spark, sf):
    return E.expectation_report(load(spark, sf, "customer"), BAD_EXPECTATIONS).select("exp_idx", "status", "success", "unexpected_count")


# ---------------------------------------------------------------- files

def _orders_files(spark, sf, name) -> str:
    """Orders as tab-separated files with a comment line and a header; every
    hundredth line lacks its last field, every seventh file its tabs in line 3."""
    path = fresh_folder(spark, name)
    full = F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    line = F.when(F.col("o_orderkey") % 100 == 7, F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus")).when(
        F.col("o_orderkey") % (7 * FILE_ROWS) == 0, F.replace(full, F.lit("\t"), F.lit(" "))).otherwise(full)
    write_lines_by_file(load(spark, sf, "orders"), path, F.expr(f"o_orderkey div {FILE_ROWS}"), "o_orderkey", line,
                        [F.lit("# orders, as exported"), F.lit("o_orderkey\to_orderstatus\to_orderpriority")])
    return path


def s_delimited_scan(spark, sf):
    path = fresh_folder(spark, "customer")
    (load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
     .write.option("header", True).option("sep", "\t").csv(path))
    return D.read_delimited(spark, path)


def s_comment_scan(spark, sf):
    return D.read_delimited_after_comment(spark, _orders_files(spark, sf, "comment")).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def r_short_rows(spark, sf):
    short = D.short_rows(spark, _orders_files(spark, sf, "short"), skip=1)
    return short.select("line_number", "n_fields", "n_expected", "value")


def f_delimiter_check(spark, sf):
    checks = delimiter_check(spark, _orders_files(spark, sf, "delimiter"), ignore_first_line=True)
    return checks.select(F.regexp_extract("file_path", r"file_no=(\d+)", 1).cast("long").alias("file_no"), "checked_lines",
                         F.size("invalid_lines").alias("n_invalid"), "is_valid")


def f_lines_without_delimiter(spark, sf):
    return lines_without_delimiter(spark, _orders_files(spark, sf, "lines")).select("value")


def s_id_list(spark, sf):
    path = fresh_folder(spark, "names")
    parts = load(spark, sf, "part")
    write_name_list(parts.select(F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.concat(F.lit(" "), "p_name")).alias("name")), "name", path)
    return D.read_id_list(spark, path)


def s_json_lines(spark, sf):
    path = fresh_folder(spark, "logs")
    event_log_lines(spark, sf).withColumn("day", F.col("log_file")).select("day", "value").repartition("day").write.partitionBy("day").text(path)
    return L.good_lines(L.read_run_logs(spark, path)).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def s_keyed_document(spark, sf):
    path = fresh_folder(spark, "keyed")
    c = load(spark, sf, "customer")
    entry = F.struct(F.col("c_name").alias("key"), F.struct(F.col("c_mktsegment").alias("genome"), F.col("c_nationkey").cast("string").alias("aa")).alias("value"))
    docs = c.groupBy(F.expr(f"c_custkey div {FILE_ROWS}").alias("doc")).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    docs.repartition("doc").write.partitionBy("doc").text(path)
    return read_keyed_document(spark, path, ("genome", "aa", "aux_genome"))


def s_violation_sink(spark, sf):
    path = fresh_folder(spark, "violations")
    li = load(spark, sf, "lineitem")
    refs = J.mapping_resolver({"part_small": load(spark, sf, "part").filter(F.col("p_size") <= 25)})
    rules = [{"foreign_key": "l_partkey", "reference_table": "part_small", "reference_column": "p_partkey", "action": "log"}]
    for target in (li, li.filter(F.col("l_quantity") > 25)):  # the second write replaces the first
        write_table(J.fk_violations(target, rules, refs).select("l_orderkey", "l_linenumber", "l_partkey", "failed_fk"), path)
    return spark.read.parquet(path).groupBy("failed_fk").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


def s_publish_table(spark, sf):
    """Violations published as a table whose columns change from run to run."""
    li, path, table = load(spark, sf, "lineitem"), fresh_folder(spark, "published"), f"violations_{uuid.uuid4().hex[:12]}"
    small = load(spark, sf, "part").filter(F.col("p_size") <= 25)
    rules = [{"foreign_key": "l_partkey", "reference_table": "part_small", "reference_column": "p_partkey", "action": "log"}]
    bad = J.fk_violations(li, rules, J.mapping_resolver({"part_small": small}))
    write_table(bad.select("l_orderkey", "l_partkey", "l_returnflag"), path, table=table)
    write_table(bad.filter("l_quantity > 25").select("l_orderkey", "l_partkey", "l_linenumber"), path, table=table)
    return spark.table(table).groupBy("l_returnflag", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


def _write_named(batches):
    for b in batches:
        for path, body in zip(b.column("path").to_pylist(), b.column("body").to_pylist(), strict=True):
            BR.write_file(path, body.encode())
        yield b.select(["path"])


def write_named_files(spark: SparkSession, files: DataFrame) -> None:
    """A file per (path, body), written by the tasks that hold the rows."""
    BR.ship_package(spark)
    files.select("path", "body").mapInArrow(_write_named, "path string").count()


def f_manifest(spark, sf):
    """A manifest of the orders files: each once, every third twice, every fourth
    with a file that is missing, every fifth with a folder, every sixth through a file."""
    path = _orders_files(spark, sf, "manifest")
    files = BR.listing(spark, path).select("file_path", F.regexp_extract("file_path", r"file_no=(\d+)", 1).cast("long").alias("file_no"))
    entry = lambda kind, modulus, target: F.when(F.col("file_no") % modulus == 0, F.struct(F.lit(kind).alias("kind"), target.alias("file_path")))
    listed = files.select("file_no", F.explode(F.array(
        entry("file", 1, F.col("file_path")), entry("again", 3, F.col("file_path")), entry("gone", 4, F.concat("file_path", F.lit(".gone"))),
        entry("folder", 5, F.regexp_replace("file_path", "/[^/]*$", "")), entry("through", 6, F.concat("file_path", F.lit("/x"))))).alias("e"))
    manifest = listed.filter("e is not null").select(F.struct("file_no", "e.kind").alias("idx"), "e.file_path")
    checked = manifest_check(spark, manifest)
    return checked.select("idx.file_no", "idx.kind", "status", "length", F.col("error").isNotNull().alias("has_error"))


def g_member_files(spark, sf):
    """Files of suppliers in folders of their nations: one each, every seventh
    without, every eleventh with two, and files of nobody; every thirteenth is in another folder."""
    root = fresh_folder(spark, "members")
    s = load(spark, sf, "supplier")
    member = F.concat(F.lit("S_"), F.col("s_suppkey").cast("string"))
    folder = F.concat(F.lit("n"), F.when(F.col("s_suppkey") % 13 == 0, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey")).cast("string"))
    name = lambda end: F.concat(F.lit(root + "/"), folder, F.lit("/"), member, F.lit(end))
    paths = F.array(F.when(F.col("s_suppkey") % 7 != 0, name("_a_protein.faa.gz")), F.when(F.col("s_suppkey") % 11 == 0, name("_b_protein.faa.gz")),
                    F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit(root + "/"), folder, F.lit("/X_"), member, F.lit("_protein.faa.gz"))),
                    F.when(F.col("s_suppkey") % 3 == 0, name("_a_notes.txt")))
    write_named_files(spark, s.select(F.explode(paths).alias("path"), F.col("s_name").alias("body")).filter("path is not null"))
    members = s.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("group"), member.alias("member"))
    found = resolve_member_files(spark, members, root)
    return found.select("group", "member", "n_matches", "status", F.element_at(F.split("path", "/"), -1).alias("file"))


# ---------------------------------------------------------------- stacking, declared counts

def k_stack(spark, sf):
    c = K.select_renamed(load(spark, sf, "customer"), {"c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"})
    s = K.select_renamed(load(spark, sf, "supplier"), {"s_acctbal": "balance", "s_name": "name"})
    return K.stack_tables(c, s)


def g_count_check(spark, sf):
    """The lines listed for an order against the highest line number it states."""
    listed = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.concat_ws(",", F.collect_list(F.col("l_linenumber").cast("string"))).alias("listed"), F.max("l_linenumber").alias("declared"))
    summary, _ = G.declared_count_check(listed, ["l_orderkey"], "listed", F.col("declared"))
    return summary


def g_count_mismatches(spark, sf):
    listed = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.concat_ws(",", F.collect_list(F.col("l_linenumber").cast("string"))).alias("listed"), F.max("l_linenumber").alias("declared"))
    _, wrong = G.declared_count_check(listed, ["l_orderkey"], "listed", F.col("declared"))
    return wrong


# ---------------------------------------------------------------- configs

def customer_configs(spark: SparkSession, sf: str) -> DataFrame:
    """(config, json): one config per customer; the key modulo 16 picks the fault.
    Millions of customers are a few MB, one scan task, and their configs gigabytes: they are dealt out first."""
    c, kind = dealt_out(load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), CONFIG_ROWS), F.col("c_custkey") % 16
    text = lambda *pairs: F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))
    part = lambda name, value: F.concat(F.lit(f'"{name}": '), value if isinstance(value, Column) else F.lit(value))
    faulty = lambda fault, wrong, right: F.when(kind == fault, wrong).otherwise(right)
    absent = lambda fault, pair: F.when(kind != fault, pair)
    segment = F.concat(F.lit('"'), F.lower("c_mktsegment"), F.lit('"'))
    return c.select("c_name", text(
        absent(1, part("target_table", F.concat(F.lit('"sales.'), F.lower("c_mktsegment"), F.lit('"')))),
        part("schema_file_path", '"schema.yaml"'),
        absent(2, part("input_files", F.when(kind == 3, "null").when(kind == 4, '{"source": "x"}').when(kind == 5, '[{"source": "x", "file_type": "tsv"}]').otherwise(
            '[{"source": "x", "file_path": "in.tsv", "file_type": "tsv", "delimiter": ",", "ignore_first_line": "no"}]'))),
        part("output_file", faulty(6, '{"file_type": "tsv", "delimiter": ","}', '{"output_file_path": "o", "file_type": "tsv", "delimiter": ",", "ignore_first_line": "no"}')),
        part("transformations", faulty(7, '[{"column_name": "c_name"}, {"column_name": "c_phone", "operation": "trim_whitespace"}]', "[]")),
        part("validations", F.when(kind == 8, '{"column": "c_name"}').otherwise(F.concat(
            F.lit('[{"column": '), segment, F.lit(', "validation_type": "not_null", "error_message": "m"}]')))),
        part("referential_integrity", faulty(9, '[{"foreign_key": "c_nationkey", "database": "d", "action": "log"}]', "[]")),
        part("great_expectations_validations", faulty(10, '[{"params": {"column": "c_acctbal"}}]', "[]")),
        part("schema_drift_handling", faulty(11, '{"action": "log"}', "{}")),
        part("logging", faulty(12, '{"error_table": "e"}', '{"error_table": "e", "output_delta_path": "p"}')),
        part("versioning", F.when(kind == 13, '{"version_tag": "v", "created_by": "c", "created_at": "2025"}')
             .when(kind == 14, '{"version_tag": "v", "created_at": "2025-02-30T10:00:00"}').when(kind == 15, "{}")
             .otherwise('{"version_tag": "v", "created_by": "c", "created_at": "2025-02-28T10:00:00+01:00"}')),
    ).alias("json")).withColumnRenamed("c_name", "config")


def a_config_errors(spark, sf):
    return A.audit_configs(customer_configs(spark, sf)).select("config", "section", "message")


def a_config_verdict(spark, sf):
    configs = customer_configs(spark, sf)
    return A.audit_verdict(configs, A.audit_configs(configs))


def a_missing_sections(spark, sf):
    return A.loader_missing_sections(customer_configs(spark, sf))


def c_config_columns(spark, sf):
    """Each config against the columns of its own table: a segment's table has
    a column of the segment's name, but for two segments."""
    own = load(spark, sf, "customer").select(F.lower("c_mktsegment").alias("table")).distinct()
    known = own.filter("table not in ('building', 'machinery')").select("table", F.col("table").alias("column"))
    known = known.unionByName(own.select("table", F.explode(F.array(*map(F.lit, ("c_name", "c_acctbal")))).alias("column")))
    return S.config_columns_not_in_schema(customer_configs(spark, sf), known, table_col="table")


def c_drift_log(spark, sf):
    """Schema differences of the configs as drift rows, counted by section."""
    wrong = c_config_columns(spark, sf).select(F.col("config").alias("table"), "column", F.col("section").alias("kind"))
    return S.drift_log(wrong).filter(F.col("logged_at").isNotNull()).groupBy("kind", "column").agg(F.count(F.lit(1)).alias("n"))


#: (columns of the run's snapshot, what decides whether a customer's table has it, its type)
SNAPSHOTS = {
    1: [("c_name", "true", "string"), ("c_acctbal", "true", "double"), ("c_phone", "c_custkey % 3 = 0", "string")],
    2: [("c_name", "true", "string"), ("c_acctbal", "true", "double"), ("c_phone", "c_custkey % 6 = 0", "string"), ("extra", "c_custkey % 5 = 0", "int")],
    3: [("c_name", "c_custkey % 11 <> 0", "string"), ("c_acctbal", "true", "case when c_custkey % 7 = 0 then 'decimal(12,2)' else 'double' end"),
        ("c_phone", "c_custkey % 3 = 0", "string")],
    4: [("c_name", "true", "string"), ("c_acctbal", "true", "double"), ("c_phone", "c_custkey % 3 = 0", "string")],
}


def _snapshot(customers: DataFrame, run: int) -> DataFrame:
    """The columns that every customer's table has at a run."""
    columns = [F.when(F.expr(test), F.struct(F.lit(name).alias("column"), F.expr(kind if kind.startswith("case") else f"'{kind}'").alias("type")))
               for name, test, kind in SNAPSHOTS[run]]
    return customers.select(F.col("c_name").alias("table"), F.explode(F.array(*columns)).alias("c")).filter("c is not null").select("table", "c.*")


def _history(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The schema history after all runs, the third of them run twice, and the drift log they leave."""
    customers = load(spark, sf, "customer")
    history = spark.createDataFrame([], S.HISTORY)
    log = None
    for run in (1, 2, 3, 3, 4):
        history = stage_table(S.schema_history(history, _snapshot(customers, run), run), f"schema-history-{run}")
        drift = S.drift_of_run(history, run)
        if log is None:
            log = S.drift_log(drift).withColumn("run_id", F.lit(run).cast("long"))
        else:
            log = log.unionByName(S.append_drift(log, drift, run))
        log = stage_table(log, f"drift-log-{run}")
    return history, log


def c_schema_history(spark, sf):
    return _history(spark, sf)[0]


def c_drift_runs(spark, sf):
    log = _history(spark, sf)[1]
    return log.groupBy("run_id", "column", "kind", "type_before", "type_after").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    r_bad_rules_orders, j_fk_text_keys, e_bad_suite, s_delimited_scan, s_comment_scan, r_short_rows, f_delimiter_check,
    f_lines_without_delimiter, s_id_list, s_json_lines, s_keyed_document, s_violation_sink, k_stack, g_count_check, g_count_mismatches,
    a_config_errors, a_config_verdict, a_missing_sections, c_config_columns, c_drift_log, s_publish_table, f_manifest, g_member_files,
    c_schema_history, c_drift_runs)}

# ---------------------------------------------------------------- the same in SQL

_ORDER_LINES = f"""
WITH o AS (SELECT *, CAST(o_orderkey AS VARCHAR) || chr(9) || o_orderstatus || chr(9) || o_orderpriority AS whole FROM orders),
l AS (SELECT o_orderkey // {FILE_ROWS} AS file_no, row_number() OVER (PARTITION BY o_orderkey // {FILE_ROWS} ORDER BY o_orderkey) + 2 AS line_number,
    o_orderkey, o_orderstatus, o_orderpriority,
    CASE WHEN o_orderkey % 100 = 7 THEN CAST(o_orderkey AS VARCHAR) || chr(9) || o_orderstatus
         WHEN o_orderkey % {7 * FILE_ROWS} = 0 THEN replace(whole, chr(9), ' ') ELSE whole END AS value FROM o)"""

_CONFIG_ERRORS = """
faults(kind, section, message) AS (VALUES
    (1, 'required_fields', 'Missing required field: ''target_table'''),
    (2, 'required_fields', 'Missing required field: ''input_files'''),
    (3, 'input_files', 'input_files must be a list'), (4, 'input_files', 'input_files must be a list'),
    (5, 'input_files[0]', 'Missing field: file_path'), (5, 'input_files[0]', 'Missing field: delimiter'),
    (5, 'input_files[0]', 'Missing field: ignore_first_line'),
    (6, 'output_file', 'Missing field: output_file_path'), (6, 'output_file', 'Missing field: ignore_first_line'),
    (7, 'transformations[0]', 'Each transformation must include ''column_name'' and ''operation'''),
    (8, 'validations', 'validations must be a list'),
    (9, 'referential_integrity[0]', 'Missing field: reference_table'), (9, 'referential_integrity[0]', 'Missing field: reference_column'),
    (10, 'great_expectations_validations[0]', 'Each entry must have ''expectation_type'' and ''params'''),
    (11, 'schema_drift_handling', 'Missing field: log_table'), (11, 'schema_drift_handling', 'Missing field: log_path'),
    (12, 'logging', 'Missing field: output_delta_path'),
    (13, 'versioning', '''created_at'' is not a valid ISO timestamp'),
    (14, 'versioning', 'Missing field: created_by'), (14, 'versioning', '''created_at'' is not a valid ISO timestamp'))"""

_COLUMNS = """
used AS (
    SELECT c_name AS config, lower(c_mktsegment) AS tab, 'validations' AS section, 0 AS idx, lower(c_mktsegment) AS "column" FROM customer
        WHERE c_custkey % 16 NOT IN (1, 8)
    UNION ALL SELECT c_name, lower(c_mktsegment), 'referential_integrity', 0, 'c_nationkey' FROM customer WHERE c_custkey % 16 = 9
    UNION ALL SELECT c_name, lower(c_mktsegment), 'great_expectations_validations', 0, 'c_acctbal' FROM customer WHERE c_custkey % 16 = 10
    UNION ALL SELECT c_name, lower(c_mktsegment), 'transformations', 0, 'c_name' FROM customer WHERE c_custkey % 16 = 7
    UNION ALL SELECT c_name, lower(c_mktsegment), 'transformations', 1, 'c_phone' FROM customer WHERE c_custkey % 16 = 7
    UNION ALL SELECT c_name, NULL, 'validations', 0, lower(c_mktsegment) FROM customer WHERE c_custkey % 16 = 1),
wrong AS (SELECT * FROM used WHERE tab IS NULL OR ("column" NOT IN ('c_name', 'c_acctbal')
    AND ("column" <> tab OR tab IN ('building', 'machinery'))))"""

_LISTED = """
FROM (SELECT l_orderkey, count(*) AS n_listed, CAST(max(l_linenumber) AS BIGINT) AS n_declared FROM lineitem GROUP BY l_orderkey) t"""


def _seen(run: int) -> str:
    return " UNION ALL ".join(
        f"SELECT c_name AS tab, '{name}' AS col, CAST({kind if kind.startswith('case') else repr(kind)} AS VARCHAR) AS kind, {run} AS run FROM customer WHERE {test}"
        for name, test, kind in SNAPSHOTS[run])


#: gaps and islands: a column's runs of one type without a break are one interval
_HISTORY = f"""
WITH seen AS ({" UNION ALL ".join(_seen(run) for run in SNAPSHOTS)}),
steps AS (SELECT *, run - row_number() OVER (PARTITION BY tab, col, kind ORDER BY run) AS island FROM seen),
intervals AS (SELECT tab, col, kind, CAST(min(run) AS BIGINT) AS from_run,
    CASE WHEN max(run) < {max(SNAPSHOTS)} THEN CAST(max(run) + 1 AS BIGINT) END AS to_run FROM steps GROUP BY tab, col, kind, island)"""

ORACLE_SQL = {
    "c_schema_history": _HISTORY + """
SELECT tab AS "table", col AS "column", kind AS type, from_run, to_run FROM intervals""",
    "c_drift_runs": _HISTORY + f""",
runs AS (SELECT unnest([{", ".join(str(r) for r in SNAPSHOTS if r > min(SNAPSHOTS))}]) AS run_id),
ends AS (SELECT tab, col, run_id, max(CASE WHEN to_run = run_id THEN kind END) AS b, max(CASE WHEN from_run = run_id THEN kind END) AS a, min(from_run) AS since
    FROM intervals, runs GROUP BY tab, col, run_id)
SELECT CAST(run_id AS BIGINT) AS run_id, col AS "column", CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 'retyped' WHEN b IS NOT NULL THEN 'removed'
    WHEN since < run_id THEN 'returned' ELSE 'added' END AS kind, b AS type_before, a AS type_after, count(*) AS n
FROM ends WHERE a IS NOT NULL OR b IS NOT NULL GROUP BY ALL""",
    "s_publish_table": """
SELECT CAST(NULL AS VARCHAR) AS l_returnflag, l_linenumber, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem
WHERE l_quantity > 25 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25) GROUP BY l_linenumber""",
    "f_manifest": _ORDER_LINES + """
, f AS (SELECT file_no, CAST(22 + 41 + sum(strlen(value) + 1) AS BIGINT) AS bytes FROM l GROUP BY file_no)
SELECT file_no, 'file' AS kind, 'found' AS status, bytes AS length, FALSE AS has_error FROM f
UNION ALL SELECT file_no, 'again', 'found', bytes, FALSE FROM f WHERE file_no % 3 = 0
UNION ALL SELECT file_no, 'gone', 'not_found', NULL, FALSE FROM f WHERE file_no % 4 = 0
UNION ALL SELECT file_no, 'folder', 'error', NULL, TRUE FROM f WHERE file_no % 5 = 0
UNION ALL SELECT file_no, 'through', 'error', NULL, TRUE FROM f WHERE file_no % 6 = 0""",
    "g_member_files": """
WITH s AS (SELECT *, s_suppkey % 13 <> 0 AS here, CAST(s_suppkey % 7 <> 0 AS INT) AS one, CAST(s_suppkey % 11 = 0 AS INT) AS two FROM supplier)
SELECT 'n' || CAST(s_nationkey AS VARCHAR) AS "group", 'S_' || CAST(s_suppkey AS VARCHAR) AS member,
    CAST(CASE WHEN here THEN one + two ELSE 0 END AS BIGINT) AS n_matches,
    CASE WHEN NOT here OR one + two = 0 THEN 'none' WHEN one + two = 1 THEN 'ok' ELSE 'many' END AS status,
    CASE WHEN here AND one + two = 1 THEN 'S_' || CAST(s_suppkey AS VARCHAR) || CASE WHEN one = 1 THEN '_a' ELSE '_b' END || '_protein.faa.gz' END AS file
FROM s""",
    "r_bad_rules_orders": """
SELECT 0 AS rule_idx, 'error' AS status, CAST(NULL AS BIGINT) AS n_violations
UNION ALL SELECT 1, 'error', NULL UNION ALL SELECT 2, 'error', NULL
UNION ALL SELECT 3, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, count(*) FROM orders WHERE o_totalprice < 1000
UNION ALL SELECT 4, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, count(*) FROM orders WHERE o_orderstatus NOT IN ('1', '2')
UNION ALL SELECT 5, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, count(*) FROM orders WHERE o_orderkey NOT IN (1, 2)
UNION ALL SELECT 6, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, count(*) FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-')""",
    "j_fk_text_keys": """
SELECT 0 AS rule_idx, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status, count(*) AS n_violations, count(DISTINCT l_orderkey) AS n_orphan_keys
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 1, 'type_mismatch', NULL, NULL
UNION ALL SELECT 2, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, count(*), count(DISTINCT CASE WHEN l_linenumber = 1 THEN 'x' ELSE '' END || l_partkey)
FROM lineitem WHERE l_linenumber = 1 OR l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
    "e_bad_suite": """
SELECT 0 AS exp_idx, 'error' AS status, FALSE AS success, CAST(NULL AS BIGINT) AS unexpected_count
UNION ALL SELECT 1, 'error', FALSE, NULL
UNION ALL SELECT 2, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END, n = 0, n FROM (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0) t
UNION ALL SELECT 3, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END, n = 0, n FROM (SELECT count(*) AS n FROM customer WHERE c_mktsegment IS NULL) t""",
    "s_delimited_scan": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer",
    "s_comment_scan": _ORDER_LINES + f"""
SELECT CASE WHEN o_orderkey % 100 <> 7 AND o_orderkey % {7 * FILE_ROWS} = 0 THEN value ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
    CASE WHEN o_orderkey % 100 = 7 OR o_orderkey % {7 * FILE_ROWS} <> 0 THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 100 <> 7 AND o_orderkey % {7 * FILE_ROWS} <> 0 THEN o_orderpriority END AS o_orderpriority FROM l""",
    "r_short_rows": _ORDER_LINES + """
SELECT line_number, CAST(len(string_split(value, chr(9))) AS INTEGER) AS n_fields, CAST(3 AS INTEGER) AS n_expected, value
FROM l WHERE len(string_split(value, chr(9))) < 3""",
    "f_delimiter_check": _ORDER_LINES + """
, five AS (SELECT file_no, 2 AS line_number, TRUE AS ok FROM l GROUP BY file_no
    UNION ALL SELECT file_no, line_number, contains(value, chr(9)) FROM l WHERE line_number <= 6)
SELECT file_no, count(*) AS checked_lines, CAST(count(*) FILTER (WHERE NOT ok) AS INTEGER) AS n_invalid, bool_and(ok) AS is_valid FROM five GROUP BY file_no""",
    "f_lines_without_delimiter": _ORDER_LINES + f"""
SELECT value FROM l WHERE NOT contains(value, chr(9))
UNION ALL SELECT '# orders, as exported' FROM (SELECT DISTINCT file_no FROM l) f""",
    "s_id_list": "SELECT trim(p_name) AS id FROM part WHERE p_size % 5 <> 0",
    "s_json_lines": """
SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level, count(*) AS n
FROM events WHERE value <= 200 OR value IS NULL GROUP BY 1""",
    "s_keyed_document": """
SELECT c_name AS "key", c_mktsegment AS genome, CAST(c_nationkey AS VARCHAR) AS aa, CAST(NULL AS VARCHAR) AS aux_genome FROM customer""",
    "s_violation_sink": """
SELECT 'l_partkey' AS failed_fk, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem
WHERE l_quantity > 25 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
    "k_stack": """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
    "g_count_check": """
SELECT count(*) AS n_groups, CAST(sum(n_listed) AS BIGINT) AS n_exploded, CAST(sum(n_declared) AS BIGINT) AS n_declared,
    count(*) FILTER (WHERE n_listed IS DISTINCT FROM n_declared) AS n_mismatched_groups,
    sum(n_listed) IS NOT DISTINCT FROM sum(n_declared) AS matches""" + _LISTED,
    "g_count_mismatches": "SELECT l_orderkey, n_listed, n_declared" + _LISTED + " WHERE n_listed <> n_declared",
    "a_config_errors": "WITH" + _CONFIG_ERRORS + """
SELECT c_name AS config, section, message FROM customer JOIN faults ON c_custkey % 16 = kind""",
    "a_config_verdict": "WITH" + _CONFIG_ERRORS + """
SELECT c_name AS config, count(kind) AS n_errors, count(kind) = 0 AS valid FROM customer LEFT JOIN faults ON c_custkey % 16 = kind GROUP BY c_name""",
    "a_missing_sections": """
SELECT c_name AS config, missing_section FROM customer, (VALUES ('bronze'), ('silver')) v(missing_section)
UNION ALL SELECT c_name, 'target_table' FROM customer WHERE c_custkey % 16 = 1
UNION ALL SELECT c_name, 'input_files' FROM customer WHERE c_custkey % 16 = 2""",
    "c_config_columns": "WITH" + _COLUMNS + ' SELECT config, section, idx, "column" FROM wrong',
    "c_drift_log": "WITH" + _COLUMNS + ' SELECT section AS kind, "column", count(*) AS n FROM wrong GROUP BY section, "column"',
}
