"""DuckDB SQL oracles, one per registered query (same column names and types).

Written independently of the Spark code: predicates are spelled out in SQL.
Tables are the driver's pre-registered views.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


# ------------------------------------------------------------ lineitem rules
# (rule_idx, rule_id, kind, column, violation predicate, message)
_LI_RULES = [
    (0, "l_returnflag - not_null", "not_null", "l_returnflag",
     "l_returnflag IS NULL OR l_returnflag = ''", "return flag is required"),
    (1, "l_quantity - numeric_range", "numeric_range", "l_quantity",
     "l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 40)", "quantity out of range"),
    (2, "l_returnflag - allowed_values", "allowed_values", "l_returnflag",
     "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'R')", "unexpected return flag"),
    (3, "l_linestatus - regex_match", "regex_match", "l_linestatus",
     "l_linestatus IS NOT NULL AND NOT regexp_matches(l_linestatus, '^[OF]$')", "bad line status"),
    (4, "l_discount - numeric_range", "numeric_range", "l_discount",
     "l_discount IS NOT NULL AND l_discount > 0.08", "discount too high"),
]
_LI_BAD = [
    (5, "l_comment - not_null", "not_null", "l_comment", "unknown_column", "Unknown column: l_comment"),
    (6, "l_tax - is_positive", "is_positive", "l_tax", "unknown_type", "Unknown validation type: is_positive"),
    (7, "l_linestatus - regex_match", "regex_match", "l_linestatus", "error",
     "Missing pattern for regex_match on column l_linestatus"),
]


def _report_sql(table: str, good, bad) -> str:
    aggs = ["count(*) AS n"]
    for idx, _rid, _kind, col, pred, _msg in good:
        aggs.append(f"count(*) FILTER (WHERE {pred}) AS v{idx}")
        aggs.append(f"count(*) FILTER (WHERE {col} IS NULL) AS z{idx}")
    rows = []
    for idx, rid, kind, col, _pred, msg in good:
        rows.append(
            f"SELECT {idx} AS rule_idx, '{rid}' AS rule_id, '{kind}' AS kind, '{col}' AS \"column\", "
            f"CASE WHEN v{idx} = 0 THEN 'pass' ELSE 'fail' END AS status, n AS n_rows, "
            f"z{idx} AS n_nulls, v{idx} AS n_violations, '{msg}' AS message FROM c")
    for idx, rid, kind, col, status, msg in bad:
        rows.append(
            f"SELECT {idx} AS rule_idx, '{rid}' AS rule_id, '{kind}' AS kind, '{col}' AS \"column\", "
            f"'{status}' AS status, n AS n_rows, CAST(NULL AS BIGINT) AS n_nulls, "
            f"CAST(NULL AS BIGINT) AS n_violations, '{msg}' AS message FROM c")
    return f"WITH c AS (SELECT {', '.join(aggs)} FROM {table})\n" + _union(rows)


ORACLE_SQL["r_rules_lineitem"] = _report_sql("lineitem", _LI_RULES, _LI_BAD)

ORACLE_SQL["r_passed_rules"] = (
    f"SELECT DISTINCT rule_id FROM ({_report_sql('lineitem', _LI_RULES, _LI_BAD)}) r WHERE status = 'pass'")

ORACLE_SQL["r_validation_summary"] = f"""
SELECT count(*) FILTER (WHERE status <> 'pass') = 0 AS success, count(*) AS n_rules,
       CAST(count(*) FILTER (WHERE status <> 'pass') AS INTEGER) AS n_errors
FROM ({_report_sql('lineitem', _LI_RULES, _LI_BAD)}) r"""

_LI_VIOLATIONS = _union([
    f"SELECT l_orderkey, l_linenumber, {idx} AS rule_idx, '{rid}' AS rule_id, '{col}' AS \"column\", "
    f"CAST({col} AS VARCHAR) AS value FROM lineitem WHERE {pred}"
    for idx, rid, _kind, col, pred, _msg in _LI_RULES])

# why each lineitem rule fails a row
_LI_REASONS = {
    0: "CASE WHEN l_returnflag IS NULL THEN 'null' ELSE 'empty' END",
    1: "CASE WHEN l_quantity < 1 THEN 'below_min' ELSE 'above_max' END",
    2: "'not_allowed'",
    3: "'no_match'",
    4: "'above_max'",
}
ORACLE_SQL["r_violation_rows"] = _union([
    f"SELECT l_orderkey, l_linenumber, {idx} AS rule_idx, '{rid}' AS rule_id, '{col}' AS \"column\", "
    f"CAST({col} AS VARCHAR) AS value, {_LI_REASONS[idx]} AS reason FROM lineitem WHERE {pred}"
    for idx, rid, _kind, col, pred, _msg in _LI_RULES])

ORACLE_SQL["r_violation_samples"] = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY rule_idx
        ORDER BY value NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS INTEGER) AS rank
FROM ({_LI_VIOLATIONS}) v
QUALIFY rank <= 5"""

# ------------------------------------------------------------ customer rules
_CU_RULES = [
    (0, "c_name - regex_match", "regex_match", "c_name",
     "c_name IS NOT NULL AND NOT regexp_matches(c_name, '^(?:Customer#0000001[0-9]{2})')",
     "name outside the first block"),
    (1, "c_acctbal - numeric_range", "numeric_range", "c_acctbal",
     "c_acctbal IS NOT NULL AND (c_acctbal < 0 OR c_acctbal > 9000)", "balance out of range"),
    (2, "c_mktsegment - allowed_values", "allowed_values", "c_mktsegment",
     "c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')",
     "unknown segment"),
    (3, "c_name - not_null", "not_null", "c_name", "c_name IS NULL OR c_name = ''", "name is required"),
]
_CU_BAD = [
    (4, "c_acctbal - numeric_range", "numeric_range", "c_acctbal", "error",
     "numeric_range on c_acctbal has neither min nor max"),
    (5, "c_mktsegment - allowed_values", "allowed_values", "c_mktsegment", "error",
     "allowed_values on c_mktsegment has an empty value list"),
]
ORACLE_SQL["r_rules_customer"] = _report_sql(
    "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, trim(c_mktsegment) AS c_mktsegment FROM customer)",
    _CU_RULES, _CU_BAD)

# ------------------------------------------------------------ foreign keys
_REFS = {
    "orders_finished": "(SELECT * FROM orders WHERE o_orderstatus = 'F')",
    "part_small": "(SELECT * FROM part WHERE p_size <= 25)",
    "supplier": "supplier",
    "customer_building": "(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')",
    "lineitem": "lineitem",
}
_ORDERS_NULL_FK = ("(SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey, "
                   "o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)")


def _fk_ok(idx, target, fk, ref, rcol, action="log"):
    refname = f"tpch.{ref}.{rcol}"
    return f"""
SELECT {idx} AS rule_idx, '{fk}' AS foreign_key, '{refname}' AS reference, '{action}' AS action,
       CASE WHEN coalesce(sum(n), 0) = 0 THEN 'pass' ELSE 'fail' END AS status,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS n_violations, count(*) AS n_orphan_keys,
       '{fk} -> {refname}: ' || CAST(coalesce(sum(n), 0) AS VARCHAR) || ' violation(s)' AS message
FROM (SELECT {fk} AS k, count(*) AS n FROM {target} t
      WHERE NOT EXISTS (SELECT 1 FROM {_REFS[ref]} r WHERE r.{rcol} = t.{fk}) GROUP BY {fk}) o"""


def _fk_bad(idx, fk, reference, status, msg, action="log"):
    return (f"SELECT {idx} AS rule_idx, '{fk}' AS foreign_key, '{reference}' AS reference, '{action}' AS action, "
            f"'{status}' AS status, CAST(NULL AS BIGINT) AS n_violations, CAST(NULL AS BIGINT) AS n_orphan_keys, "
            f"'{msg}' AS message")


_LI_FK_REPORT = _union([
    _fk_ok(0, "lineitem", "l_orderkey", "orders_finished", "o_orderkey"),
    _fk_ok(1, "lineitem", "l_partkey", "part_small", "p_partkey"),
    _fk_ok(2, "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _fk_bad(3, "l_shipkey", "tpch.supplier.s_suppkey", "missing_column",
            "Column ''l_shipkey'' not found in target table"),
    _fk_bad(4, "l_partkey", "tpch.part_archive.p_partkey", "missing_reference_table",
            "Reference table ''tpch.part_archive'' not found or unreadable: LookupError"),
    _fk_bad(5, "l_suppkey", "tpch.supplier.s_id", "missing_reference_column",
            "Column ''s_id'' not found in reference table ''tpch.supplier''"),
])
ORACLE_SQL["j_fk_report"] = _LI_FK_REPORT

ORACLE_SQL["j_fk_orders_report"] = _union([
    _fk_ok(0, _ORDERS_NULL_FK, "o_custkey", "customer_building", "c_custkey"),
    _fk_ok(1, _ORDERS_NULL_FK, "o_orderkey", "lineitem", "l_orderkey", action="count"),
])

ORACLE_SQL["j_fk_verdict"] = f"""
SELECT coalesce(bool_and(status = 'pass'), false) AS all_passed, count(*) AS n_rules,
       count(*) FILTER (WHERE status <> 'pass') AS n_failed
FROM ({_LI_FK_REPORT}) r"""


def _fk_rows(target, cols, fk, ref, rcol):
    return (f"SELECT {cols}, '{fk}' AS failed_fk FROM {target} t "
            f"WHERE NOT EXISTS (SELECT 1 FROM {_REFS[ref]} r WHERE r.{rcol} = t.{fk})")


_LI_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity"
ORACLE_SQL["j_fk_violations"] = _union([
    _fk_rows("lineitem", _LI_COLS, "l_orderkey", "orders_finished", "o_orderkey"),
    _fk_rows("lineitem", _LI_COLS, "l_partkey", "part_small", "p_partkey"),
    _fk_rows("lineitem", _LI_COLS, "l_suppkey", "supplier", "s_suppkey"),
])

ORACLE_SQL["j_fk_null_violations"] = _fk_rows(
    _ORDERS_NULL_FK, "o_orderkey, o_custkey, o_orderpriority", "o_custkey", "customer_building", "c_custkey")


def _fk_top(idx, fk, ref, rcol):
    return f"""
SELECT {idx} AS rule_idx, '{fk}' AS foreign_key,
       CAST(row_number() OVER (ORDER BY k NULLS FIRST) AS INTEGER) AS rank,
       CAST(k AS VARCHAR) AS value, n AS n_rows
FROM (SELECT {fk} AS k, count(*) AS n FROM lineitem t
      WHERE NOT EXISTS (SELECT 1 FROM {_REFS[ref]} r WHERE r.{rcol} = t.{fk})
      GROUP BY {fk} ORDER BY k NULLS FIRST LIMIT 5) o"""


ORACLE_SQL["j_fk_samples"] = _union([
    _fk_top(0, "l_orderkey", "orders_finished", "o_orderkey"),
    _fk_top(1, "l_partkey", "part_small", "p_partkey"),
    _fk_top(2, "l_suppkey", "supplier", "s_suppkey"),
])

# ------------------------------------------------------------ expectations
_SUITE_T = ("(SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_priority_or_null "
            "FROM orders)")


def _exp_value(idx, etype, col, unexpected, domain, mostly=1.0):
    return f"""
SELECT {idx} AS exp_idx, '{etype}' AS expectation_type, '{col}' AS "column",
       CASE WHEN d = 0 OR (d - u) / d >= {mostly} THEN 'pass' ELSE 'fail' END AS status,
       (d = 0 OR (d - u) / d >= {mostly}) AS success,
       n AS element_count, m AS missing_count, u AS unexpected_count,
       CASE WHEN d > 0 THEN 100.0 * u / d END AS unexpected_percent
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {col} IS NULL) AS m,
             count(*) FILTER (WHERE {unexpected}) AS u, count(*) FILTER (WHERE {domain}) AS d
      FROM {_SUITE_T}) s"""


def _exp_static(idx, etype, col, status, success):
    col_sql = f"'{col}'" if col is not None else "CAST(NULL AS VARCHAR)"
    return (f"SELECT {idx} AS exp_idx, '{etype}' AS expectation_type, {col_sql} AS \"column\", "
            f"'{status}' AS status, CAST({success} AS BOOLEAN) AS success, "
            "CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS missing_count, "
            "CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent")


_SUITE = _union([
    _exp_value(0, "expect_column_values_to_not_be_null", "o_orderkey", "o_orderkey IS NULL", "true"),
    _exp_value(1, "expect_column_values_to_match_regex", "o_orderpriority",
               "o_orderpriority IS NOT NULL AND NOT regexp_matches(o_orderpriority, '^[1-3]-')",
               "o_orderpriority IS NOT NULL"),
    _exp_value(2, "expect_column_values_to_be_between", "o_totalprice",
               "o_totalprice IS NOT NULL AND NOT (o_totalprice >= 1000 AND o_totalprice <= 400000)",
               "o_totalprice IS NOT NULL"),
    _exp_value(3, "expect_column_values_to_be_between", "o_totalprice",
               "o_totalprice IS NOT NULL AND NOT (o_totalprice >= 0 AND o_totalprice <= 600000)",
               "o_totalprice IS NOT NULL", mostly=0.95),
    _exp_value(4, "expect_column_values_to_not_be_null", "o_priority_or_null",
               "o_priority_or_null IS NULL", "true"),
    _exp_static(5, "expect_column_to_exist", "o_orderdate", "pass", "true"),
    _exp_static(6, "expect_column_to_exist", "o_comment", "fail", "false"),
    _exp_static(7, "expect_table_row_count_to_equal", None, "unknown", "NULL"),
])
ORACLE_SQL["e_suite_report"] = _SUITE
ORACLE_SQL["e_suite_stats"] = f"""
SELECT coalesce(bool_and(success), true) AS success, count(*) AS evaluated_expectations,
       count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       CASE WHEN count(*) > 0 THEN 100.0 * count(*) FILTER (WHERE success) / count(*) END AS success_percent
FROM ({_SUITE}) r WHERE status <> 'unknown'"""

# ------------------------------------------------------------ curation expressions
ORACLE_SQL["k_ani_groups"] = """
SELECT CASE WHEN s = 100.0 THEN 'Group1: 100'
            WHEN s > 99.5 AND s <= 99.9 THEN 'Group2: 99.9-99.5'
            WHEN s > 99.0 AND s <= 99.5 THEN 'Group3: 99.5-99.0'
            WHEN s > 98.5 AND s <= 99.0 THEN 'Group4: 99.0-98.5'
            WHEN s > 98.0 AND s <= 98.5 THEN 'Group5: 98.5-98.0'
            WHEN s > 97.0 AND s <= 98.0 THEN 'Group6: 98.0-97.0'
            ELSE 'Group7: LT 97.0' END AS ani_group,
       count(*) AS n
FROM (SELECT CAST(100.0 AS DOUBLE) - l_discount * CAST(40.0 AS DOUBLE) AS s FROM lineitem) t
GROUP BY 1"""

ORACLE_SQL["k_url_parts"] = """
SELECT page_id, p[1] AS scheme, p[2] AS blank, p[3] AS host, p[4] AS lang, p[5] AS page, p[6] AS extra,
       CAST(len(p) AS INTEGER) AS n_parts
FROM (SELECT page_id, string_split(url, '/') AS p FROM pages) t"""

ORACLE_SQL["k_compose_key"] = """
SELECT p_partkey, replace(p_name || '--' || p_brand, ' ', '_') AS clade_key, substr(p_brand, 7) AS brand_code
FROM part"""

_PART_FLAGS = """
SELECT p_partkey, CASE WHEN p_size < 5 THEN 1 ELSE 0 END AS filter_a,
       CASE WHEN p_brand IN ('Brand#1') OR list_has_any(string_split(p_name, ' '), ['red', 'small'])
            THEN 1 ELSE 0 END AS filter_b
FROM part"""
ORACLE_SQL["k_part_flags"] = _PART_FLAGS
ORACLE_SQL["k_part_flag_summary"] = f"""
SELECT count(*) AS n_rows, CAST(coalesce(sum(filter_a), 0) AS BIGINT) AS n_filter_a,
       CAST(coalesce(sum(CASE WHEN filter_a = 0 THEN filter_b END), 0) AS BIGINT) AS n_filter_b_only
FROM ({_PART_FLAGS}) f"""

ORACLE_SQL["k_keep_drop"] = """
WITH fin AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'),
     kept AS (SELECT * FROM customer c WHERE EXISTS (SELECT 1 FROM fin WHERE fin.o_custkey = c.c_custkey))
SELECT 'kept' AS metric, count(*) AS value FROM kept
UNION ALL SELECT 'dropped', count(*) FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM fin WHERE fin.o_custkey = c.c_custkey)
UNION ALL SELECT 'expected', count(DISTINCT o_custkey) FROM fin
UNION ALL SELECT 'found', count(DISTINCT c_custkey) FROM kept
UNION ALL SELECT 'missing', count(*) FROM (SELECT DISTINCT o_custkey FROM fin) f
  WHERE NOT EXISTS (SELECT 1 FROM kept WHERE kept.c_custkey = f.o_custkey)"""

# ------------------------------------------------------------ documents as groups of lines
_LINES = """
SELECT doc_id, n_lines, CAST(unnest(range(len(l))) AS INTEGER) AS line_no, unnest(l) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS l, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines
      FROM documents) d"""
_FLAGGED = f"""
WITH lines AS ({_LINES}),
rep AS (SELECT line FROM lines GROUP BY line HAVING count(DISTINCT doc_id) >= 3),
flagged AS (
  SELECT l.*, CASE WHEN n_lines < 2 THEN 1 ELSE 0 END AS filter_a,
         CASE WHEN r.line IS NOT NULL THEN 1 ELSE 0 END AS filter_b
  FROM lines l LEFT JOIN rep r ON l.line = r.line),
members AS (SELECT *, greatest(filter_a, filter_b) AS removed FROM flagged),
groups AS (
  SELECT doc_id, count(*) AS n_members, count(*) FILTER (WHERE removed = 1) AS n_removed,
         count(*) FILTER (WHERE removed = 0) AS n_retained,
         count(*) FILTER (WHERE removed = 0) >= 2 AS kept
  FROM members GROUP BY doc_id),
staged AS (
  SELECT m.*, CASE WHEN m.removed = 0 AND NOT g.kept THEN 1 ELSE 0 END AS cascade,
         CASE WHEN m.removed = 0 AND g.kept THEN 1 ELSE 0 END AS retained
  FROM members m JOIN groups g USING (doc_id))
"""
ORACLE_SQL["g_members"] = f"SELECT doc_id, line_no, line FROM ({_LINES}) t"
ORACLE_SQL["k_line_flags"] = _FLAGGED + """
SELECT count(*) AS n_rows, CAST(coalesce(sum(filter_a), 0) AS BIGINT) AS n_filter_a,
       CAST(coalesce(sum(CASE WHEN filter_a = 0 THEN filter_b END), 0) AS BIGINT) AS n_filter_b_only
FROM flagged"""
ORACLE_SQL["g_stage_groups"] = _FLAGGED + "SELECT * FROM groups"
ORACLE_SQL["g_cascade_members"] = _FLAGGED + "SELECT doc_id, line_no FROM staged WHERE cascade = 1"
ORACLE_SQL["g_changed_groups"] = _FLAGGED + """
SELECT count(*) AS n_groups, count(*) FILTER (WHERE n_members IS DISTINCT FROM n_retained) AS n_changed,
       count(*) FILTER (WHERE NOT kept) AS n_dropped FROM groups"""
ORACLE_SQL["g_retained_text"] = _FLAGGED + """
SELECT doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE retained = 1), '') AS retained_members,
       coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE retained = 0), '') AS removed_members,
       count(*) FILTER (WHERE retained = 1) AS n_retained
FROM staged GROUP BY doc_id"""

# ------------------------------------------------------------ customers as pair members
_PAIRS = """
WITH pairs AS (
  SELECT a.o_orderkey AS pair_id, a.o_custkey AS genome1, b.o_custkey AS genome2,
         100.0 * least(a.o_totalprice, b.o_totalprice) / greatest(a.o_totalprice, b.o_totalprice) AS score
  FROM orders a JOIN orders b ON b.o_orderkey - 1 = a.o_orderkey),
valid AS (
  SELECT p.pair_id, p.genome1, p.genome2, c1.c_nationkey AS "group", c1.c_acctbal AS size1,
         c2.c_acctbal AS size2, least(c1.c_acctbal, c2.c_acctbal) AS min_size,
         least(CAST(p.genome1 AS VARCHAR), CAST(p.genome2 AS VARCHAR)) || '_' ||
           greatest(CAST(p.genome1 AS VARCHAR), CAST(p.genome2 AS VARCHAR)) AS pair_key,
         p.score
  FROM pairs p JOIN customer c1 ON c1.c_custkey = p.genome1 JOIN customer c2 ON c2.c_custkey = p.genome2
  WHERE c1.c_nationkey = c2.c_nationkey AND p.genome1 <> p.genome2),
surv AS (
  SELECT *, CASE WHEN size1 < size2 THEN genome1 ELSE genome2 END AS loser,
         min_size IS NULL AS nn
  FROM valid WHERE score >= 97.0),
removed AS (SELECT DISTINCT loser AS member FROM surv),
members AS (
  SELECT c_custkey AS member, c_nationkey AS "group", c_acctbal AS size,
         CASE WHEN c_custkey IN (SELECT member FROM removed) THEN 1 ELSE 0 END AS removed
  FROM customer),
groups AS (
  SELECT "group", count(*) AS n_members, count(*) FILTER (WHERE removed = 1) AS n_removed,
         count(*) FILTER (WHERE removed = 0) AS n_retained, count(*) FILTER (WHERE removed = 0) >= 2 AS kept
  FROM members GROUP BY "group")
"""
ORACLE_SQL["g_valid_pairs"] = _PAIRS + (
    "SELECT pair_id, genome1, genome2, \"group\", size1, size2, min_size, pair_key, score FROM valid")
ORACLE_SQL["g_scored_pairs"] = _PAIRS + 'SELECT pair_id, pair_key, "group", score FROM surv'
ORACLE_SQL["g_near_dup_removed"] = _PAIRS + "SELECT member FROM removed"
ORACLE_SQL["g_already_removed"] = _PAIRS + """
SELECT count(*) AS n_pairs,
       count(*) FILTER (WHERE EXISTS (
         SELECT 1 FROM surv e
         WHERE (e.loser = p.genome1 OR e.loser = p.genome2)
           AND (e.nn < p.nn OR (e.nn = p.nn AND (coalesce(e.min_size < p.min_size, false)
                OR (e.min_size IS NOT DISTINCT FROM p.min_size AND e.pair_id < p.pair_id)))))) AS n_already_removed,
       count(DISTINCT loser) AS n_removed
FROM surv p"""
ORACLE_SQL["g_pair_coverage"] = _PAIRS + """
SELECT g."group", g.n_members, CAST(g.n_members * (g.n_members - 1) // 2 AS BIGINT) AS expected_pairs,
       coalesce(s.scored_pairs, 0) AS scored_pairs,
       CAST(g.n_members * (g.n_members - 1) // 2 AS BIGINT) - coalesce(s.scored_pairs, 0) AS missing_pairs
FROM (SELECT c_nationkey AS "group", count(*) AS n_members FROM customer GROUP BY 1) g
LEFT JOIN (SELECT "group", count(DISTINCT pair_key) AS scored_pairs FROM valid GROUP BY 1) s USING ("group")"""
ORACLE_SQL["g_stage3_groups"] = _PAIRS + "SELECT * FROM groups"
ORACLE_SQL["g_group_stats"] = _PAIRS + """
, retained AS (
  SELECT m."group", m.size, coalesce(o.n_orders, 0) AS n_orders
  FROM members m JOIN groups g USING ("group")
  LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) o ON o.o_custkey = m.member
  WHERE m.removed = 0 AND g.kept)
SELECT "group", round(avg(size), 6) AS size_mean, round(CAST(median(size) AS DOUBLE), 6) AS size_median,
       min(size) AS size_min, max(size) AS size_max,
       round(avg(n_orders), 6) AS n_orders_mean, round(CAST(median(n_orders) AS DOUBLE), 6) AS n_orders_median,
       min(n_orders) AS n_orders_min, max(n_orders) AS n_orders_max
FROM retained GROUP BY "group" """
ORACLE_SQL["g_size_split"] = _PAIRS + """
SELECT "group", n_retained, CASE WHEN n_retained < 60 THEN 'LT' ELSE 'GTE' END AS size_class
FROM groups WHERE kept"""

# ------------------------------------------------------------ run logs from events
_LOG_GOOD = """
SELECT CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS time, 'events' AS pipeline, 'web' AS "schema",
       event_type AS "table",
       CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
       'user_' || CAST(user_id AS VARCHAR) AS module,
       CASE WHEN event_type = 'error' THEN chr(128680) || ' ' ELSE '' END || event_type || ' value='
         || CAST(value AS VARCHAR) || chr(9) || props AS msg,
       'pipeline_run_' || strftime(ts, '%Y%m%d') || '.log' AS log_file
FROM events WHERE NOT (value > 200)"""
ORACLE_SQL["l_log_view"] = f"""
SELECT * FROM ({_LOG_GOOD}) g
WHERE pipeline = 'events' AND level = 'ERROR'
  AND time >= TIMESTAMP '2024-01-03 00:00:00' AND time < TIMESTAMP '2024-01-10 00:00:00'"""
ORACLE_SQL["l_bad_lines"] = """
SELECT 'pipeline_run_' || strftime(ts, '%Y%m%d') || '.log' AS log_file, count(*) AS n_lines,
       count(*) FILTER (WHERE value > 200) AS n_bad
FROM events GROUP BY 1"""
ORACLE_SQL["l_options"] = f"""
SELECT DISTINCT * FROM (
  SELECT 'pipeline' AS field, pipeline AS value FROM ({_LOG_GOOD}) a
  UNION ALL SELECT 'schema', "schema" FROM ({_LOG_GOOD}) b
  UNION ALL SELECT 'table', "table" FROM ({_LOG_GOOD}) c
  UNION ALL SELECT 'level', level FROM ({_LOG_GOOD}) d) o
WHERE value IS NOT NULL"""
ORACLE_SQL["l_date_bounds"] = f"""
SELECT CAST(min(time) AS DATE) AS first_day, CAST(max(time) AS DATE) AS last_day FROM ({_LOG_GOOD}) g"""
ORACLE_SQL["l_file_union"] = f"""
SELECT log_file, level, count(*) AS n FROM ({_LOG_GOOD}) g
WHERE log_file IN ('pipeline_run_20240105.log', 'pipeline_run_20240106.log') GROUP BY 1, 2"""
ORACLE_SQL["s_path_count"] = "SELECT count(*) AS n_rows FROM lineitem"

# ------------------------------------------------------------ more rule / suite / FK queries
_DOC_RULES = [
    (0, "text - not_null", "not_null", "text", "text IS NULL OR text = ''", "text is required"),
    (1, "n_chars - numeric_range", "numeric_range", "n_chars",
     "n_chars IS NOT NULL AND (n_chars < 1 OR n_chars > 20000)", "document length out of range"),
    (2, "lang - allowed_values", "allowed_values", "lang",
     "lang IS NOT NULL AND lang NOT IN ('en', 'de', 'fr')", "unsupported language"),
    (3, "source - regex_match", "regex_match", "source",
     "source IS NOT NULL AND NOT regexp_matches(source, '^src[0-9]+$')", "bad source id"),
    (4, "text - regex_match", "regex_match", "text",
     "text IS NOT NULL AND NOT regexp_matches(text, '[A-Za-z]{3}')", "no latin word"),
]
ORACLE_SQL["r_rules_documents"] = _report_sql("documents", _DOC_RULES, [])


def _cust_value(idx, etype, col, unexpected, domain, mostly=1.0):
    return _exp_value(idx, etype, col, unexpected, domain, mostly).replace(_SUITE_T, "customer")


ORACLE_SQL["e_suite_customer"] = _union([
    _cust_value(0, "expect_column_values_to_not_be_null", "c_custkey", "c_custkey IS NULL", "true"),
    _cust_value(1, "expect_column_values_to_be_between", "c_acctbal",
                "c_acctbal IS NOT NULL AND NOT (c_acctbal >= 0)", "c_acctbal IS NOT NULL"),
    _cust_value(2, "expect_column_values_to_be_between", "c_acctbal",
                "c_acctbal IS NOT NULL AND NOT (c_acctbal >= 0)", "c_acctbal IS NOT NULL", mostly=0.9),
    _cust_value(3, "expect_column_values_to_match_regex", "c_mktsegment",
                "c_mktsegment IS NOT NULL AND NOT regexp_matches(c_mktsegment, '^[A-Z]+$')",
                "c_mktsegment IS NOT NULL"),
    _exp_static(4, "expect_column_to_exist", "c_phone", "fail", "false"),
    _cust_value(5, "expect_column_values_to_be_between", "c_nationkey",
                "c_nationkey IS NOT NULL AND NOT (c_nationkey >= 0 AND c_nationkey < 24)", "c_nationkey IS NOT NULL"),
])

_REFS.update({"nation": "nation", "region": "region", "customer": "customer", "documents": "documents"})


def _fk_clean(target, fk, ref, rcol):
    return f"SELECT '{target}' AS target, * FROM ({_fk_ok(0, target, fk, ref, rcol)}) r"


ORACLE_SQL["j_fk_clean"] = _union([
    _fk_clean("customer", "c_nationkey", "nation", "n_nationkey"),
    _fk_clean("nation", "n_regionkey", "region", "r_regionkey"),
    _fk_clean("events", "user_id", "customer", "c_custkey"),
    _fk_clean("labels", "doc_id", "documents", "doc_id"),
])

_EVENT_RULES = [
    (0, "event_type - allowed_values", "allowed_values", "event_type",
     "event_type IS NOT NULL AND event_type NOT IN ('click', 'view', 'purchase')", "unexpected event type"),
    (1, "props - regex_match", "regex_match", "props",
     "props IS NOT NULL AND NOT regexp_matches(props, '^\\{\"k\": [0-9]+\\}$')", "props not in the k form"),
    (2, "value - numeric_range", "numeric_range", "value",
     "value IS NOT NULL AND (value < 0 OR value > 300)", "value out of range"),
    (3, "props - numeric_range", "numeric_range", "props",
     "props IS NOT NULL AND (TRY_CAST(props AS DOUBLE) < 0 OR TRY_CAST(props AS DOUBLE) IS NULL)",
     "props is not a number"),
    (4, "user_id - allowed_values", "allowed_values", "user_id",
     "user_id IS NOT NULL AND CAST(user_id AS VARCHAR) NOT IN ('1', '2', '3')", "user outside the first three"),
]
ORACLE_SQL["r_rules_events"] = _report_sql("events", _EVENT_RULES, [])

_LOG_LINE = """
'{"time": "' || strftime(ts, '%Y-%m-%d %H:%M:%S,%g') || '", "pipeline": "events", "schema": "web", "table": "'
  || event_type || '", "level": "'
  || CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING' ELSE 'INFO' END
  || '", "module": "user_' || CAST(user_id AS VARCHAR) || '", "msg": "'
  || replace(replace(CASE WHEN event_type = 'error' THEN chr(128680) || ' ' ELSE '' END || event_type || ' value='
       || CAST(value AS VARCHAR) || chr(9) || props, '\\', '\\\\'), '"', '\\"')
  || '"}'"""
ORACLE_SQL["l_bad_line_list"] = f"""
SELECT 'pipeline_run_' || strftime(ts, '%Y%m%d') || '.log' AS log_file,
       substr(line, 1, length(line) - 1) AS bad_line
FROM (SELECT *, {_LOG_LINE} AS line FROM events WHERE value > 200) e"""

# unexpected cells of the orders suite (value expectations 0-4), as text
_SUITE_CELLS = _union([
    f"SELECT 0 AS exp_idx, CAST(o_orderkey AS VARCHAR) AS value FROM {_SUITE_T} t WHERE o_orderkey IS NULL",
    f"SELECT 1, o_orderpriority FROM {_SUITE_T} t "
    "WHERE o_orderpriority IS NOT NULL AND NOT regexp_matches(o_orderpriority, '^[1-3]-')",
    f"SELECT 2, CAST(o_totalprice AS VARCHAR) FROM {_SUITE_T} t "
    "WHERE o_totalprice IS NOT NULL AND NOT (o_totalprice >= 1000 AND o_totalprice <= 400000)",
    f"SELECT 3, CAST(o_totalprice AS VARCHAR) FROM {_SUITE_T} t "
    "WHERE o_totalprice IS NOT NULL AND NOT (o_totalprice >= 0 AND o_totalprice <= 600000)",
    f"SELECT 4, o_priority_or_null FROM {_SUITE_T} t WHERE o_priority_or_null IS NULL",
])
ORACLE_SQL["e_suite_samples"] = f"""
SELECT exp_idx, value, n_rows,
       CAST(row_number() OVER (PARTITION BY exp_idx ORDER BY value NULLS FIRST) AS INTEGER) AS rank
FROM (SELECT exp_idx, value, count(*) AS n_rows FROM ({_SUITE_CELLS}) c GROUP BY exp_idx, value) g
QUALIFY rank <= 20"""

# lineitem read as text (every column a string), the reference's data model
_LI_TEXT = ("(SELECT CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_discount AS VARCHAR) AS l_discount, "
            "l_returnflag, l_linestatus FROM lineitem)")
_LI_TEXT_RULES = [
    (0, "l_returnflag - not_null", "not_null", "l_returnflag",
     "l_returnflag IS NULL OR l_returnflag = ''", "return flag is required"),
    (1, "l_quantity - numeric_range", "numeric_range", "l_quantity",
     "l_quantity IS NOT NULL AND (TRY_CAST(l_quantity AS DOUBLE) IS NULL OR TRY_CAST(l_quantity AS DOUBLE) < 1 "
     "OR TRY_CAST(l_quantity AS DOUBLE) > 40)", "quantity out of range"),
    (2, "l_returnflag - allowed_values", "allowed_values", "l_returnflag",
     "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'R')", "unexpected return flag"),
    (3, "l_linestatus - regex_match", "regex_match", "l_linestatus",
     "l_linestatus IS NOT NULL AND NOT regexp_matches(l_linestatus, '^[OF]$')", "bad line status"),
    (4, "l_discount - numeric_range", "numeric_range", "l_discount",
     "l_discount IS NOT NULL AND (TRY_CAST(l_discount AS DOUBLE) IS NULL OR TRY_CAST(l_discount AS DOUBLE) > 0.08)",
     "discount too high"),
]
ORACLE_SQL["r_rules_lineitem_text"] = _report_sql(_LI_TEXT, _LI_TEXT_RULES, _LI_BAD)


from sievekit.plans.documents import ORACLE_SQL as _DOCUMENT_SQL  # noqa: E402
from sievekit.plans.part_clusters import ORACLE_SQL as _CLUSTER_SQL  # noqa: E402

ORACLE_SQL.update(_DOCUMENT_SQL)
ORACLE_SQL.update(_CLUSTER_SQL)
