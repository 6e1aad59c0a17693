"""Row rules on hand-made edge rows (nulls, blanks, NaN, non-numbers, bounds)."""

import math

from pyspark.sql import functions as F

from sievekit.operators import rules as R

EDGE = [None, "", "   ", " 7 ", "abc", "NaN", "inf", "1d", "1_0", "0", "100", "50"]


def _df(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(EDGE)], "id int, v string")


def _report(spark, rules, **opts):
    return {r.rule_idx: r for r in R.rule_report(_df(spark), rules, **opts).collect()}


def test_not_null_flags_null_and_empty(spark):
    r = _report(spark, [{"column": "v", "validation_type": "not_null"}])[0]
    assert (r.n_violations, r.n_nulls, r.n_rows, r.status) == (2, 1, len(EDGE), "fail")


def test_not_null_trim_option(spark):
    r = _report(spark, [{"column": "v", "validation_type": "not_null"}], trim=True)[0]
    assert r.n_violations == 3  # null, "", "   "


def test_numeric_range_semantics(spark):
    rules = [{"column": "v", "validation_type": "numeric_range", "min": 0, "max": 100}]
    rows = R.violation_rows(_df(spark), rules, ["id"]).orderBy("id").collect()
    bad = {EDGE[r.id] for r in rows}
    # text that does not parse is a violation; NaN sorts above max; inf > max;
    # Spark parses "1d" and trims " 7 "; "1_0" does not parse; null passes.
    assert bad == {"", "   ", "abc", "NaN", "inf", "1_0"}


def test_numeric_range_without_not_numeric(spark):
    rules = [{"column": "v", "validation_type": "numeric_range", "min": 0, "max": 100}]
    r = _report(spark, rules, not_numeric=False)[0]
    assert r.n_violations == 2  # NaN and inf only


def test_regex_search_vs_anchored(spark):
    rules = [{"column": "v", "validation_type": "regex_match", "pattern": "[0-9]"}]
    assert _report(spark, rules)[0].n_violations == 5  # "", "   ", "abc", "NaN", "inf"
    rules = [{"column": "v", "validation_type": "regex_match", "pattern": "[0-9]+$"}]
    assert _report(spark, rules, anchored=True)[0].n_violations == 8  # also " 7 ", "1d", "1_0"


def test_nulls_fail_option(spark):
    rules = [{"column": "v", "validation_type": "regex_match", "pattern": ".*"}]
    assert _report(spark, rules)[0].n_violations == 0
    assert _report(spark, rules, nulls="fail")[0].n_violations == 1


def test_allowed_values_and_bad_rules(spark):
    rules = [
        {"column": "v", "validation_type": "allowed_values", "values": ["0", "100"]},
        {"column": "v", "validation_type": "allowed_values", "values": []},
        {"column": "nope", "validation_type": "not_null"},
        {"column": "v", "validation_type": "is_even"},
        {"column": "v", "validation_type": "regex_match"},
        {"column": "v", "validation_type": "numeric_range"},
    ]
    rep = _report(spark, rules)
    assert rep[0].n_violations == len(EDGE) - 1 - 2  # null passes, "0" and "100" pass
    assert [rep[i].status for i in range(1, 6)] == ["error", "unknown_column", "unknown_type", "error", "error"]
    summary = R.validation_summary(R.rule_report(_df(spark), rules)).first()
    assert summary.success is False and len(summary.validation_errors) == 6


def test_no_rules_is_success(spark):
    rep = R.rule_report(_df(spark), [])
    assert rep.count() == 0
    assert R.validation_summary(rep).first().success is True


def test_numeric_column_not_null_does_not_compare_to_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,)], "x double")
    r = R.rule_report(df, [{"column": "x", "validation_type": "not_null"},
                           {"column": "x", "validation_type": "numeric_range", "max": 5}]).orderBy("rule_idx").collect()
    assert r[0].n_violations == 1 and r[1].n_violations == 1  # NaN > 5


def test_samples_are_deterministic_and_capped(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("v"))
    rules = [{"column": "v", "validation_type": "allowed_values", "values": ["0"]}]
    s = R.violation_samples(df, rules, ["id"], n=5).orderBy("rank").collect()
    assert [(r.value, r.id) for r in s] == [("1", 1), ("1", 8), ("1", 15), ("1", 22), ("1", 29)]


def test_violations_plus_valid_equals_total(spark):
    rules = [{"column": "v", "validation_type": "not_null"}]
    df = _df(spark)
    n_bad = R.violation_rows(df, rules, ["id"]).count()
    assert n_bad + df.filter(F.col("v").isNotNull() & (F.col("v") != "")).count() == df.count()


def test_violation_reasons(spark):
    rules = [{"column": "v", "validation_type": "numeric_range", "min": 0, "max": 60},
             {"column": "v", "validation_type": "not_null"}]
    rows = R.violation_rows(_df(spark), rules, ["id"], nulls="fail").collect()
    got = {(EDGE[r.id], r.rule_idx): r.reason for r in rows}
    assert got[("abc", 0)] == "not_numeric" and got[("100", 0)] == "above_max"
    assert got[("NaN", 0)] == "above_max" and got[(None, 0)] == "null"
    assert got[("", 1)] == "empty" and got[(None, 1)] == "null"


def _brute_samples(rows, test, n):
    return sorted((v is not None, v or "", k) for k, v in rows if test(v))[:n]


def test_samples_below_the_cuts_equal_a_full_sort(spark):
    """Few, many, no and equal violations; nulls; keys that break ties; any number of samples."""
    import random

    g = random.Random(5)
    tables = [
        [(i, g.choice(["a", "b", None, "", "zz", str(g.randrange(10 ** 6))])) for i in range(3000)],
        [(i, None) for i in range(500)],
        [(i % 7, "same") for i in range(400)],
        [(1, "x")],
        [],
    ]
    rules = [{"column": "v", "validation_type": "not_null"},
             {"column": "v", "validation_type": "allowed_values", "values": ["a", "b"]},
             {"column": "v", "validation_type": "regex_match", "pattern": "^[a-z0-9]*$"}]
    tests = [lambda v: v is None or v == "", lambda v: v is not None and v not in ("a", "b"),
             lambda v: v is not None and not v.isalnum() and v != ""]
    for rows in tables:
        df = spark.createDataFrame(rows, "id int, v string").repartition(3)
        for n in (1, 4, 9):
            got = R.violation_samples(df, rules, ["id"], n=n).collect()
            for i, test in enumerate(tests):
                mine = sorted((r["rank"], r["value"] is not None, r["value"] or "", r["id"]) for r in got if r.rule_idx == i)
                assert [m[1:] for m in mine] == _brute_samples(rows, test, n)
                assert [m[0] for m in mine] == list(range(1, len(mine) + 1))


def test_report_and_samples_from_the_same_counts(spark):
    df = spark.range(500).select("id", (F.col("id") % 9).cast("string").alias("v"))
    rules = [{"column": "v", "validation_type": "allowed_values", "values": ["0"]}, {"column": "w", "validation_type": "not_null"}]
    counts = R.rule_counts(df, rules, ["id"], 3)
    key = lambda rows: sorted(tuple(r) for r in rows.collect())
    assert key(R.rule_report(df, rules, counts=counts)) == key(R.rule_report(df, rules))
    assert key(R.violation_samples(df, rules, ["id"], 3, counts=counts)) == key(R.violation_samples(df, rules, ["id"], 3))
    assert R.violation_samples(df, rules[1:], ["id"], 3).collect() == []
