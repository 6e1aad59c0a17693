"""Foreign keys: null FK, null and duplicate reference keys, a row failing two FKs."""

from pyspark.sql import functions as F

from sievekit.operators import integrity as J


def _setup(spark):
    target = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "y"), (3, None, "x"), (4, "z", "q"), (5, "a", None)],
        "id int, fk1 string, fk2 string")
    ref1 = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    ref2 = spark.createDataFrame([("x",), ("y",)], "k string")
    return target, J.mapping_resolver({"ref1": ref1, "ref2": ref2})


RULES = [
    {"foreign_key": "fk1", "reference_table": "ref1", "reference_column": "k", "database": "db", "action": "log"},
    {"foreign_key": "fk2", "reference_table": "ref2", "reference_column": "k", "database": "db", "action": "log"},
    {"foreign_key": "fk9", "reference_table": "ref2", "reference_column": "k", "database": "db", "action": "log"},
    {"foreign_key": "fk1", "reference_table": "ref7", "reference_column": "k", "database": "db", "action": "log"},
    {"foreign_key": "fk1", "reference_table": "ref2", "reference_column": "zz", "database": "db", "action": "log"},
]


def test_report_counts_and_errors(spark):
    target, refs = _setup(spark)
    rep = {r.rule_idx: r for r in J.fk_report(target, RULES, refs).collect()}
    assert (rep[0].n_violations, rep[0].n_orphan_keys) == (2, 2)  # null FK and "z"
    assert (rep[1].n_violations, rep[1].n_orphan_keys) == (2, 2)  # "q" and null
    assert [rep[i].status for i in (2, 3, 4)] == ["missing_column", "missing_reference_table", "missing_reference_column"]
    assert J.fk_verdict(J.fk_report(target, RULES, refs)).first().all_passed is False


def test_nulls_ignore(spark):
    target, refs = _setup(spark)
    rep = J.fk_report(target, RULES[:1], refs, nulls="ignore").first()
    assert rep.n_violations == 1


def test_row_failing_two_fks_appears_twice(spark):
    target, refs = _setup(spark)
    v = J.fk_violations(target, RULES, refs).collect()
    assert sorted((r.id, r.failed_fk) for r in v) == [(3, "fk1"), (4, "fk1"), (4, "fk2"), (5, "fk2")]


def test_no_rules_returns_false(spark):
    target, refs = _setup(spark)
    assert J.fk_verdict(J.fk_report(target, [], refs)).first().all_passed is False


def test_samples(spark):
    target, refs = _setup(spark)
    s = J.fk_samples(target, RULES, refs, n=5).orderBy("rule_idx", "rank").collect()
    assert [(r.rule_idx, r.value) for r in s] == [(0, None), (0, "z"), (1, None), (1, "q")]


def test_broadcast_only_when_small(spark):
    from sievekit.functions.sizing import broadcast_if_small, estimated_bytes
    small = spark.range(10)
    assert estimated_bytes(small) is not None
    assert "broadcast" in broadcast_if_small(small, 1 << 20)._jdf.queryExecution().logical().toString().lower()
    big = spark.range(10)
    assert broadcast_if_small(big, 1) is big


def test_fused_and_anti_join_paths_agree(spark):
    target, refs = _setup(spark)
    for nulls in ("fail", "ignore"):
        fused = sorted((r.id, r.failed_fk) for r in J.fk_violations(target, RULES, refs, nulls=nulls).collect())
        anti = sorted((r.id, r.failed_fk) for r in
                      J.fk_violations(target, RULES, refs, nulls=nulls, max_broadcast_bytes=0).collect())
        assert fused == anti
    assert sorted((r.id, r.failed_fk) for r in J.fk_violations(target, RULES, refs, nulls="ignore").collect()) == \
        [(4, "fk1"), (4, "fk2")]


def test_report_paths_agree(spark):
    target, refs = _setup(spark)
    for nulls in ("fail", "ignore"):
        a = sorted(tuple(r) for r in J.fk_report(target, RULES, refs, nulls=nulls).collect())
        b = sorted(tuple(r) for r in J.fk_report(target, RULES, refs, nulls=nulls, max_broadcast_bytes=0).collect())
        assert a == b


def test_many_rules_of_several_key_types_at_once(spark):
    """Text, number and date keys, two rules on one reference, mixed widths, hot keys: all in one aggregate."""
    import datetime as dt

    day = dt.date(2024, 1, 1)
    rows = [(i, i % 5, f"k{i % 7}", float(i % 3), day + dt.timedelta(i % 4), 7 if i % 3 else i) for i in range(600)] + [(600, None, None, None, None, None)]
    target = spark.createDataFrame(rows, "id int, a int, b string, c double, d date, hot long")
    refs = J.mapping_resolver({
        "nums": spark.createDataFrame([(0, 0), (1, 1), (1, 7), (None, 300)], "k long, other int"),
        "texts": spark.createDataFrame([("k0",), ("k3",), ("k3",)], "k string"),
        "days": spark.createDataFrame([(day,)], "k date")})
    rules = [{"foreign_key": fk, "reference_table": t, "reference_column": c} for fk, t, c in (
        ("a", "nums", "k"), ("b", "texts", "k"), ("c", "nums", "k"), ("d", "days", "k"), ("hot", "nums", "other"), ("a", "nums", "other"), ("d", "nums", "k"))]
    known = [{0, 1}, {"k0", "k3"}, {0.0, 1.0}, {day}, {0, 1, 7, 300}, {0, 1, 7, 300}]
    column = [1, 2, 3, 4, 5, 1]
    for nulls in ("fail", "ignore"):
        bad = [[r[c] for r in rows if r[c] not in k and (nulls == "fail" or r[c] is not None)] for c, k in zip(column, known)]
        report = sorted(tuple(r)[0:1] + tuple(r)[4:7] for r in J.fk_report(target, rules, refs, nulls=nulls).collect())
        assert report[:6] == [(i, "fail", len(b), len(set(b))) for i, b in enumerate(bad)]
        assert report[6] == (6, "type_mismatch", None, None)
        samples = J.fk_samples(target, rules, refs, n=2, nulls=nulls).collect()
        for i, b in enumerate(bad):
            want = [(None if v is None else str(v), b.count(v)) for v in sorted(set(b), key=lambda v: (v is not None, v if v is not None else 0))[:2]]
            assert [(r.value, r.n_rows) for r in sorted(samples, key=lambda r: r["rank"]) if r.rule_idx == i] == want


def test_few_orphans_path_agrees_with_the_anti_join(spark):
    target, refs = _setup(spark)
    for nulls in ("fail", "ignore"):
        want = sorted((r.id, r.failed_fk) for r in J.fk_violations(target, RULES, refs, nulls=nulls, max_broadcast_bytes=0).collect())
        few = sorted((r.id, r.failed_fk) for r in J.fk_violations(target, RULES, refs, nulls=nulls, max_broadcast_bytes=1).collect())
        some = sorted((r.id, r.failed_fk) for r in J.fk_violations(target, RULES, refs, nulls=nulls, max_broadcast_bytes=100).collect())
        assert want == few == some


def test_many_orphans_are_not_all_counted_first(spark, monkeypatch):
    """where a slice of the keys shows too many orphans to broadcast, no full count of them is made."""
    counted, stage = [], J.stage_table
    monkeypatch.setattr(J, "stage_table", lambda df, name: counted.append(name) or stage(df, name))
    target = spark.range(60000).select("id", F.when(F.col("id") % 1000 != 5, F.col("id") % 40000).alias("many"), (F.col("id") % 20000).alias("few"))
    refs = J.mapping_resolver({"half": spark.range(20000).select(F.col("id").alias("k")), "most": spark.range(20000).filter("id % 1000 != 7").select(F.col("id").alias("k"))})
    many = {"foreign_key": "many", "reference_table": "half", "reference_column": "k"}
    few = {"foreign_key": "few", "reference_table": "most", "reference_column": "k"}
    for nulls in ("fail", "ignore"):
        wanted = {"many": [i for i in range(60000) if (i % 40000 >= 20000 if i % 1000 != 5 else nulls == "fail")],
                  "few": [i for i in range(60000) if i % 1000 == 7]}
        for rules, counts in (([many], 0), ([few], 1), ([many, few], 1)):
            counted.clear()
            got = {r["foreign_key"]: [] for r in rules}
            for r in J.fk_violations(target, rules, refs, nulls=nulls, max_broadcast_bytes=20000).collect():
                got[r.failed_fk].append(r.id)
            assert {k: sorted(v) for k, v in got.items()} == {k: wanted[k] for k in got}
            assert len(counted) == counts
