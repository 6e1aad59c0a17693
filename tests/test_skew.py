"""One key / one group holding a third of all rows: results against pandas brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sievekit.operators import flags as K
from sievekit.operators import groups as G
from sievekit.operators import integrity as J
from sievekit.operators import pairs as P

N = 30000


def _skewed(spark):
    rng = np.random.default_rng(3)
    keys = np.where(np.arange(N) < N // 3, 7, rng.integers(0, 5000, N))  # key 7 holds a third
    pdf = pd.DataFrame({"id": np.arange(N), "fk": keys, "x": rng.normal(size=N)})
    return pdf, spark.createDataFrame(pdf).repartition(8)


def test_fk_with_hot_key(spark):
    pdf, df = _skewed(spark)
    ref = spark.range(0, 4000).select(F.col("id").alias("k"))   # hot key 7 is present, 4000+ are orphans
    refs = J.mapping_resolver({"ref": ref})
    rule = [{"foreign_key": "fk", "reference_table": "ref", "reference_column": "k", "action": "log"}]
    for bound in (None, 1):   # broadcast, and forced shuffle join
        rep = J.fk_report(df, rule, refs, max_broadcast_bytes=bound).first()
        want = pdf[pdf.fk >= 4000]
        assert rep.n_violations == len(want) and rep.n_orphan_keys == want.fk.nunique()


def test_group_stage_with_hot_group(spark):
    pdf, df = _skewed(spark)
    flagged_ids = spark.range(0, N, 3).select(F.col("id").alias("fid"))     # every third member removed
    members = K.flag_by_keys(df, "id", flagged_ids, "fid", "removed")
    _, groups = G.filter_stage(members, ["fk"], "removed", 2)
    got = {r.fk: (r.n_members, r.n_retained, r.kept) for r in groups.collect()}
    pdf["removed"] = (pdf.id % 3 == 0).astype(int)
    want = pdf.groupby("fk").agg(n=("id", "size"), r=("removed", lambda s: int((s == 0).sum())))
    assert got[7] == (int(want.loc[7, "n"]), int(want.loc[7, "r"]), True)
    assert all(got[k] == (int(v.n), int(v.r), int(v.r) >= 2) for k, v in want.iterrows())


def test_pairs_with_hot_member(spark):
    rng = np.random.default_rng(5)
    m = 2000
    members = pd.DataFrame({"member": np.arange(m), "group": np.arange(m) % 4, "size": rng.integers(0, 50, m)})
    a = np.where(np.arange(N) < N // 3, 0, rng.integers(0, m, N))             # member 0 in a third of pairs
    b = rng.integers(0, m, N)
    pairs = pd.DataFrame({"pair_id": np.arange(N), "genome1": a, "genome2": b, "score": rng.uniform(99, 100, N)})
    sp = P.valid_pairs(spark.createDataFrame(pairs), spark.createDataFrame(members))
    surv = P.above_threshold(sp, "score", 99.5)
    got = {r.member for r in P.removed_members(surv).collect()}
    s = dict(zip(members.member, members["size"]))
    g = dict(zip(members.member, members.group))
    want = set()
    for r in pairs.itertuples():
        if g[r.genome1] == g[r.genome2] and r.genome1 != r.genome2 and r.score >= 99.5:
            want.add(r.genome1 if s[r.genome1] < s[r.genome2] else r.genome2)
    assert got == want


def test_salted_flag_join_matches_plain(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"v{i % 500}") for i in range(30000)]
    df = spark.createDataFrame(rows, "id long, line string")
    keys = spark.createDataFrame([("hot",)] + [(f"v{i}",) for i in range(0, 500, 2)], "k string")
    plain = K.flag_by_keys(df, "line", keys, "k", "hit", max_broadcast_bytes=0, salt_buckets=0)
    salted = K.flag_by_keys(df, "line", keys, "k", "hit", max_broadcast_bytes=0, salt_buckets=8)
    a = sorted((r.id, r.hit) for r in plain.collect())
    b = sorted((r.id, r.hit) for r in salted.collect())
    assert a == b and len(b) == 30000
    assert sum(h for _, h in b) == 10000 + sum(1 for i in range(30000) if i % 3 and (i % 500) % 2 == 0)
    assert salted.columns == df.columns + ["hit"]


def test_salted_stage_matches_plain(spark):
    pdf, df = _skewed(spark)
    flagged_ids = spark.range(0, N, 3).select(F.col("id").alias("fid"))
    members = K.flag_by_keys(df, "id", flagged_ids, "fid", "removed")
    plain_m, plain_g = G.filter_stage(members, ["fk"], "removed", 2, salt_buckets=0)
    salt_m, salt_g = G.filter_stage(members, ["fk"], "removed", 2, salt_buckets=8)
    key = lambda r: (r.id, r.fk, r.removed, r.cascade, r.retained)
    assert sorted(map(key, plain_m.collect())) == sorted(map(key, salt_m.collect()))
    assert sorted(map(tuple, plain_g.collect())) == sorted(map(tuple, salt_g.collect()))
    assert salt_m.columns == plain_m.columns


def test_salted_already_removed_matches_plain(spark):
    rng = np.random.default_rng(11)
    m = 300
    members = spark.createDataFrame(pd.DataFrame({"member": np.arange(m), "group": np.zeros(m, dtype=int),
                                                  "size": rng.integers(0, 1000, m)}))
    a = np.where(np.arange(6000) < 2000, 0, rng.integers(1, m, 6000))   # member 0 in a third of pairs
    b = rng.integers(1, m, 6000)
    pairs = spark.createDataFrame(pd.DataFrame({"pair_id": np.arange(6000), "genome1": a, "genome2": b,
                                                "score": np.full(6000, 100.0)}))
    surv = P.valid_pairs(pairs, members)
    plain = P.already_removed(surv, salt_buckets=0).first()
    salted = P.already_removed(surv, salt_buckets=8).first()
    assert tuple(plain) == tuple(salted)


# ---------------------------------------------------------------- hot and null keys by default

def _partitions_of(df, key, hot):
    """Over how many partitions the rows of the hot key are spread."""
    return df.filter(F.col(key).eqNullSafe(F.lit(hot))).select(F.spark_partition_id().alias("p")).distinct().count()


def _hot_frame(spark, n=30000):
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                 .otherwise(F.concat(F.lit("v"), (F.col("id") % 5000).cast("string"))).alias("k"),
                                 (F.col("id") % 997).alias("x"), (F.col("id") % 2).cast("int").alias("removed"))


def _without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_hot_keys_spread_by_default(spark):
    df = _hot_frame(spark)
    keys = df.select("k").distinct()
    table = keys.filter("k is not null").withColumn("a", F.length("k"))
    try:
        _without_broadcast(spark)
        flagged = K.flag_by_keys(df, "k", keys, "k", "hit")
        staged, _ = G.filter_stage(df, ["k"])
        looked = K.lookup_both_sides(df.select("k", "id"), "k", "k", table, "k", ["a"])
        for out in (flagged, staged, looked):
            assert _partitions_of(out, "k", "hot") >= 6  # of 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_group_plans_agree_on_null_groups(spark):
    rows = [("a", 1, 0), ("a", 2, 0), (None, 3, 0), ("b", 4, 0), ("b", 5, 1), (None, 6, 1), ("c", 7, 1)]
    df = spark.createDataFrame(rows, "g string, m int, removed int")
    want = {("a", 1, 0, 1), ("a", 2, 0, 1), (None, 3, 1, 0), ("b", 4, 1, 0), ("b", 5, 0, 0), (None, 6, 0, 0), ("c", 7, 0, 0)}
    for options in ({}, {"salt_buckets": 0}, {"groups_from_rows": True}):
        members, groups = G.filter_stage(df, ["g"], **options)
        assert {(r.g, r.m, r.cascade, r.retained) for r in members.collect()} == want
        assert {(r.g, r.n_members, r.kept) for r in groups.collect()} == {("a", 2, True), (None, 2, False), ("b", 2, False), ("c", 1, False)}
    _, groups = G.filter_stage(df, ["g"], all_groups=spark.createDataFrame([("a",), (None,), ("z",)], "g string"))
    assert {(r.g, r.n_members) for r in groups.collect()} == {("a", 2), (None, 2), ("z", 0)}


def test_group_stats_keep_empty_groups_types_and_hot_groups(spark):
    from sievekit.operators.stats import group_stats

    big = 9007199254740993
    df = spark.createDataFrame([("a", big, 1.0), ("a", big + 2, 3.0), ("b", None, None), (None, 5, 2.0), (None, 7, None)], "g string, n long, x double")
    got = {r["g"]: r for r in group_stats(df, ["g"], ["n", "x"]).collect()}
    assert (got["a"]["n_min"], got["a"]["n_max"]) == (big, big + 2) and got["a"]["x_median"] == 2.0
    assert set(got) == {"a", "b", None} and all(v is None for k, v in got["b"].asDict().items() if k != "g")
    assert got[None]["n_median"] == 6.0 and got[None]["x_mean"] == 2.0
    hot = _hot_frame(spark)
    pdf = hot.toPandas()
    stats = {r["k"]: r for r in group_stats(hot, ["k"], ["x"]).collect()}
    for k, own in pdf.groupby("k", dropna=False)["x"]:
        r = stats[None if pd.isna(k) else k]
        assert r["x_median"] == own.median() and r["x_min"] == own.min() and abs(r["x_mean"] - own.mean()) < 1e-6


def test_pieces_follow_the_size_of_the_key(spark):
    """A third of the rows on one key: about as many partitions hold it at either size, and only its row of the table is copied."""
    from sievekit.functions.skew import salted_lookup

    try:
        _without_broadcast(spark)
        for n in (6_000, 60_000):
            df = _hot_frame(spark, n)
            table = df.select("k").distinct().withColumn("a", F.coalesce(F.length("k"), F.lit(-1)))
            out = salted_lookup(df, table, ["k"])
            assert _partitions_of(out, "k", "hot") >= 6 and out.count() == n and out.filter("a is null").count() == 0
        plan = salted_lookup(df, table, ["k"], task_rows=50)
        assert plan.count() == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_number_of_pieces(spark):
    from sievekit.functions.skew import is_skewed, pieces

    def cut(rows, total, partitions, task_rows=10 ** 6):
        return spark.range(1).select(pieces(F.lit(rows), F.lit(total), partitions, task_rows)).first()[0]

    assert cut(10_000, 30_000, 8) == 22 and cut(100_000, 300_000, 8) == 22  # eight to a fair share
    assert cut(10 ** 12 // 3, 10 ** 12, 20_000) == 333_334  # a task never gets more than task_rows of a key
    assert cut(1, 1, 8) == 1 and cut(0, 0, 8) == 1
    assert is_skewed(10 ** 9, 10 ** 9 // 3, 200) and not is_skewed(3000, 1000, 200) and not is_skewed(10 ** 9, 10 ** 6, 200)


def test_folded_stages_equal_stages_one_by_one(spark):
    rng = np.random.default_rng(2)
    n = 4000
    pdf = pd.DataFrame({"id": np.arange(n), "g": rng.integers(0, 700, n), "a": (rng.random(n) < 0.5).astype(int),
                        "b": (rng.random(n) < 0.4).astype(int), "c": (rng.random(n) < 0.3).astype(int)})
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    every = spark.range(720).select(F.when(F.col("id") > 0, F.col("id")).alias("g"))  # the null group too
    out, groups = G.fold_stages(df, ["g"], ["a", "b", "c"], 2, all_groups=every)
    now, removed, want = df, F.col("a"), []
    for i, own in enumerate(("a", "b", "c"), start=1):
        flag = F.col(own) if i == 1 else F.when((F.col(f"retained{i - 1}") == 0) | (F.col(own) == 1), 1).otherwise(0)
        now, g = G.filter_stage(now.withColumn("removed", flag), ["g"], "removed", 2, all_groups=every if i == 1 else None)
        now = now.withColumnsRenamed({"cascade": f"cascade{i}", "retained": f"retained{i}"}).drop("removed")
        want.append(g)
    columns = ["id", *[f"{c}{i}" for i in (1, 2, 3) for c in ("cascade", "retained")]]
    assert sorted(map(tuple, out.select(columns).collect())) == sorted(map(tuple, now.select(columns).collect()))
    for got, expect in zip(groups, want):
        same = lambda t: sorted(map(tuple, t.select("g", "n_members", "n_removed", "n_retained", "kept").collect()), key=str)
        assert same(got) == same(expect)


def test_medians_of_small_and_large_groups(spark):
    """Exact on both paths: groups below and above the accuracy of the sketch, even and odd, ties, nulls."""
    from sievekit.operators.stats import exact_median, group_stats

    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.choice(["s", "m", "l", "xl"], 4000, p=[0.005, 0.045, 0.35, 0.6]), "x": rng.integers(0, 300, 4000) / 7.0, "y": rng.normal(size=4000)})
    pdf.loc[rng.random(4000) < 0.1, "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    want = pdf.groupby("g")[["x", "y"]].median()
    for accuracy in (150, 1000, 100_000):  # all groups but the smallest, some, and none above
        got = {r["g"]: r for r in group_stats(df, ["g"], ["x", "y"], digits=9, accuracy=accuracy).collect()}
        assert all(abs(got[g][f"{c}_median"] - want.loc[g, c]) < 1e-8 for g in want.index for c in ("x", "y"))
        one = {r["g"]: r["x_median"] for r in exact_median(df, ["g"], "x", accuracy=accuracy).collect()}
        assert all(abs(one[g] - want.loc[g, "x"]) < 1e-8 for g in want.index)
    bounded = group_stats(df, ["g"], ["x"], max_rows=4000)
    assert {r["g"]: round(r["x_median"], 5) for r in bounded.collect()} == {g: round(want.loc[g, "x"], 5) for g in want.index}
