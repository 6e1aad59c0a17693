"""Groups and pairs: null list, one member, repeated member, exact minimum,
pair order independence, ties and missing sizes, chains."""

from pyspark.sql import functions as F

from sievekit.functions import columns as C
from sievekit.operators import flags as K
from sievekit.operators import groups as G
from sievekit.operators import pairs as P


def _clades(spark):
    return spark.createDataFrame([
        ("c1", "GB_a,GB_b,GB_c", 3),
        ("c2", "GB_d", 1),
        ("c3", "GB_e,GB_e,GB_f", 3),
        ("c4", None, 0),
        ("c5", "GB_g,GB_h", 2),
    ], "clade string, genomes string, declared int")


def test_explode_and_count_check(spark):
    df = _clades(spark)
    members = G.explode_members(df, "genomes", ",", keep=["clade"])
    assert members.count() == 9  # the null list yields no member
    summary, mismatches = G.declared_count_check(df, ["clade"], "genomes", F.col("declared"), ",")
    s = summary.first()
    assert (s.n_exploded, s.n_declared, s.n_mismatched_groups) == (9, 9, 1)
    assert {r.clade for r in mismatches.collect()} == {"c4"}


def test_stage_cascade_and_minimum(spark):
    df = _clades(spark)
    members = G.explode_members(df, "genomes", ",", keep=["clade"])
    flagged_ids = spark.createDataFrame([("GB_a",), ("GB_e",), ("GB_h",)], "id string")
    members = K.flag_by_keys(members, "member", flagged_ids, "id", "removed")
    tagged, groups = G.filter_stage(members, ["clade"], "removed", 2, all_groups=df)
    g = {r.clade: r for r in groups.collect()}
    assert (g["c4"].n_retained, g["c4"].kept) == (0, False)       # null list -> size 0
    assert (g["c1"].n_retained, g["c1"].kept) == (2, True)        # exactly at minimum
    assert (g["c2"].n_retained, g["c2"].kept) == (1, False)       # one member
    assert (g["c3"].n_removed, g["c3"].n_retained) == (2, 1)      # repeated member removed twice
    assert (g["c5"].n_retained, g["c5"].kept) == (1, False)
    cascade = {r.member for r in tagged.filter("cascade = 1").collect()}
    assert cascade == {"GB_d", "GB_f", "GB_g"}
    # retained + removed + cascade = members
    t = tagged.agg(F.sum("retained"), F.sum("removed"), F.sum("cascade"), F.count("*")).first()
    assert t[0] + t[1] + t[2] == t[3]
    ch = G.changed_groups(groups).first()
    assert (ch.n_changed, ch.n_dropped) == (3, 4)
    lists = {r.clade: r for r in G.regroup(tagged, ["clade"], "position", "member", "retained", sep=",").collect()}
    assert lists["c1"].retained_members == "GB_b,GB_c" and lists["c1"].removed_members == "GB_a"


def _members(spark):
    return spark.createDataFrame([
        ("a", "g1", 10.0), ("b", "g1", 20.0), ("c", "g1", 20.0), ("d", "g1", None), ("e", "g2", 5.0),
    ], "member string, group string, size double")


def _pairs(spark):
    return spark.createDataFrame([
        (1, "a", "b", 99.99), (2, "b", "a", 99.99),   # same pair both orders
        (3, "b", "c", 99.5),                           # equal sizes -> second removed
        (4, "c", "d", 99.95),                          # missing size -> second removed
        (5, "a", "e", 100.0),                          # across groups -> not valid
        (6, "a", "a", 100.0),                          # self pair -> not valid
        (7, "b", "c", 90.0),                           # below threshold
    ], "pair_id long, genome1 string, genome2 string, score double")


def test_valid_pairs_and_removal(spark):
    valid = P.valid_pairs(_pairs(spark), _members(spark))
    assert sorted(r.pair_id for r in valid.collect()) == [1, 2, 3, 4, 7]
    keys = {r.pair_id: r.pair_key for r in valid.collect()}
    assert keys[1] == keys[2] == "a_b"
    surv = P.above_threshold(valid, "score", 99.5)
    removed = {r.member for r in P.removed_members(surv).collect()}
    assert removed == {"a", "c", "d"}


def test_removal_is_order_independent(spark):
    valid = P.valid_pairs(_pairs(spark), _members(spark))
    surv = P.above_threshold(valid, "score", 99.5)
    a = {r.member for r in P.removed_members(surv).collect()}
    b = {r.member for r in P.removed_members(surv.orderBy(F.desc("pair_id")).repartition(3)).collect()}
    assert a == b


def test_already_removed_chain(spark):
    members = spark.createDataFrame([("a", "g", 1.0), ("b", "g", 2.0), ("c", "g", 3.0)],
                                    "member string, group string, size double")
    pairs = spark.createDataFrame([(1, "a", "b", 100.0), (2, "b", "c", 100.0), (3, "a", "c", 100.0)],
                                  "pair_id long, genome1 string, genome2 string, score double")
    surv = P.valid_pairs(pairs, members)
    r = P.already_removed(surv).first()
    # sorted by min_size: (a,b)=1 removes a; (a,c)=1 sees a removed; (b,c)=2 removes b
    assert (r.n_pairs, r.n_already_removed, r.n_removed) == (3, 1, 2)


def test_pair_coverage_counts(spark):
    members = _members(spark)
    sizes = members.groupBy("group").agg(F.count("*").alias("n_members"))
    cov = {r.group: r for r in P.pair_coverage(sizes, P.valid_pairs(_pairs(spark), members)).collect()}
    assert (cov["g1"].expected_pairs, cov["g1"].scored_pairs, cov["g1"].missing_pairs) == (6, 3, 3)
    assert cov["g2"].expected_pairs == 0


def test_column_helpers(spark):
    df = spark.createDataFrame([(100.0, "d;p;c;o;f;g", None), (99.95, "d;p", "x; y"), (97.0, None, "y")],
                               "ani double, tax string, warn string")
    out = df.select(C.bucket_label("ani").alias("b"), *C.split_to_columns("tax", ";", ["d", "p", "c", "o", "f", "g"]),
                    C.split_list("warn").alias("w")).collect()
    assert [r.b for r in out] == ["Group1: 100", "Group7: LT 97.0", "Group7: LT 97.0"]
    assert out[1].c is None and out[0].g == "g"
    assert out[0].w == [None] and out[1].w == ["x", "y"]
    flag = df.select(C.flag(C.list_overlap(None, [], C.split_list("warn"), ["y"])).alias("f")).collect()
    assert [r.f for r in flag] == [0, 1, 1]
    assert df.select(C.pairs_in_group(F.lit(14641)).alias("n")).first().n == 14641 * 14640 // 2


def test_stage1_defaults(spark):
    df = spark.createDataFrame([
        ("GCA_1", "latest", None),
        ("GCA_2", "suppressed", None),
        ("GCA_3", "latest", "partial; chimeric"),
        ("GCA_4", "latest", "chimeric"),
    ], "acc string, version_status string, excluded_from_refseq string")
    flags = [r.f for r in df.select(C.flag(C.excluded_assembly("version_status", "excluded_from_refseq")).alias("f"))
             .orderBy("acc").collect()]
    assert flags == [0, 1, 1, 0]
    tax = spark.createDataFrame([("d__B;p__P;c__C;o__O;f__F;g__G",)], "t string")
    row = tax.select(*C.split_taxonomy("t")).first()
    assert (row.domain, row.genus) == ("d__B", "g__G")


def test_require_no_drops(spark):
    import pytest
    ok = spark.createDataFrame([("a", True), ("b", True)], "g string, kept boolean")
    assert G.require_no_drops(ok) == 2
    bad = spark.createDataFrame([("a", True), ("b", False)], "g string, kept boolean")
    with pytest.raises(G.GroupBelowMinimum):
        G.require_no_drops(bad)
