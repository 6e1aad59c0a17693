"""The species-cluster curation flow on a hand-made fixture in the notebook's shapes."""

import pytest

from sievekit.operators.groups import GroupBelowMinimum
from sievekit.plans.clusters import curate_clusters

CLUSTERS = [
    ("RS_GCF_1", "s__A one", "d__B;p__P;c__C;o__O;f__F;g__G", 99.8, 4, "RS_GCF_1,GB_GCA_2,GB_GCA_3,GB_GCA_4"),
    ("GB_GCA_5", "s__B", "d__B;p__P;c__C;o__O;f__F;g__H", 100.0, 1, "GB_GCA_5"),
    ("GB_GCA_6", "s__C", "d__B;p__P;c__C;o__O;f__F;g__I", 97.5, 3, "GB_GCA_6,GB_GCA_7,GB_GCA_8"),
]
CLUSTER_SCHEMA = ("`Representative genome` string, `GTDB species` string, `GTDB taxonomy` string, "
                  "`Mean intra-species ANI` double, `No. clustered genomes` long, `Clustered genomes` string")


def _inputs(spark):
    clusters = spark.createDataFrame(CLUSTERS, CLUSTER_SCHEMA)
    reports = spark.createDataFrame([("GCA_3", "suppressed", None), ("GCA_7", "latest", "partial; chimeric"),
                                     ("GCA_8", "latest", None)],
                                    "assembly_accession string, version_status string, excluded_from_refseq string")
    metadata = spark.createDataFrame([
        ("RS_GCF_1", 5000, 99.0, 10), ("GB_GCA_2", 4000, 98.0, 20), ("GB_GCA_3", 4100, 97.0, 30),
        ("GB_GCA_4", 4500, 96.0, 40), ("GB_GCA_6", 3000, 95.0, 5), ("GB_GCA_8", 3100, 94.0, 6),
    ], "accession string, genome_size long, checkm_completeness double, contig_count long")
    scores = spark.createDataFrame([("GCF_1", "GCA_2", 100.0), ("GCA_2", "GCA_4", 99.99999),
                                    ("GCF_1", "GCA_4", 99.0), ("GCA_6", "GCA_8", 100.0)],
                                   "Genome1 string, Genome2 string, ANI double")
    keep = spark.createDataFrame([("GCF_1",), ("GCA_2",), ("GCA_4",), ("GCA_6",)], "id string")
    return clusters, reports, metadata, scores, keep


def test_curation_flow(spark):
    r = curate_clusters(*_inputs(spark))
    clade = {x["clade_name"]: x for x in r.clades.collect()}
    assert set(clade) == {"s__A_one--RS_GCF_1", "s__B--GB_GCA_5", "s__C--GB_GCA_6"}
    assert clade["s__B--GB_GCA_5"]["Group"] == "Group1: 100" and clade["s__C--GB_GCA_6"]["genus"] == "g__I"
    assert r.count_check.first().matches
    s = r.filter_summary.first()
    assert (s.n_FilterA1, s.n_FilterB1_only) == (1, 2)
    g1 = {x.clade_name: (x.n_retained, x.kept) for x in r.stage1_groups.collect()}
    assert g1 == {"s__A_one--RS_GCF_1": (3, True), "s__B--GB_GCA_5": (0, False), "s__C--GB_GCA_6": (2, True)}
    g2 = {x.clade_name: (x.n_retained, x.kept) for x in r.stage2_groups.collect()}
    assert g2["s__C--GB_GCA_6"] == (1, False) and g2["s__A_one--RS_GCF_1"] == (3, True)
    assert {x.member for x in r.removed_near_duplicates.collect()} == {"GCA_2"}
    d = r.already_removed.first()
    assert (d.n_pairs, d.n_already_removed, d.n_removed) == (2, 1, 1)
    cov = {x.group: (x.expected_pairs, x.scored_pairs, x.missing_pairs) for x in r.pair_coverage.collect()}
    assert cov == {"s__A_one--RS_GCF_1": (3, 3, 0)}
    g3 = {x.clade_name: (x.n_retained, x.kept) for x in r.stage3_groups.collect()}
    assert g3["s__A_one--RS_GCF_1"] == (2, True)
    final = sorted(x.genome_ID for x in r.members.filter("retained = 1").collect())
    assert final == ["GB_GCA_4", "RS_GCF_1"]
    assert [(x.clade_name, x.size_class) for x in r.size_classes.collect()] == [("s__A_one--RS_GCF_1", "LT")]
    st = r.stats.first()
    assert (st.checkm_completeness_median, st.contig_count_max) == (97.5, 40)


def test_stage2_abort(spark):
    with pytest.raises(GroupBelowMinimum):
        curate_clusters(*_inputs(spark), stop_on_stage2_drop=True)
