"""The cluster curation flow over the parts table.

A clade is a brand's parts of a hundred consecutive keys; part sizes decide
which assemblies are excluded, and neighbouring parts of a clade are the
scored pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievekit.plans.clusters import CurationResult, curate_clusters
from sievekit.plans.tables import load


def part_clusters(spark, sf) -> CurationResult:
    p = load(spark, sf, "part").withColumn("g", F.concat_ws("-", "p_brand", F.expr("cast(p_partkey div 100 as string)")))
    key = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    named = F.concat(F.lit("RS_"), key)
    ordered = F.transform(F.array_sort(F.collect_list("p_partkey")), lambda k: F.concat(F.lit("RS_P"), k.cast("string")))
    clusters = p.groupBy("g").agg(F.min("p_partkey").alias("k"), F.count(F.lit(1)).alias("No. clustered genomes"),
                                  F.array_join(ordered, ",").alias("Clustered genomes")).select(
        F.concat(F.lit("RS_P"), F.col("k").cast("string")).alias("Representative genome"), F.concat(F.lit("s__"), F.col("g")).alias("GTDB species"),
        F.lit("d;p;c;o;f;g").alias("GTDB taxonomy"), F.lit(99.8).alias("Mean intra-species ANI"), "`No. clustered genomes`", "`Clustered genomes`")
    report = p.select(key.alias("assembly_accession"), F.when(F.col("p_size") == 7, "suppressed").otherwise("latest").alias("version_status"),
                      F.lit(None).cast("string").alias("excluded_from_refseq"), "p_size")
    halves = [report.filter("p_size <= 25").drop("p_size"), report.filter("p_size > 25").drop("p_size")]
    metadata = p.select(named.alias("accession"), (F.col("p_size") * 1000 + F.col("p_partkey") % 7).alias("genome_size"),
                        F.col("p_retailprice").alias("checkm_completeness"), F.col("p_size").alias("contig_count"))
    following = Window.partitionBy("g").orderBy("p_partkey")
    scores = p.select(key.alias("Genome1"), F.concat(F.lit("P"), F.lead("p_partkey").over(following).cast("string")).alias("Genome2"),
                      F.when((F.col("p_size") + F.lead("p_size").over(following)) % 3 == 0, 100.0).otherwise(99.0).alias("ANI")
                      ).filter("Genome2 is not null")
    listed = p.filter("p_partkey % 11 <> 0").select(key.alias("id"))
    files = p.filter("p_partkey % 13 <> 0").select(named.alias("genome"), "p_size")
    return curate_clusters(clusters, halves, metadata, scores, listed, companions={"files": (files, "genome")})


def g_cluster_stages(spark, sf) -> DataFrame:
    r = part_clusters(spark, sf)
    parts = [g.select("clade_name", F.col("n_retained").alias(f"stage{i}"), F.col("kept").alias(f"kept{i}"))
             for i, g in enumerate((r.stage1_groups, r.stage2_groups, r.stage3_groups), start=1)]
    return reduce(lambda a, b: a.join(b, "clade_name"), parts)


def g_cluster_stats(spark, sf) -> DataFrame:
    return part_clusters(spark, sf).stats


def g_cluster_checks(spark, sf) -> DataFrame:
    r = part_clusters(spark, sf)
    rows, complete = r.companions["files"]
    tables = [r.already_removed.select(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")).alias(c)
                                         for c in ("n_pairs", "n_already_removed", "n_removed")]),
              complete.select(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")).alias(c)
                                for c in ("n_expected", "n_found", "n_missing")])]
    return reduce(DataFrame.unionByName, [t.select(F.explode(F.array(*t.columns)).alias("r")).select("r.*") for t in tables])


QUERIES = {f.__name__: f for f in (g_cluster_stages, g_cluster_stats, g_cluster_checks)}

_FLOW = """
WITH p AS (SELECT *, p_brand || '-' || CAST(p_partkey // 100 AS VARCHAR) AS g, p_size * 1000 + p_partkey % 7 AS genome_size FROM part),
c AS (SELECT g, 's__' || g || '--RS_P' || CAST(min(p_partkey) AS VARCHAR) AS clade_name, count(*) AS n FROM p GROUP BY g),
m1 AS (SELECT p.*, clade_name, n < 2 OR p_size = 7 AS gone FROM p JOIN c USING (g)),
k1 AS (SELECT *, NOT gone AND sum(CAST(NOT gone AS INT)) OVER (PARTITION BY g) >= 2 AS in1, sum(CAST(NOT gone AS INT)) OVER (PARTITION BY g) AS r1 FROM m1),
k2 AS (SELECT *, in1 AND p_partkey % 11 <> 0 AS own2, sum(CAST(in1 AND p_partkey % 11 <> 0 AS INT)) OVER (PARTITION BY g) AS r2 FROM k1),
s2 AS (SELECT *, own2 AND r2 >= 2 AS in2 FROM k2),
following AS (SELECT g, p_partkey AS a, lead(p_partkey) OVER (PARTITION BY g ORDER BY p_partkey) AS b,
    (p_size + lead(p_size) OVER (PARTITION BY g ORDER BY p_partkey)) % 3 = 0 AS near FROM p),
pairs AS (SELECT a, b, x.genome_size AS sa, y.genome_size AS sb, CASE WHEN x.genome_size < y.genome_size THEN a ELSE b END AS loser,
        row_number() OVER (ORDER BY least(x.genome_size, y.genome_size), 'P' || CAST(a AS VARCHAR), 'P' || CAST(b AS VARCHAR)) AS nth
    FROM following JOIN s2 x ON x.p_partkey = a AND x.in2 JOIN s2 y ON y.p_partkey = b AND y.in2 WHERE near),
first AS (SELECT loser, min(nth) AS nth FROM pairs GROUP BY loser),
k3 AS (SELECT *, in2 AND p_partkey NOT IN (SELECT loser FROM pairs) AS own3 FROM s2),
s3 AS (SELECT *, sum(CAST(own3 AS INT)) OVER (PARTITION BY g) AS r3 FROM k3)
"""

ORACLE_SQL = {
    "g_cluster_stages": _FLOW + """
SELECT clade_name, CAST(max(r1) AS BIGINT) AS stage1, max(r1) >= 2 AS kept1, CAST(max(r2) AS BIGINT) AS stage2, max(r2) >= 2 AS kept2,
    CAST(max(r3) AS BIGINT) AS stage3, max(r3) >= 2 AS kept3 FROM s3 GROUP BY clade_name""",
    "g_cluster_stats": _FLOW + """
SELECT clade_name, round(avg(p_retailprice), 6) AS checkm_completeness_mean, round(median(p_retailprice), 6) AS checkm_completeness_median,
    min(p_retailprice) AS checkm_completeness_min, max(p_retailprice) AS checkm_completeness_max,
    round(avg(p_size), 6) AS contig_count_mean, round(median(p_size), 6) AS contig_count_median, min(p_size) AS contig_count_min, max(p_size) AS contig_count_max
FROM s3 WHERE own3 AND r3 >= 2 GROUP BY clade_name""",
    "g_cluster_checks": _FLOW + """
SELECT 'n_pairs' AS metric, count(*) AS value FROM pairs
UNION ALL SELECT 'n_already_removed', count(*) FROM pairs WHERE EXISTS (SELECT 1 FROM first f WHERE f.loser IN (pairs.a, pairs.b) AND f.nth < pairs.nth)
UNION ALL SELECT 'n_removed', count(*) FROM first
UNION ALL SELECT 'n_expected', count(*) FROM s3 WHERE in1
UNION ALL SELECT 'n_found', count(*) FROM s3 WHERE in1 AND p_partkey % 13 <> 0
UNION ALL SELECT 'n_missing', count(*) FROM s3 WHERE in1 AND p_partkey % 13 = 0""",
}
