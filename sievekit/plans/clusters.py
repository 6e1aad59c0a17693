"""The species-cluster curation flow, composed from the library's operators.

Inputs have the curation notebook's shapes:

* ``clusters``: one row per clade with ``Representative genome``,
  ``GTDB species``, ``GTDB taxonomy``, ``Mean intra-species ANI``,
  ``No. clustered genomes`` and ``Clustered genomes`` (comma-joined ids that
  carry a 3-character source prefix);
* ``reports``: assembly reports with ``assembly_accession``,
  ``version_status`` and ``excluded_from_refseq`` ('; '-joined warnings);
* ``metadata``: per-genome ``accession`` (prefixed), ``genome_size`` and the
  columns to summarise;
* ``pair_scores``: ``Genome1``, ``Genome2``, ``ANI`` (ids without prefix);
* ``keep_ids`` (optional): the external id list of the second stage.

One table is written, under the shared checkpoint folder
(``session.stage_table``): the members with the flags of the first two stages.
Everything else is lazy; stages 1 and 2 are one grouped count
(``groups.fold_stages``). Pairs are never
enumerated: scored pairs are validated by lookups and the unscored ones are
counted per clade (see ``operators.pairs``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievekit.functions import columns as C
from sievekit.functions.sizing import ROW_BYTES, broadcast_limit
from sievekit.functions.skew import is_skewed
from sievekit.operators import flags as K
from sievekit.operators import groups as G
from sievekit.operators import pairs as P
from sievekit.operators.stats import group_stats
from sievekit.session import stage_table

# Thresholds of the curation notebook.
PAIR_SCORE_THRESHOLD = 99.9999
SIZE_SPLIT = 500
PREFIX_LENGTH = 3


@dataclass
class CurationResult:
    """The flow's outputs. The later ones are planned when they are asked for."""

    clades: DataFrame            # clade rows with K1-K3 columns
    members: DataFrame           # one row per (clade, genome) with every filter flag
    count_check: DataFrame       # G2
    filter_summary: DataFrame    # K11
    stage1_groups: DataFrame
    stage2_groups: DataFrame
    removed_near_duplicates: DataFrame   # G13
    stage3_groups: DataFrame
    later: Mapping[str, Callable[[], object]]

    @cached_property
    def pair_coverage(self) -> DataFrame:
        """G9, G11."""
        return self.later["pair_coverage"]()

    @cached_property
    def already_removed(self) -> DataFrame:
        """G14."""
        return self.later["already_removed"]()

    @cached_property
    def size_classes(self) -> DataFrame:
        """G16."""
        return self.later["size_classes"]()

    @cached_property
    def stats(self) -> DataFrame:
        """G15."""
        return self.later["stats"]()

    @cached_property
    def companions(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """By name, the rows kept and their completeness."""
        return self.later["companions"]()


def clade_table(clusters: DataFrame) -> DataFrame:
    """K1-K3: ANI group, taxonomy ranks and the clade name."""
    return clusters.select(
        "*",
        C.bucket_label("Mean intra-species ANI").alias("Group"),
        *C.split_taxonomy("GTDB taxonomy"),
        C.compose_key("GTDB species", "Representative genome").alias("clade_name"),
    )


def flagged_accessions(reports: DataFrame) -> DataFrame:
    """Accessions excluded by status or by any listed warning."""
    return reports.filter(C.excluded_assembly("version_status", "excluded_from_refseq")) \
        .select(F.col("assembly_accession").alias("accession"))


def curate_clusters(
    clusters: DataFrame, reports: DataFrame | Sequence[DataFrame], metadata: DataFrame, pair_scores: DataFrame,
    keep_ids: DataFrame | None = None, *, companions: Mapping[str, tuple[DataFrame, str]] | None = None, min_size: int = G.MIN_GROUP_SIZE,
    threshold: float = PAIR_SCORE_THRESHOLD, size_split: int = SIZE_SPLIT,
    stat_columns: tuple[str, ...] = ("checkm_completeness", "contig_count"),
    stop_on_stage2_drop: bool = False,
) -> CurationResult:
    """``reports`` may be several like tables, which are stacked (K4).
    ``companions`` are further tables and their genome column (ids with
    prefix), cut to the members that stage 1 keeps."""
    if not isinstance(reports, DataFrame):
        reports = K.stack_tables(*reports)
    clades = clade_table(clusters)
    count_check, _ = G.declared_count_check(
        clades, ["clade_name"], "Clustered genomes", F.col("`No. clustered genomes`"), ",")
    members = G.explode_members(
        clades.withColumnRenamed("No. clustered genomes", "n_declared"), "Clustered genomes", ",",
        member="genome_ID", keep=["clade_name", "n_declared"])
    members = members.withColumn("genome_key", C.strip_prefix("genome_ID", PREFIX_LENGTH))

    # Flags: small clades (A1), flagged assemblies (B1), members off the external id list.
    # They are the only table written; what the stages then decide follows from counts per clade.
    members = K.flag_rows(members, FilterA1=F.col("n_declared") < min_size)
    members = K.flag_by_keys(members, "genome_key", flagged_accessions(reports), "accession", "FilterB1")
    if keep_ids is not None:
        members = K.flag_by_keys(members, "genome_key", keep_ids, keep_ids.columns[0], "__listed")
    else:
        members = members.withColumn("__listed", F.lit(1))
    members = members.withColumn("removed", F.greatest("FilterA1", "FilterB1")).withColumn("__unlisted", 1 - F.col("__listed"))
    members = stage_table(members.drop("__listed"), "clusters-flags")
    summary = K.filter_summary(members, "FilterA1", "FilterB1")

    # One count of the written table tells whether a clade is hot and whether the members may be broadcast.
    facts = members.groupBy("clade_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("genome_key") + F.octet_length("clade_name") + ROW_BYTES).alias("bytes")
    ).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
          F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    salt = None if is_skewed(facts["n"], facts["largest"], partitions) else 0
    few = facts["bytes"] <= broadcast_limit(members.sparkSession)

    # Stages 1 and 2: own flags, then the cascades (C)
    s2, (g1, g2) = G.fold_stages(members, ["clade_name"], ["removed", "__unlisted"], min_size, all_groups=clades, salt_buckets=salt)
    s2 = s2.withColumnsRenamed({"cascade1": "FilterC_A1B1", "retained1": "kept1", "cascade2": "FilterC_D1", "retained2": "kept2"}).withColumn(
        "FilterD1", F.when((F.col("kept1") == 1) & (F.col("__unlisted") == 1), 1).otherwise(0)).drop("__unlisted")
    if stop_on_stage2_drop:  # the notebook stops when a clade kept by stage 1 falls below the minimum
        before = g1.select("clade_name", F.col("kept").alias("__kept1"))
        G.require_no_drops(g2.join(before, "clade_name").filter("__kept1"))

    # Pairs: scored pairs inside a stage-2 clade, sizes from metadata
    sizes = metadata.select(C.strip_prefix("accession", PREFIX_LENGTH).alias("genome_key"),
                            F.col("genome_size"))
    retained2 = s2.filter(F.col("kept2") == 1).select("genome_key", "clade_name").join(sizes, "genome_key", "left")
    members_for_pairs = retained2.select(F.col("genome_key").alias("member"), F.col("clade_name").alias("group"),
                                         F.col("genome_size").alias("size"))
    # pairs are ordered by content, whatever the layout of the files; equal rows are told apart by a number
    same = Window.partitionBy("Genome1", "Genome2", "ANI").orderBy(F.lit(0))
    scored = pair_scores.select(
        F.struct("Genome1", "Genome2", "ANI", F.row_number().over(same).alias("nth")).alias("pair_id"),
        F.col("Genome1").alias("genome1"), F.col("Genome2").alias("genome2"), F.col("ANI").alias("score"))
    valid = P.valid_pairs(scored, members_for_pairs, few_members=few)
    surviving = P.above_threshold(valid, "score", threshold)
    removed = P.removed_members(surviving)

    # Stage 3: drop near duplicates (E1), cascade again
    s3_in = K.flag_by_keys(s2, "genome_key", removed, "member", "FilterE1", few=few)
    s3_in = s3_in.withColumn("removed", F.when((F.col("kept2") == 0) | (F.col("FilterE1") == 1), 1).otherwise(0))
    s3, g3 = G.filter_stage(s3_in, ["clade_name"], "removed", min_size, salt_buckets=salt)

    def stats() -> DataFrame:
        final = s3.filter(F.col("retained") == 1).select("clade_name", "genome_ID")
        return group_stats(final.join(metadata.select(F.col("accession").alias("genome_ID"), *stat_columns), "genome_ID"),
                           ["clade_name"], list(stat_columns))

    def companion_rows() -> dict[str, tuple[DataFrame, DataFrame]]:
        kept1 = s2.filter("kept1 = 1").select("genome_ID")
        own = {name: (K.keep_keys(table, column, kept1, "genome_ID"), column) for name, (table, column) in (companions or {}).items()}
        return {name: (rows, K.completeness(rows, column, kept1, "genome_ID")) for name, (rows, column) in own.items()}

    return CurationResult(clades, s3, count_check, summary, g1, g2, removed, g3, {
        "pair_coverage": lambda: P.pair_coverage(
            members_for_pairs.groupBy("group").agg(F.count(F.lit(1)).alias("n_members")), valid),
        "already_removed": lambda: P.already_removed(surviving, few_members=few),
        "size_classes": lambda: P.size_split(g3.filter("kept"), "n_retained", size_split).select("clade_name", "n_retained", "size_class"),
        "stats": stats, "companions": companion_rows})
