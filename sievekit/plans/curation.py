"""Curation flows over the test tables.

* Groups and members: a document is a group, its lines are members (whole
  texts, split on newlines). Filter A: documents with fewer than two lines.
  Filter B: lines that occur in three or more documents (a key set computed
  from the table itself, like the reference's flagged-accession list).
* Pairs: consecutive orders give a scored pair of their customers
  (score = 100 * smaller total / larger total); customers are members,
  grouped by nation, sized by account balance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.operators import flags as K
from sievekit.operators import groups as G
from sievekit.operators import pairs as P
from sievekit.functions.columns import text_key
from sievekit.plans.tables import load
from sievekit.session import stage_table

REPEATED_LINE_DOCS = 3
PAIR_THRESHOLD = 97.0
SIZE_SPLIT = 60


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").withColumn("n_lines", F.size(F.split("text", "\n")))
    return G.explode_members(docs, "text", "\n", member="line", position="line_no", keep=["doc_id", "n_lines"])


def repeated_lines(lines: DataFrame, min_docs: int = REPEATED_LINE_DOCS) -> DataFrame:
    """Keys of lines found in ``min_docs`` or more documents.

    Lines are grouped by their 128-bit ``text_key``, not their text, so the
    shuffle moves 16 bytes per line; the distinct count is planned as
    (key, doc) then (key), so a line repeated in a third of all documents is
    spread over partitions before it is counted.
    """
    return (lines.groupBy(text_key("line").alias("line_key")).agg(F.count_distinct("doc_id").alias("n_docs"))
            .filter(F.col("n_docs") >= min_docs))


def flagged_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = doc_lines(spark, sf)
    flagged = K.flag_rows(lines, filter_a=F.col("n_lines") < G.MIN_GROUP_SIZE)
    flagged = K.flag_by_keys(flagged, "line", repeated_lines(lines), "line_key", "filter_b",
                             key_expr=text_key("line"))
    return flagged.withColumn("removed", F.greatest("filter_a", "filter_b"))


def doc_stage(spark: SparkSession, sf: str):
    # A document's lines come from one row, so the group is bounded by that
    # row: the window plan sizes groups in the same pass (one shuffle by
    # doc_id) instead of aggregating and joining back.
    return G.filter_stage(flagged_lines(spark, sf), ["doc_id"], "removed", G.MIN_GROUP_SIZE,
                          groups_from_rows=True)


def retained_text(spark: SparkSession, sf: str) -> DataFrame:
    """Per document the text of its retained and of its removed lines.

    Lines travel as 128-bit keys; a document's decisions come back as one array
    of flags in line order, and the text is filtered in place, so it moves at
    most once, by document."""
    docs = load(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines")).filter("lines is not null")
    # the outer form: for the other, the optimizer adds a filter that hashes all lines again
    keys = docs.select("doc_id", F.size("lines").alias("n_lines"), F.posexplode_outer(
        F.transform("lines", text_key)).alias("line_no", "line_key"))
    repeated = keys.groupBy("line_key").agg(F.count_distinct("doc_id").alias("n_docs")).filter(
        F.col("n_docs") >= REPEATED_LINE_DOCS)
    flagged = K.flag_by_keys(keys, "line_key", repeated, "line_key", "filter_b")
    gone = (F.col("filter_b") == 1) | (F.col("n_lines") < G.MIN_GROUP_SIZE)
    flags = flagged.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", gone.alias("gone")))).alias("flags"))
    pairs = docs.join(flags, "doc_id").withColumn(
        "pairs", F.zip_with("lines", "flags", lambda line, f: F.struct(line.alias("line"), f["gone"].alias("gone"))))
    few = F.size(F.filter("pairs", lambda p: ~p["gone"])) < G.MIN_GROUP_SIZE  # the cascade
    text = lambda keep: F.array_join(F.transform(F.filter("pairs", keep), lambda p: p["line"]), "\n")
    out = pairs.withColumn("few", few)
    return out.select(
        "doc_id", text(lambda p: ~p["gone"] & ~F.col("few")).alias("retained_members"),
        text(lambda p: p["gone"] | F.col("few")).alias("removed_members"),
        F.size(F.filter("pairs", lambda p: ~p["gone"] & ~F.col("few"))).cast("long").alias("n_retained"))


def order_pairs(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    nxt = o.select((F.col("o_orderkey") - 1).alias("__prev"), F.col("o_custkey").alias("genome2"),
                   F.col("o_totalprice").alias("__t2"))
    j = o.join(nxt, o["o_orderkey"] == nxt["__prev"], "inner")
    score = F.lit(100.0) * F.least("o_totalprice", "__t2") / F.greatest("o_totalprice", "__t2")
    return j.select(F.col("o_orderkey").alias("pair_id"), F.col("o_custkey").alias("genome1"),
                    "genome2", score.alias("score"))


def customer_members(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select(
        F.col("c_custkey").alias("member"), F.col("c_nationkey").alias("group"),
        F.col("c_acctbal").alias("size"))


def valid_order_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return P.valid_pairs(order_pairs(spark, sf), customer_members(spark, sf))


def surviving_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return P.above_threshold(valid_order_pairs(spark, sf), "score", PAIR_THRESHOLD)


def customer_stage3(spark: SparkSession, sf: str, staged: bool = True):
    """(members, groups) of the third stage. ``staged``: write the flagged
    members once, for a caller that uses both; without, nothing runs yet."""
    members = customer_members(spark, sf)
    removed = P.removed_members(surviving_pairs(spark, sf))
    flagged = K.flag_by_keys(members, "member", removed, "member", "removed")
    if staged:
        flagged = stage_table(flagged, "customers-flagged-stage3")
    return G.filter_stage(flagged, ["group"], "removed", G.MIN_GROUP_SIZE)
