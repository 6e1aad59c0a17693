"""Registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.llm.decontam import leaks
from sievekit.llm.exact_dedup import exact_groups
from sievekit.llm.hard_negatives import hard_negatives
from sievekit.llm.hilbert import hilbert_shards
from sievekit.llm.html_extract import main_text
from sievekit.llm.line_chunks import passage_report
from sievekit.llm.mixing import pfair_mix
from sievekit.llm.ngram_join import shingle_components
from sievekit.llm.prefix_trie import prefix_trie
from sievekit.llm.quality import ACCEPT, fit_quality, quality_scores
from sievekit.llm.toxicity import REJECT, fit, held_out, toxicity_scores
from sievekit.llm.urlfilter import judge_urls
from sievekit.llm.warc import round_trip

SHARDS = 8
SHARD_DIMS = ["source", "lang", "n_chars"]
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
#: target weights of the mixture: the large crawl source is held below its share of the rows
WEIGHTS = {"src0": 24} | {f"src{i}": 4 for i in range(1, 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shard_rows(docs: DataFrame, dims: list[str], n_shards: int, position: Column | None = None) -> DataFrame:
    return hilbert_shards(docs, dims, n_shards, position=position).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "cell")


def op1_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix(table(spark, sf_dir, "documents"), WEIGHTS)


def op2_url_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), SHARD_DIMS, SHARDS)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_components(table(spark, sf_dir, "documents"))


def op6_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_report(table(spark, sf_dir, "documents"))


def op7_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity_scores(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def op9_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out())
    return quality_scores(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_pfair_mixing, op2_url_redirect_filter, op3_warc_round_trip, op4_hilbert_shards, op5_ngram_jaccard_join,
    op6_line_chunk_dedup, op7_spaced_seed_decontamination, op8_segment_toxicity, op9_page_differencing, op10_exact_dedup,
    op11_conversation_prefix_trie, op12_quality_classifier, op13_hard_negatives)}

_HOST = "translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '')"

#: crc32 of a conversation's digits: eight shifts a byte
_CRC = """(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
  lambda crc, ch: list_reduce(list_concat([xor(crc, ch)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, bit: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295))"""

ORACLE_SQL = {
    # links between pages (redirects, canonical) as a recursive walk over the whole table
    "op2_url_redirect_filter": rf"""
WITH RECURSIVE rules(rule, rule_host, rule_path, decision) AS (VALUES
    ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')),
raw AS (
    SELECT url, replace(unnest([
        regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
        regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]), '&amp;', '&') AS target
    FROM pages WHERE url LIKE '%://%'),
aimed AS (
    SELECT url, CASE WHEN target LIKE '%://%' THEN target
        WHEN target LIKE '//%' THEN regexp_extract(url, '^([^:/?#]*)://', 1) || ':' || target
        WHEN target LIKE '/%' THEN regexp_extract(url, '^([^:/?#]*://[^/?#]*)', 1) || target
        ELSE rtrim(regexp_extract(url, '^([^:/?#]*://[^/?#]*(?:/[^?#]*/|/)?)', 1), '/') || '/' || target END AS target
    FROM raw WHERE target <> ''),
ends AS (
    SELECT lower(regexp_extract(url, '://([^/?#]*)', 1)) || regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS a,
           lower(regexp_extract(target, '://([^/?#]*)', 1)) || regexp_extract(target, '://[^/?#]*([^#]*)', 1) AS b FROM aimed),
edges AS (SELECT a, b FROM ends WHERE a <> b UNION SELECT b, a FROM ends WHERE a <> b),
nodes AS (SELECT DISTINCT a AS node FROM edges),
judged AS (
    SELECT node, (SELECT arg_max(decision, length(rule)) FROM rules
                  WHERE (h = rule_host OR ends_with(h, '.' || rule_host)) AND starts_with(p, rule_path)) AS decision
    FROM (SELECT node, regexp_extract(node, '^([^/?#]*)', 1) AS h, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) AS p FROM nodes)),
reach AS (
    SELECT node FROM judged WHERE decision = 'block'
    UNION SELECT edges.b FROM reach JOIN edges ON edges.a = reach.node),
placed AS (
    SELECT page_id, {_HOST} AS host, {_PATH} AS path,
           CASE WHEN url LIKE '%://%' THEN {_HOST} || regexp_extract(url, '://[^/?#]*([^#]*)', 1) END AS node FROM pages),
ruled AS (
    SELECT page_id, host, path, node,
           (SELECT arg_max({{'rule': rule, 'decision': decision}}, length(rule)) FROM rules
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS found
    FROM placed)
SELECT page_id, host, path, found.rule AS rule,
       coalesce(found.decision, CASE WHEN node IN (SELECT node FROM reach) THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN found IS NOT NULL THEN 'rule' WHEN node IN (SELECT node FROM reach) THEN 'alias' ELSE 'default' END AS decided_by
FROM ruled
""",
    "op10_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n
""",
    # every node as the list of its turns; subtree sums from the nodes above each node
    "op11_conversation_prefix_trie": rf"""
WITH own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT conv_id, turns, {_CRC} % 9 AS h, conv_id - conv_id % 5 AS base FROM own),
paths AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS path
    FROM headed c LEFT JOIN headed b ON b.conv_id = c.base),
prefixes AS (SELECT conv_id, len(path) AS length, unnest(range(0, len(path) + 1)) AS depth, path FROM paths),
nodes AS (
    SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE length = depth), '') AS ends
    FROM prefixes GROUP BY 1, 2),
linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth = p.depth + 1 AND p.node = n.node[1:n.depth - 1]),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2),
known AS (
    SELECT linked.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN linked.depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[linked.depth].text) END AS saving
    FROM linked LEFT JOIN children USING (conv_id, depth)),
-- every node with the nodes above it: prefixes of its path
above AS (SELECT *, unnest(range(0, depth + 1)) AS top FROM known),
sums AS (
    SELECT node[1:top] AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saving)::BIGINT AS saved_tokens FROM above GROUP BY 1)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM known JOIN sums USING (node)
""",
    # all scores of the stated queries
    "op13_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_dot_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
}
