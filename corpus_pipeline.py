"""The corpus pipeline: documents through five operators, one after another.

Every stage takes what its predecessor kept, reread from Parquet, and its
decisions take effect: toxic documents go, one document of each group of
near-duplicates stays, contaminated documents go, the rest is put into the
order of the target mixture, and the last stage deals it into shards, along the
curve and in the order of the mixture within a cell.
``run`` writes the stages under the shared checkpoint folder.

Defined results: those of the operators; an empty table passes through all
stages, columns beyond those of ``documents`` are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievekit.llm.common import stage
from sievekit.llm.decontam import decontaminated
from sievekit.llm.mixing import mixed_documents, stream_position
from sievekit.llm.ngram_join import one_of_each
from sievekit.llm.queries import SHARD_DIMS, SHARDS, WEIGHTS, shard_rows, table
from sievekit.llm.toxicity import clean_documents, fit, held_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, fit(docs, table(spark, sf_dir, "labels"), ~held_out()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, WEIGHTS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the mixture is the order of the rows in the files before: it orders the rows of every cell
    return shard_rows(docs, SHARD_DIMS, SHARDS, stream_position(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pfair_mixing", mix),
    ("hilbert_sharding", shard),
]

#: a fitted model and a curve over fitted quantiles are beyond SQL; tests/llm holds the result against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
