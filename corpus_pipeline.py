"""From raw documents to shards: toxicity, near copies, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Every result
is written as Parquet to the shared folder and read again, so a lost executor costs at most
one stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontam, mixing, ngram_join, queries, sharding, toxicity
from orderlens.llm.common import short_batches, word_count
from orderlens.scratch import stage
from orderlens.sources.tables import read_table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    labels = read_table(spark, sf_dir, "labels")
    chain = toxicity.fit_chain(docs, labels, queries.toxicity_categories(), stage)
    return toxicity.remove_reported(docs, chain, queries.REJECT_ON)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return ngram_join.keep_one(docs, stage)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return decontam.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix; a document that the mix takes twice is there twice."""
    return mixing.mixed_documents(docs, word_count(F.col("text")))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, queries.SHARDS)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# The first stage is a fitted model, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
