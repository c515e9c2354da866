"""The pipeline on given tables and on none; it must not depend on anything but its stages."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from orderlens.llm import ngram_join, queries
from orderlens.scratch import stage

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frames = [docs]
    for name, function in corpus_pipeline.STAGES:
        frames.append(stage(function(spark, frames[-1], FOLDER), name))
    return frames


def test_stages_keep_the_columns_and_clean_documents(spark, steps):
    raw, nontoxic, single, clean, mix, shards = steps
    for frame in (nontoxic, single, clean, mix):
        assert frame.columns == raw.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    harmless = raw.join(labels.filter("toxic = 0"), "doc_id").count()
    kept = nontoxic.join(labels.filter("toxic = 0"), "doc_id").count()
    assert kept >= 0.97 * harmless
    groups = ngram_join.similar_groups(nontoxic, stage).filter("n_shingles > 0")
    assert single.count() >= groups.select("component_id").distinct().count()
    again = ngram_join.similar_groups(single, stage).filter("doc_id <> component_id")
    assert again.count() == 0
    assert clean.exceptAll(single).count() == 0
    words = F.size(F.split(F.trim("text"), "\\s+"))
    ratio = mix.agg(F.sum(words)).first()[0] / clean.agg(F.sum(words)).first()[0]
    assert 1.4 < ratio < 1.6
    assert mix.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    assert shards.count() == mix.count()
    slots = shards.groupBy("shard").agg(
        F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m")
    )
    assert slots.filter("n <> d or m <> n - 1").count() == 0


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, FOLDER)
        assert docs.count() == 0


def test_every_operator_is_registered():
    names = queries.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 11)] == [1] * 10


def test_few_rows_travel_to_python_at_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "keep_one", lambda docs, stage: docs)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, wanted in (("10000", "1000"), ("0", "1000"), ("300", "300")):
            spark.conf.set(key, given)
            corpus_pipeline.one_of_each_group(spark, spark.range(1), "")
            assert spark.conf.get(key) == wanted
    finally:
        spark.conf.set(key, before)
