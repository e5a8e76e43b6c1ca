"""The order of the mix outlives the files between two stages."""

import tempfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import mixing


@pytest.mark.parametrize("limit", [0, 150])
def test_shards_keep_the_order_of_the_mix(spark, sf_dir, docs, monkeypatch, limit):
    """Several files whose sizes don't follow their order, as the last stage reads them."""
    monkeypatch.setattr(mixing, "POSITION_ROWS", 30)
    uneven = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.repeat("text", 40)).otherwise(F.col("text")))
    want = {r.doc_id: r.mix_position for r in mixing.mix(uneven).select("doc_id", "mix_position").collect()}
    path = tempfile.mkdtemp() + "/mixed"
    corpus_pipeline.mix_sources(spark, uneven, sf_dir).write.option("maxRecordsPerFile", limit and 7).parquet(path)
    assert len(spark.read.parquet(path).inputFiles()) > 5
    rows = corpus_pipeline.cut_shards(spark, spark.read.parquet(path), sf_dir).collect()
    assert {r.doc_id: r.mix_position for r in rows} == want
    places = [(r.shard, r.mix_position) for r in rows]
    assert places == sorted(places) and len(places) == docs.count()


def test_tables_without_files_have_no_order(spark, no_docs, odd_docs):
    assert mixing.stored_position(odd_docs).where("mix_position is null").count() == odd_docs.count()
