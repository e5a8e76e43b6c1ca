"""From raw documents to training shards: five stages, each of one operator of ``tidelog.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next stage's docs.  A stage works on all rows its predecessor kept, and all
but the last return the columns of docs.  Spark reads a folder's files in an order of its own, so the
last stage takes the place in the mix from the files' names and rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontaminate, language_id, mixing, near_copies, sharding, simhash
from tidelog.llm.common import bound_batches, columns, scratch, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go: those of a foreign language or without a letter, null and empty ones among them.

    Repeated rows share their fate; columns stay as they are; an empty table stays empty.
    """
    bound_batches(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the document of least doc_id stays.

    Texts without a word are one group; of rows repeated in key and text one stays; rows with a null doc_id all stay.
    """
    bound_batches(spark)
    return simhash.keep_one(docs, groups=near_copies.near_copies)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go.  Null and empty texts hold none; an empty benchmark takes nothing away."""
    bound_batches(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of the mix: file by file, and row by row.  Null sources are one source, ties go by key, size and hash."""
    mixed = mixing.in_order(mixing.mix(docs), docs.count())
    return mixed.select(*columns(docs))


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and mix_position, sorted by both: within a shard they stay in the order of the mix.

    Null keys share a shard; columns of the names of the results are replaced.
    """
    return sharding.shard(mixing.stored_position(docs)).orderBy("shard", "mix_position")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

#: SQL can express neither the language models nor the fingerprints; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
