"""Tables with every awkward case, for all operators."""

import pytest

CLASH = ("fp", "hash", "shard", "n", "bucket", "language", "words", "spans", "license", "count", "component_id", "host", "mix_block", "kind", "label", "size", "block", "_hash")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def with_clashes(df):
    from pyspark.sql import functions as F

    for name in CLASH:
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in each column, empty and very long texts, ties, repeated rows, clashing columns."""
    prose = "the quick brown fox jumps over the lazy dog and runs to the old mill by the river"
    rows = [
        (1, prose, "en", "a", 1), (2, prose, "en", "a", 1), (2, prose, "en", "a", 1), (3, None, "en", "a", None), (4, "", "en", None, 0),
        (None, prose + " again", "en", "b", 1), (None, None, None, None, None), (5, "word " * 60_000, "en", "b", 5), (6, "12 34 ... !!", None, "b", 1),
        (7, "le renard brun saute par dessus le chien et court vers le moulin", "fr", "c", 1), (8, "ééé\n\tñandú 😀 token = 'abcdef123456'", "es", "c", 1), (9, "x", "en", "c", 1),
    ]
    return with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_clashes(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")
