"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.compare import assert_same, database
from tidelog.plans import stream_catalog  # noqa: F401
from tidelog.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    if name in SQL:
        assert_same(found, duck.sql(SQL[name]).df())
    else:
        assert len(found)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
