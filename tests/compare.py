"""Results of Spark and DuckDB side by side, order left out."""

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    value = value.item() if isinstance(value, np.generic) else value
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(round(float(value), 9))
    return str(value)


def rows(frame):
    return sorted(tuple(map(plain, row)) for row in frame[sorted(frame.columns)].itertuples(index=False))


def assert_same(spark_frame, duck_frame):
    assert sorted(spark_frame.columns) == sorted(duck_frame.columns)
    assert rows(spark_frame) == rows(duck_frame)
