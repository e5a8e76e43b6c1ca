"""Documents with typed values: nested replay gives what flat replay gives, type by type."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tidelog.functions.variants import from_python, to_python
from tidelog.operators import replay
from tidelog.sources.change_log import LOG_SCHEMA

VALUES = [
    None, True, False, 0, -1, 127, 128, -129, 70_000, -(1 << 40), (1 << 63) - 1, 1.5, float("inf"), "", "x" * 63, "é" * 70, b"", b"\x00\xff" * 40,
    decimal.Decimal("12.50"), decimal.Decimal("-0.000001"), decimal.Decimal("123456789012345678901234567890.12"), datetime.date(1969, 12, 31),
    datetime.datetime(2020, 1, 2, 3, 4, 5, 678), datetime.datetime(2020, 1, 2, 3, 4, 5, tzinfo=datetime.timezone.utc), [], {}, [1, [2, {"a": None}]],
    {f"k{k:03}": k for k in range(300)}, {"b": 1, "a": {"é": [b"z"]}},
]


@pytest.mark.parametrize("value", VALUES)
def test_values_come_back(value):
    back = to_python(from_python({"v": value}))["v"]
    assert back == value and type(back) is type(value)


def typed_log(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES (1L, 1L, 'i', 1), (2L, 1L, 'u', 2), (3L, 2L, 'i', 3), (4L, 2L, 'u', 4), (5L, 2L, 'u', 5), (6L, 3L, 'i', 6) AS t(ts, _id, op, k)"""
    )
    doc = F.expr(
        "to_variant_object(named_struct('b', X'00FF', 'n', double('1.5'), 't', timestamp'2020-01-02 03:04:05.000006', 'z', timestamp_ntz'2020-01-02 03:04:05', "
        "'d', date'2020-01-02', 'm', 12.50BD, 'i', k, 's', 'é', 'o', named_struct('b', X'01', 'l', array(1, 2))))"
    )
    sets = F.expr("map('n', cast(double('nan') AS variant), 'w', cast(X'AB' AS variant), 'm', cast(0.010BD AS variant))")
    return rows.select(
        "ts", F.lit("rs0").alias("replset"), F.col("ts").alias("event_id"), "op", F.lit("a.b").alias("ns"), "_id", F.lit(False).alias("from_migrate"),
        F.when(F.col("op") == "i", doc).alias("o"), F.when(F.col("op") == "u", sets).alias("set"), F.when(F.col("ts") == 5, F.array(F.lit("z"))).alias("unset"),
    )


def test_flat_is_nested_with_types(spark):
    log = typed_log(spark)
    assert set(log.columns) == {f.split()[0].strip("`") for f in LOG_SCHEMA.replace("MAP<STRING,VARIANT>", "MAP").split(", ")}
    shown = lambda state: sorted((r._id, r._ts, r.deleted, r.kind, r.text) for r in state.withColumns({"kind": F.schema_of_variant("doc"), "text": F.to_json("doc")}).collect())
    flat, nested = shown(replay.replay_flat(log)), shown(replay.replay_nested(log))
    assert flat == nested
    assert "b: BINARY" in nested[0][3] and "t: TIMESTAMP" in nested[0][3] and "n: DOUBLE" in nested[0][3] and "d: DATE" in nested[0][3]


def test_rejects_are_all_found(spark):
    """Also those that a later write hides."""
    log = typed_log(spark).withColumns({"_id": F.lit(9).cast("long"), "ts": F.col("ts")}).where("ts <> 1")
    assert [(r.ts, r.reason) for r in replay.rejects(log).collect()] == [(2, "no_base")]
    assert replay.replay_nested(log).count() == 1
