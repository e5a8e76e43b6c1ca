"""Documents as keyed state: restarts, entries that come again, rejects; and writes in ordered chunks."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.test_merge_on_read import brute_rejects
from tests.test_updates import fold, random_log
from tidelog.sinks.chunked import read_chunks, write_chunks
from tidelog.streaming.keyed import PROVIDER, ROCKSDB, documents
from tidelog.streaming.tail import log_stream


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    yield
    spark.conf.set(PROVIDER, before)


def test_state_over_restarts(spark, rocksdb):
    """Two runs of one checkpoint, the second with entries of the first again; each batch emits what it changed and can't apply."""
    base = tempfile.mkdtemp()
    log, rows = random_log(spark, 41, n=160, nested=True)
    rejected = []
    for lo, hi in ((0, 90), (60, 160)):
        log.where((F.col("ts") > lo) & (F.col("ts") <= hi)).coalesce(1).write.mode("append").parquet(f"{base}/log")
        changed = documents(log_stream(spark, f"{base}/log"))
        writer = changed.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint")
        writer.foreachBatch(lambda df, n: df.write.parquet(f"{base}/out/batch={n}")).trigger(availableNow=True).start().awaitTermination()
    found = {}
    for r in sorted(spark.read.parquet(f"{base}/out").collect(), key=lambda r: r.batch):
        if r.reason:
            rejected.append((r.ns, r._id, r.ts, r.reason))
        else:
            found[r.ns, r._id] = (r.doc and json.loads(r.doc), r.ts)
    assert found == fold(rows)
    assert {r for r in rejected if r[3] == "no_base"} == brute_rejects(rows)


def test_chunks(spark):
    rows = [("a.b", k % 70, f'{{"v": {k}}}', k) for k in range(500)]
    df = spark.createDataFrame(rows, "ns string, _id long, j string, _ts long").withColumn("doc", F.parse_json("j")).drop("j")
    path = tempfile.mkdtemp() + "/chunks"
    found = write_chunks(df, path, 30, tasks=3).collect()
    assert sum(r.rows for r in found) == 500 and sum(r.written for r in found) == 70 and sum(r.duplicates for r in found) == 430
    last = {r.task: max(x.chunk for x in found if x.task == r.task) for r in found}
    assert all(r.rows == 30 or r.chunk == last[r.task] for r in found)
    read = read_chunks(spark, path).collect()
    assert {r._key: (r.ts, json.loads(r.doc)) for r in read} == {f"a.b/{k}": (max(x for x in range(500) if x % 70 == k), {"v": max(x for x in range(500) if x % 70 == k)}) for k in range(70)}
    with pytest.raises(ValueError):
        write_chunks(df, path, 0)
