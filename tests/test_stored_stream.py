"""A stored log: stretches of several files each, one stretch a batch."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidelog.functions.folders import files_in
from tidelog.plans import stream_catalog
from tidelog.sinks import targets
from tidelog.sources.change_log import change_log, n_events


@pytest.mark.parametrize("gap", [False, True])
def test_a_batch_is_a_stretch(spark, sf_dir, monkeypatch, gap):
    """Also where numbers are missing, so that a file would have no entry."""
    monkeypatch.setattr(stream_catalog, "FILE_ROWS", 64)
    base, n, log = tempfile.mkdtemp(prefix="spark-"), n_events(spark, sf_dir), change_log(spark, sf_dir)
    log = log.where(~F.col("event_id").between(20, n // 3 + 100)) if gap else log
    stream, seen = stream_catalog.stored_stream(spark, sf_dir, base, log=log), {}

    def batch(df, batch_id):
        seen[batch_id] = sorted(r.event_id for r in df.select("event_id").collect())

    stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()
    every = sorted(r.event_id for r in log.select("event_id").collect())
    assert seen == {k: [e for e in every if n * k // 3 <= e < n * (k + 1) // 3] for k in range(3)}
    assert files_in(spark, f"{base}/log") == 3 * -(-n // (3 * 64)) > 3


def test_one_target_keeps_nothing(spark):
    """What only one target takes is not kept in memory; what several take is."""
    held = []

    class Looks:
        name = "looks"

        def apply(self, log, batch_id):
            held.append(log.storageLevel.useMemory)

    log = spark.range(3)
    assert targets.fan_out(log, [Looks()], 0) == [("looks", None)]
    assert targets.fan_out(log, iter([Looks(), Looks()]), 0) == [("looks", None)] * 2
    assert held == [False, True, True] and not log.storageLevel.useMemory
