"""The Parquet target: batches, restarts, rollback."""

import tempfile

from pyspark.sql import functions as F

from tests.test_updates import collected, fold, random_log
from tidelog.operators.replay import replay_flat, visible
from tidelog.sinks.targets import ParquetTarget
from tidelog.streaming.tail import recover


def test_batches_and_their_repetition(spark):
    log, rows = random_log(spark, 11)
    target = ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=4)
    assert target.state().count() == 0 and target.last().count() == 0
    for batch, (lo, hi) in enumerate([(0, 100), (100, 200), (200, 300)]):
        part = log.where((F.col("ts") > lo) & (F.col("ts") <= hi))
        target.apply(part, batch)
        target.apply(part, batch)
    target.apply(log.where("false"), 3)
    assert collected(target.state()) == fold(rows)
    assert target.last().first()._ts == max(ts for _, ts in fold(rows).values())


def test_rollback(spark):
    log, rows = random_log(spark, 12)
    target = ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=4)
    target.apply(log, 0)
    kept = log.where("ts <= 285")
    source = visible(replay_flat(kept)).select("ns", "_id", "doc")
    checkpoints = spark.createDataFrame([("rs0", 300)], "replset string, ts long")
    decisions = recover(kept, checkpoints, source, [target], 1).collect()
    assert [(r.replset, r.decision) for r in decisions] == [("rs0", "rollback")]
    docs = lambda state: {k: doc for k, (doc, _) in state.items() if doc is not None}
    assert docs(collected(target.state())) == docs(fold(rows[:285]))
    checkpoints = spark.createDataFrame([("rs0", max(r[0] for r in rows[:285] if r[3] != "n"))], "replset string, ts long")
    before = collected(target.state())
    assert recover(kept, checkpoints, source, [target], 2).first().decision == "continue"
    assert collected(target.state()) == before
