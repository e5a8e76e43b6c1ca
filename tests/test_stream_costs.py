"""What stream queries shouldn't do: open more stores than they have entries for, sort what can be hashed, read a mirror twice."""

import tempfile

import pytest

from tidelog.operators.replay import orphans
from tidelog.plans import stream_catalog
from tidelog.sinks.targets import JsonTarget
from tidelog.sources.change_log import change_log, data_entries
from tidelog.streaming.keyed import PARTITIONS, PROVIDER, ROCKSDB


def test_orphans_are_grouped_by_hash(spark, sf_dir):
    plan = orphans(data_entries(change_log(spark, sf_dir)))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_state_has_partitions_for_its_entries(spark, sf_dir, monkeypatch):
    cores, seen = spark.sparkContext.defaultParallelism, []
    assert stream_catalog.state_partitions(spark, 1) == cores and stream_catalog.state_partitions(spark, 100 * (1 << 17)) == 100

    def stops(spark, sf_dir, base):
        seen.append((spark.conf.get(PROVIDER), spark.conf.get(PARTITIONS)))
        raise RuntimeError("stopped")

    before = spark.conf.get(PROVIDER), spark.conf.get(PARTITIONS)
    monkeypatch.setattr(stream_catalog, "keyed_run", stops)
    monkeypatch.setattr(stream_catalog, "FILE_ROWS", 10)
    with pytest.raises(RuntimeError, match="stopped"):
        stream_catalog.stream_documents(spark, sf_dir)
    assert seen == [(ROCKSDB, str(-(-stream_catalog.n_events(spark, sf_dir) // 10)))]
    assert (spark.conf.get(PROVIDER), spark.conf.get(PARTITIONS)) == before


def test_a_mirror_of_known_columns_is_read_once(spark, sf_dir):
    target = JsonTarget(spark, tempfile.mkdtemp(prefix="spark-"))
    target.apply(change_log(spark, sf_dir), 0)
    spark.sparkContext.setJobGroup("mirror", "mirror")
    try:
        entries = target.entries("ts BIGINT")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("mirror")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert entries.count() == target.entries().count() > 0
