"""Several logs as one stream: positions, logs that appear later, restarts, logs that have lost their beginning."""

import os
import shutil
import tempfile

import pytest

from tests.test_entry_path import docs, insert, log_of
from tidelog.sinks.parquet_target import ParquetTarget
from tidelog.streaming.tail import tail_logs


def run(spark, path, target, checkpoint, **more):
    query = tail_logs(spark, path, [target], checkpoint, **more)
    query.awaitTermination()
    return query


def add(log, path):
    log.coalesce(1).write.partitionBy("replset").mode("append").parquet(path)


def test_logs_that_appear_later(spark):
    path, work = tempfile.mkdtemp() + "/logs", tempfile.mkdtemp()
    target = ParquetTarget(spark, work + "/t")
    add(log_of(spark, [insert(5, "a.x", 1, {"v": 1}), (7, "u", "a.x", 1, None, {"p.k": 2}, None)]), path)
    run(spark, path, target, work + "/c")
    assert docs(target.state()) == {("a.x", 1): {"v": 1, "p": {"k": 2}}}
    # the second log's entries are older than what has been read of the first
    add(log_of(spark, [insert(2, "a.y", 2, {"v": 2}, "rs1"), insert(3, "a.y", 3, {"v": 3}, "rs1"), insert(9, "a.x", 4, {"v": 4})]), path)
    query = run(spark, path, target, work + "/c")
    assert docs(target.state()) == {("a.x", 1): {"v": 1, "p": {"k": 2}}, ("a.y", 2): {"v": 2}, ("a.y", 3): {"v": 3}, ("a.x", 4): {"v": 4}}
    assert [eval(p["sources"][0]["endOffset"]) for p in query.recentProgress if p["numInputRows"]] == [{"rs0": 9, "rs1": 3}]
    run(spark, path, target, work + "/c")
    assert len([n for n in os.listdir(target.path) if n.startswith("changes")]) == 2


def test_from_an_offset_alone(spark):
    path, work = tempfile.mkdtemp() + "/logs", tempfile.mkdtemp()
    target = ParquetTarget(spark, work + "/t")
    add(log_of(spark, [insert(k, "a.x", k, {"v": k}, f"rs{k % 2}") for k in range(1, 9)]), path)
    run(spark, path, target, work + "/c", start={"rs0": 4, "rs1": 7})
    assert sorted(k for _, k in docs(target.state())) == [6, 8]


def test_a_log_without_its_beginning(spark):
    path, work = tempfile.mkdtemp() + "/logs", tempfile.mkdtemp()
    target = ParquetTarget(spark, work + "/t")
    add(log_of(spark, [insert(1, "a.x", 1, {"v": 1})]), path)
    run(spark, path, target, work + "/c")
    shutil.rmtree(path)
    add(log_of(spark, [insert(8, "a.x", 8, {"v": 1})]), path)
    with pytest.raises(Exception, match="unrecoverable"):
        run(spark, path, target, work + "/c")


def test_text_keys(spark):
    from pyspark.sql import functions as F

    path, work = tempfile.mkdtemp() + "/logs", tempfile.mkdtemp()
    target = ParquetTarget(spark, work + "/t", key="STRING")
    add(log_of(spark, [insert(1, "a.x", 1, {"v": 1})]).withColumn("_id", F.lit("one")), path)
    run(spark, path, target, work + "/c", key="STRING")
    assert docs(target.state()) == {("a.x", "one"): {"v": 1}}
