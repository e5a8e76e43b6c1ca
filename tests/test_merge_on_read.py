"""The merge-on-read target: default replay, rejects, crashes at every step, keys of other types, pruned searches."""

import glob
import os
import shutil
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_entry_path import command, docs, insert, log_of
from tests.test_updates import collected, fold, random_log
from tidelog.operators import replay
from tidelog.operators.routing import Rules
from tidelog.plans.replicate import replicate, replicate_all
from tidelog.sinks.parquet_target import ParquetTarget
from tidelog.sources.change_log import log_schema


def new_target(spark, **more):
    return ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=3, **more)


def brute_rejects(rows):
    """(key, ts, reason) of updates that can't be applied."""
    out, state = set(), {}
    for ts, _, _, op, ns, key, _, whole, sets, unsets in rows:
        if op == "u" and whole is None and (sets or unsets):
            if state.get((ns, key)) is None:
                out.add((ns, key, ts, "no_base"))
        elif op == "d":
            state[ns, key] = None
        elif whole is not None:
            state[ns, key] = whole
    return out


def test_dotted_updates_by_default(spark):
    log = log_of(spark, [insert(1, "a.b", 1, {"p": {"k": 1}}), (2, "u", "a.b", 1, None, {"p.k": 5}, None), insert(3, "a.b", 2, {"v": 1}), (4, "u", "a.b", 2, None, {"v": 2}, None)])
    want = {("a.b", 1): {"p": {"k": 5}}, ("a.b", 2): {"v": 2}}
    target = new_target(spark)
    target.apply(log, 0)
    assert docs(replicate(log, Rules(), mode="tail")) == docs(target.state()) == want
    target.compact()
    target.apply(log.where("ts = 2").withColumns({"ts": F.lit(9).cast("long"), "set": F.map_from_arrays(F.array(F.lit("p.l")), F.map_values("set"))}), 1)
    assert docs(target.state()) == want | {("a.b", 1): {"p": {"k": 5, "l": 5}}}


@pytest.mark.parametrize("nested", [False, True])
def test_state_and_rejects(spark, nested):
    log, rows = random_log(spark, 21, nested=nested)
    found = replicate_all(log, Rules(), mode="tail")
    assert collected(found.state) == fold(rows)
    assert {(r.ns, r._id, r.ts, r.reason) for r in found.rejects.collect() if r.reason == "no_base"} == brute_rejects(rows)
    target = new_target(spark)
    for lo, hi in ((0, 120), (80, 200), (200, 300)):
        target.apply(log.where((F.col("ts") > lo) & (F.col("ts") <= hi)), 0)
        if hi == 200:
            target.compact()
            target.clean()
            assert len([n for n in os.listdir(target.path) if n.startswith("changes")]) == 0
    assert collected(target.state()) == fold(rows)
    got = [(r.ns, r._id, r.ts, r.reason) for r in target.rejects().where("reason = 'no_base'").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_rejects(rows)


def test_an_update_without_a_base_is_a_reject(spark):
    target = new_target(spark)
    target.apply(log_of(spark, [(1, "u", "a.b", 1, None, {"v": 1}, None)]), 0)
    assert [tuple(r) for r in target.rejects().collect()] == [("a.b", 1, 1, "u", "no_base")] and target.state().count() == 0


def test_rejects_of_a_hot_document(spark):
    """Entries of one document are judged in many stretches of time, as one."""
    rows = []
    for ts in range(1, 2001):
        rows.append(insert(ts, "a.b", 1, {"v": 1}) if ts in (400, 401, 1500) else (ts, "d", "a.b", 1, None, None, None) if ts in (900, 1900) else (ts, "u", "a.b", 1, None, {"v": ts}, None))
    found = {r.ts for r in replay.orphans(log_of(spark, rows)).collect()}
    assert found == {*range(1, 400), *range(901, 1500), *range(1901, 2001)}


def test_crashes_lose_nothing(spark):
    """Whatever a broken attempt leaves behind, the table is as before it, and right after the batch has run again."""
    log, rows = random_log(spark, 31, nested=True)
    target, done = new_target(spark), fold(rows[:150])
    target.apply(log.where("ts <= 150"), 0)
    half = log.where("ts > 150")

    def broken(step, make):
        """The target after ``make`` broke off at ``step``: no mark of success, or files missing, or half the files only."""
        before = set(os.listdir(target.path))
        make()
        for name in set(os.listdir(target.path)) - before:
            if name.startswith("rejects") and step == "no success":
                continue
            path = f"{target.path}/{name}"
            if step == "before anything":
                shutil.rmtree(path)
                continue
            os.remove(f"{path}/_SUCCESS")
            parts = sorted(glob.glob(f"{path}/part-*"))
            for part in parts if step == "no files" else parts[::2] if step == "half the files" else []:
                os.remove(part)

    for step in ("before anything", "no files", "half the files", "no success"):
        broken(step, lambda: target.apply(half, 1))
        assert collected(target.state()) == done
    broken("no success", target.compact)
    assert collected(target.state()) == done
    target.apply(half, 1)
    target.apply(half, 1)
    assert collected(target.state()) == fold(rows)
    for step in ("before anything", "half the files", "no success"):
        broken(step, target.compact)
        assert collected(target.state()) == fold(rows)
    target.compact()
    target.clean()
    assert collected(target.state()) == fold(rows)


def test_commands_write_nothing_but_themselves(spark):
    target = new_target(spark)
    target.apply(log_of(spark, [insert(k, "a.x", k, {"v": k}) for k in range(1, 60)]), 0)
    before = {n: os.path.getmtime(f"{target.path}/{n}") for n in os.listdir(target.path)}
    target.apply(log_of(spark, [command(70, "a.$cmd", {"drop": "x"})]), 1)
    assert all(os.path.getmtime(f"{target.path}/{n}") == t for n, t in before.items())
    assert docs(target.state()) == {} and target.state().where("deleted and _ts = 70").count() == 59


@pytest.mark.parametrize("kind,keys", [("STRING", ["x", "", "é"]), ("BINARY", [b"\x00", b"\xff\x01", b""]), ("DECIMAL(20,0)", [1, 2, 3])])
def test_keys_of_other_types(spark, kind, keys):
    import decimal

    keys = [decimal.Decimal(k) if isinstance(k, int) else k for k in keys]
    rows = [(1, "i", keys[0], '{"v": 1}', None), (2, "i", keys[1], '{"p": {}}', None), (3, "u", keys[1], None, "p.k"), (4, "u", keys[2], None, "v"), (5, "u", keys[0], None, "w")]
    made = spark.createDataFrame(rows, f"ts long, op string, _id {kind}, o string, path string")
    log = made.select(
        "ts", F.lit("rs0").alias("replset"), F.col("ts").alias("event_id"), "op", F.lit("a.b").alias("ns"), "_id", F.lit(False).alias("from_migrate"), F.parse_json("o").alias("o"),
        F.when(F.col("path").isNotNull(), F.create_map("path", F.col("ts").cast("variant"))).alias("set"), F.lit(None).cast("array<string>").alias("unset"),
    )
    assert log.schema["_id"].dataType == spark.createDataFrame([], log_schema(kind)).schema["_id"].dataType
    target = new_target(spark, key=kind)
    target.apply(log, 0)
    key = lambda k: bytes(k) if isinstance(k, bytearray) else k
    for _ in range(2):
        found = {key(r._id): r.j for r in target.state().withColumn("j", F.to_json("doc")).collect()}
        assert found == {keys[0]: '{"v":1,"w":5}', keys[1]: '{"p":{"k":3}}'}
        assert [(key(r._id), r.reason) for r in target.rejects().collect()] == [(keys[2], "no_base")]
        target.compact()


def test_search_reads_few_row_groups(spark):
    """In a compacted table, a search for the newest hundredth leaves most files out."""
    target = ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=16)
    log = log_of(spark, [insert(1, "a.x", 0, {})]).crossJoin(spark.range(1, 8001).withColumnRenamed("id", "k")).withColumns({"ts": F.col("k"), "_id": F.col("k")}).drop("k")
    target.apply(log, 0)
    target.compact()
    found = target.search(7921, 8000)
    assert found.count() == 80
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_ts,7921)" in text, "the bounds reach the scan"
    bounds = []
    for name in glob.glob(f"{target.path}/base-*/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for group in map(meta.row_group, range(meta.num_row_groups)):
            stats = next(c.statistics for c in map(group.column, range(group.num_columns)) if c.path_in_schema == "_ts")
            bounds.append((stats.min, stats.max))
    assert len(bounds) == 16 and sum(hi >= 7921 for _, hi in bounds) <= 2
    target.apply(log.where("ts > 7990").withColumns({"ts": F.col("ts") + 100, "op": F.lit("d")}), 1)
    assert target.search(7921, 8000).count() == 70 and target.search(8001, 9000).where("deleted").count() == 10
