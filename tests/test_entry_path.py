"""Rules, commands and files through the one entry path, in batch and in targets; rollback of one log and through renames."""

import json
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tests.test_updates import collected
from tidelog.operators import files, predicates, reconcile, replay
from tidelog.operators.routing import Rule, Rules
from tidelog.plans.replicate import replicate, resume_scan, with_files
from tidelog.sinks.targets import FileTarget, ParquetTarget
from tidelog.sources.change_log import LOG_SCHEMA
from tidelog.streaming.tail import recover


def log_of(spark, rows):
    """Entries from (ts, op, ns, _id, document or None, sets or None, unsets or None[, replset])."""
    full = [(r[0], r[7] if len(r) > 7 else "rs0", r[0], r[1], r[2], r[3], False, r[4] and json.dumps(r[4]), r[5] and {k: json.dumps(v) for k, v in r[5].items()}, r[6]) for r in rows]
    df = spark.createDataFrame(full, LOG_SCHEMA.replace("VARIANT", "STRING"))
    return df.withColumns({"o": F.try_parse_json("o"), "set": F.transform_values("set", lambda _, v: F.parse_json(v))})


def docs(state):
    return {(r.ns, r._id): json.loads(r.j) for r in state.where("not deleted").withColumn("j", F.to_json("doc")).collect()}


def insert(ts, ns, key, doc, *more):
    return (ts, "i", ns, key, doc, None, None, *more)


def command(ts, ns, doc):
    return (ts, "c", ns, None, doc, None, None)


def test_excluded_fields_reach_no_target(spark):
    rules = Rules((Rule("a.x", "b.x", exclude=("secret",)), Rule("a.y", include=("v",))))
    rows = [
        insert(1, "a.x", 1, {"secret": "s", "v": 1}), (2, "u", "a.x", 1, None, {"secret": "t"}, None), (3, "u", "a.x", 1, None, {"v": 2, "secret": "t"}, ["secret"]),
        insert(4, "a.y", 1, {"secret": "s", "v": 1}), insert(5, "a.z", 1, {"v": 1}),
    ]
    log = log_of(spark, rows)
    want = {("b.x", 1): {"v": 2}, ("a.y", 1): {"v": 1}}
    assert docs(replicate(log, rules, mode="tail")) == want
    target = ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=3)
    target.apply(predicates.prepare(log, rules), 0)
    assert docs(target.state()) == want
    assert predicates.prepare(log, rules).where("ts = 2").count() == 0


def test_global_fields_without_rules(spark):
    log = log_of(spark, [insert(1, "a.x", 1, {"secret": "s", "v": 1})])
    assert docs(replicate(log, Rules(exclude=("secret",)), mode="tail")) == {("a.x", 1): {"v": 1}}


def test_commands_of_the_log(spark):
    rules = Rules((Rule("a.*", "t.*"), Rule("b.one", "u.one"), Rule("b.two", "v.two")))
    rows = [
        insert(1, "a.y", 1, {"v": 1}), insert(2, "a.z", 2, {"v": 2}), insert(3, "b.one", 3, {"v": 3}), insert(4, "b.two", 4, {"v": 4}), command(5, "a.$cmd", {"drop": "y"}),
        insert(6, "a.y", 7, {"v": 7}), command(7, "a.$cmd", {"renameCollection": "a.z", "to": "a.w"}), command(8, "b.$cmd", {"dropDatabase": 1}), insert(9, "b.one", 5, {"v": 5}),
        command(10, "a.$cmd", {"create": "new"}), command(11, "a.$cmd", {"renameCollection": "a.w", "to": "elsewhere.w"}), command(12, "c.$cmd", {"drop": "y"}),
    ]
    log, want = log_of(spark, rows), {("t.y", 7): {"v": 7}, ("t.w", 2): {"v": 2}, ("u.one", 5): {"v": 5}}
    assert docs(replicate(log, rules, mode="tail")) == want
    target = ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=3)
    for batch, (lo, hi) in enumerate([(0, 4), (4, 6), (6, 9), (9, 12)]):
        part = predicates.prepare(log.where((F.col("ts") > lo) & (F.col("ts") <= hi)), rules)
        target.apply(part, batch)
        target.apply(part, batch)
    assert docs(target.state()) == want


@pytest.mark.parametrize("seed", range(4))
def test_commands_are_the_sequential_fold(spark, monkeypatch, seed):
    monkeypatch.setattr(replay, "AT_ONCE", [1 << 20, 7][seed % 2])  # in one go, or in slices
    rng, names = random.Random(seed), [f"{db}.{c}" for db in "ab" for c in "xyz"]
    rows, state = [], {}
    for ts in range(1, 160):
        kind = rng.random()
        if kind < 0.75:
            ns, key = rng.choice(names), rng.randrange(1000)
            rows.append(insert(ts, ns, key, {"v": ts}))
            state[ns, key] = {"v": ts}
        elif kind < 0.85:
            ns = rng.choice(names)
            rows.append(command(ts, f"{ns[0]}.$cmd", {"drop": ns[2:]}))
            state = {k: v for k, v in state.items() if k[0] != ns}
        elif kind < 0.97:
            old, new = rng.sample(names, 2)
            if not any(k[0] == new for k in state):
                rows.append(command(ts, "a.$cmd", {"renameCollection": old, "to": new}))
                state = {(new if ns == old else ns, key): v for (ns, key), v in state.items()}
        else:
            db = rng.choice("ab")
            rows.append(command(ts, f"{db}.$cmd", {"dropDatabase": 1}))
            state = {k: v for k, v in state.items() if k[0][0] != db}
    assert docs(replay.replay_flat(replay.apply_commands(log_of(spark, rows)))) == state


def test_databases_go_to_several(spark):
    rules = Rules((Rule("d*.a", "x*.a"), Rule("d1.b", "y.b"), Rule("e.c", excluded=True)))
    df = spark.createDataFrame([("d1",), ("e",), ("d",)], "db string")
    found = {r.db: sorted(r.t) for r in df.withColumn("t", rules.target_dbs(F.col("db"))).collect()}
    assert found == {"d1": ["x1", "y"], "e": [], "d": ["x"]}
    assert [r.t for r in df.withColumn("t", Rules().target_dbs(F.col("db"))).collect()] == [["d1"], ["e"], ["d"]]


def test_files_are_stored_and_removed(spark):
    rules = Rules((Rule("a.fs", gridfs=True), Rule("a.x")))
    texts = spark.createDataFrame([(k, f"content {k} " * 300) for k in (1, 2, 3)], "doc_id long, text string")
    chunks, table = files.chunk_texts(texts).where("not (files_id = 3 and n = 1)"), files.file_table(texts)
    rows = [insert(k, "a.fs.files", k, {"filename": f"f{k}"}) for k in (1, 2, 3)] + [insert(4, "a.x", 1, {"v": 1}), (5, "d", "a.fs.files", 2, None, None, None), insert(6, "b.fs.files", 1, {"v": 1})]
    own = predicates.prepare(log_of(spark, rows), rules)
    both = [FileTarget(spark, tempfile.mkdtemp() + "/f", table, chunks, buckets=2), ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=2)]
    for part in ("ts < 4", "ts >= 4", "ts >= 4"):
        for target in both:
            target.apply(own.where(part), 0)
    found = {(r.ns, r._id): (r.gridfs_id, r.length, r.content) for r in both[0].contents().collect()}
    assert found == {("a.fs", 1): (1, len("content 1 ") * 300, "content 1 " * 300)}
    assert docs(both[1].state()) == {("a.x", 1): {"v": 1}}
    state = with_files(replicate(log_of(spark, rows), rules, mode="tail"), rules)
    assert {(r.ns, r._id): r.gridfs_id for r in state.where("not deleted").collect()} == {("a.fs", 1): 1, ("a.fs", 3): 3, ("a.x", 1): None}


def test_long_texts_are_cut_in_one_pass(spark):
    df = spark.createDataFrame([(1, "ab\né" * (1 << 20)), (2, ""), (3, None)], "doc_id long, text string")
    files.chunk_texts(df.where("doc_id = 2")).count()
    began = time.perf_counter()
    found = files.chunk_texts(df).agg(F.count("*").alias("n"), F.sum(F.length("data")).alias("chars"), F.max("n").alias("last")).first()
    assert (found.n, found.chars, found.last) == (4097, 4 << 20, 4095)
    assert time.perf_counter() - began < 10


def test_rollback_of_one_of_two_logs(spark):
    rows = [insert(10, "a.x", 1, {"v": 1}, "rs0"), insert(20, "a.x", 2, {"v": 1}, "rs1"), insert(50, "a.x", 3, {"v": "lost"}, "rs0"), insert(60, "a.x", 1, {"v": "lost"}, "rs0"), insert(100, "a.x", 4, {"v": 1}, "rs1")]
    log = log_of(spark, rows)
    kept, source = log.where("ts not in (50, 60)"), log.where("ts in (10, 20, 100)").select("ns", "_id", F.col("o").alias("doc"))
    target = ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=3)
    target.apply(log, 0)
    decisions = recover(kept, spark.createDataFrame([("rs0", 60), ("rs1", 100)], "replset string, ts long"), source, [target], 1).collect()
    assert {r.replset: r.decision for r in decisions} == {"rs0": "rollback", "rs1": "continue"}
    assert docs(target.state()) == {("a.x", 1): {"v": 1}, ("a.x", 2): {"v": 1}, ("a.x", 4): {"v": 1}}


def test_rollback_through_a_rename(spark):
    rules = Rules((Rule("a.x", "target.x", exclude=("secret",)),))
    log = log_of(spark, [insert(10, "a.x", 1, {"v": 1, "secret": 2}), insert(20, "a.x", 2, {"v": 2, "secret": 2}), insert(30, "a.x", 3, {"v": 3})])
    state = replicate(log, rules, mode="tail")
    source = log.where("ts < 30").select("ns", "_id", F.col("o").alias("doc"))
    found = reconcile.reconcile(state, log.where("ts < 30"), source, rules)
    assert sorted((r.ns, r._id) for r in found["deletes"].collect()) == [("target.x", 3)]
    assert docs(found["state"]) == {("target.x", 1): {"v": 1}, ("target.x", 2): {"v": 2}}


def test_the_plan_reads_the_log_once(spark):
    path = tempfile.mkdtemp() + "/log"
    log_of(spark, [insert(1, "a.x", 1, {"v": 1})]).write.parquet(path)
    rules = Rules((Rule("a.*", "b.*", exclude=("s",)), Rule("c.*", include=("v",)), Rule("d.*", exclude=("t", "u")), Rule("e.*")))
    plan = replicate(spark.read.parquet(path), rules, mode="tail")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_resumed_scans_go_on_after_the_last_key(spark):
    snap = spark.createDataFrame([("a.x", k, json.dumps({"v": k, "s": k})) for k in (5, 1, 3)] + [("a.y", 9, "{}")], "ns string, _id long, j string").select("ns", "_id", F.parse_json("j").alias("doc"))
    rules = Rules((Rule("a.x", exclude=("s",)),))
    assert [r._id for r in resume_scan(snap, "a.x").collect()] == [1, 3, 5]
    assert [(r._id, r.j) for r in resume_scan(snap, "a.x", 1, rules).withColumn("j", F.to_json("doc")).collect()] == [(3, '{"v":3}'), (5, '{"v":5}')]


def test_a_table_that_can_not_be_read_is_no_empty_one(spark):
    path = tempfile.mkdtemp() + "/t"
    import os

    os.makedirs(f"{path}/changes-0000000001")
    for name, text in (("part-0.parquet", "not parquet"), ("_SUCCESS", "")):
        with open(f"{path}/changes-0000000001/{name}", "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)parquet"):
        ParquetTarget(spark, path, buckets=2).state().count()


def test_states_with_tombstones_survive_a_second_run(spark):
    log = log_of(spark, [insert(1, "a.x", 1, {"v": 1}), (2, "d", "a.x", 1, None, None, None)])
    target = ParquetTarget(spark, tempfile.mkdtemp() + "/t", buckets=2)
    target.apply(log, 0)
    target.apply(log, 0)
    assert collected(target.state()) == {("a.x", 1): (None, 2)}
