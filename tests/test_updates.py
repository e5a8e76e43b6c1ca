"""Update specs on nested documents, and replay as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import replay
from tidelog.operators.replay import UpdateError, apply_delta
from tidelog.sources.change_log import LOG_SCHEMA, change_log, data_entries

APPLIES = [
    ({"name": "pen", "price": 2}, {}, ["price"], {"name": "pen"}),
    ({"size": {"w": 1, "h": 2}}, {}, ["size.h"], {"size": {"w": 1}}),
    ({"size": {"w": 1}}, {}, ["size.w"], {"size": {}}),
    ({"tags": ["x", "y", "z"]}, {}, ["tags.0"], {"tags": [None, "y", "z"]}),
    ({"name": "pen"}, {"stock.north.shelf": 7}, [], {"name": "pen", "stock": {"north": {"shelf": 7}}}),
    ({"name": "pen", "old": 1}, {"price": 3}, ["old"], {"name": "pen", "price": 3}),
    ({"name": "pen"}, {"price": 3}, ["price"], {"name": "pen"}),
    ({"tags": ["x"]}, {"tags.3": "w"}, [], {"tags": ["x", None, None, "w"]}),
    ({"tags": []}, {"tags.0": "w"}, [], {"tags": ["w"]}),
    ({"lots": [{"n": 1}]}, {"lots.2.n": 5}, [], {"lots": [{"n": 1}, None, {"n": 5}]}),
    ({"lots": [{"n": 1}, 4]}, {"lots.0.n": 9}, [], {"lots": [{"n": 9}, 4]}),
    ({"lots": [[1, 2], 4]}, {"lots.0.1": 9}, [], {"lots": [[1, 9], 4]}),
    ({"lots": [1, 2]}, {"lots": {"0": "a"}}, [], {"lots": {"0": "a"}}),
    ({"by": {"0": "a"}}, {"by.1": "b"}, ["by.0"], {"by": {"1": "b"}}),
]
NOTHING_TO_UNSET = [
    ({"name": "pen"}, ["price"]),
    ({"size": {"w": 1}}, ["size.depth.mm"]),
    ({"name": "pen"}, ["name.first"]),
    ({"tags": ["x"]}, ["tags.last"]),
    ({"tags": ["x"]}, ["tags.last.letter"]),
    ({"tags": ["x"]}, ["tags.1"]),
    ({"lots": [7, {"n": 1}]}, ["lots.1.m"]),
]
FAILS = [
    ({"name": "pen"}, {"name.0": "q"}),
    ({"name": "pen"}, {"name.first.letter": "q"}),
    ({"price": 3}, {"price.cents": 1}),
    ({"lots": [{"n": 1}]}, {"lots.n": 2}),
    ({"lots": [None]}, {"lots.0.n": 2}),
    ({"lots": [1]}, {"lots.-1": 2}),
    ({"lots": [1]}, {"lots.99999999": 2}),
]


@pytest.mark.parametrize("doc,sets,unsets,result", APPLIES)
def test_applies(doc, sets, unsets, result):
    assert apply_delta(doc, sets, unsets) == result
    assert apply_delta(doc, sets, unsets, missing_unset="error") == result


@pytest.mark.parametrize("doc,unsets", NOTHING_TO_UNSET)
def test_nothing_to_unset(doc, unsets):
    assert apply_delta(doc, {"new": 1}, unsets) == doc | {"new": 1}
    with pytest.raises(UpdateError):
        apply_delta(doc, {"new": 1}, unsets, missing_unset="error")


@pytest.mark.parametrize("doc,sets", FAILS)
def test_fails_as_a_whole(doc, sets):
    before = repr(doc)
    with pytest.raises(UpdateError):
        apply_delta(doc, {"first": 1} | sets, [])
    assert repr(doc) == before


def random_log(spark, seed, n=300, nested=False):
    rng, rows = random.Random(seed), []
    for ts in range(1, n + 1):
        op = rng.choice("iuuuudn")
        key = (f"db.c{rng.randrange(2)}", rng.randrange(4))
        whole = sets = unsets = None
        if op == "i" or (op == "u" and rng.random() < 0.2):
            whole = f'{{"a": {ts}, "b": {{"x": {ts}}}}}'
        elif op == "u":
            names = ["a", "b", "c", "b.x", "c.y", "l.2"] if nested else ["a", "b", "c"]
            sets = {name: str(ts) for name in {rng.choice(names), "a"} if rng.random() < 0.6} or None  # no path lies below another
            unsets = [rng.choice(names)] if sets is None or rng.random() < 0.3 else None
        rows.append((ts, "rs0", ts, op, *key, False, whole, sets, unsets))
    schema = LOG_SCHEMA.replace("VARIANT", "STRING")
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({"o": F.try_parse_json("o"), "set": F.transform_values("set", lambda _, v: F.parse_json(v))}), rows


def fold(rows):
    import json

    state = {}
    for ts, _, _, op, ns, key, _, whole, sets, unsets in rows:
        k = (ns, key)
        if op == "d":
            state[k] = (None, ts)
        elif whole is not None:
            state[k] = (json.loads(whole), ts)
        elif op == "u" and state.get(k, (None, 0))[0] is not None:
            try:
                state[k] = (apply_delta(state[k][0], {p: int(v) for p, v in (sets or {}).items()}, unsets), ts)
            except UpdateError:
                pass
    return state


def collected(state):
    import json

    return {(r.ns, r._id): (None if r.deleted else json.loads(r.j), r._ts) for r in state.withColumn("j", F.to_json("doc")).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_flat_is_nested_is_fold(spark, seed):
    log, rows = random_log(spark, seed)
    want = fold(rows)
    assert collected(replay.replay_flat(log)) == want
    assert collected(replay.replay_nested(log)) == want


@pytest.mark.parametrize("seed", range(3, 5))
def test_nested_is_fold(spark, seed):
    log, rows = random_log(spark, seed, nested=True)
    assert collected(replay.replay_nested(log)) == fold(rows)


def test_prefix_then_suffix(spark):
    log, rows = random_log(spark, 9)
    prefix = replay.replay_flat(log.where("ts <= 180"))
    once = replay.apply_incremental(prefix, log.where("ts > 90"))
    assert collected(once) == fold(rows)
    assert collected(replay.apply_incremental(once, log)) == fold(rows)


def test_empty_log(spark):
    log, _ = random_log(spark, 1, n=1)
    assert replay.replay_flat(log.where("false")).count() == 0
    assert replay.replay_nested(log.where("false")).count() == 0


def test_rename_chain_and_recreation():
    commands = [(10, "rename", "d.a", "d.b"), (20, "rename", "d.b", "d.c"), (30, "drop", "d.a", None), (40, "dropDatabase", "e", None)]
    found = {(ns, lo): final for ns, lo, _, final in replay.epochs(["d.a", "d.b", "e.x"], commands)}
    start = -(1 << 63)
    assert found["d.a", start] == "d.c" and found["d.a", 10] is None and found["d.a", 30] == "d.a"
    assert found["d.b", start] == "d.c" and found["d.b", 20] == "d.b"
    assert found["e.x", 30] is None and found["e.x", 40] == "e.x"


def test_hot_document_is_one_row_a_field(spark, sf_dir):
    log = data_entries(change_log(spark, sf_dir)).withColumns({"ns": F.lit("a.b"), "_id": F.lit(1).cast("long")})
    assert replay.replay_flat(log).count() == 1
