"""Flattening to any depth, formatting stored documents, patterns that meet."""

import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tidelog.operators import formatting
from tidelog.operators.routing import RULE_SCHEMA, Rule, Rules, ns_regex, pattern_overlaps, violations, witness


def brute_flat(value, path=()):
    if isinstance(value, dict):
        for key in sorted(value):
            yield from brute_flat(value[key], (*path, key))
    elif isinstance(value, list):
        for k, below in enumerate(value):
            yield from brute_flat(below, (*path, str(k)))
    else:
        yield ".".join(path), value


def deep(n):
    value = {"end": 1}
    for k in range(n):
        value = {f"k{k}": value} if k % 3 else [value, []]
    return {"top": value, "empty": {}, "list": [[1, [2, [3]]], []]}


def made(rng, level=0):
    kind = rng.random()
    if level > 7 or kind < 0.3:
        return rng.choice([1, "x", True])
    if kind < 0.65:
        return {rng.choice(["a", "b", "a.b", "c", "0"]): made(rng, level + 1) for _ in range(rng.randrange(4))}
    return [made(rng, level + 1) for _ in range(rng.randrange(4))]


def test_flatten_to_any_depth(spark):
    rng = random.Random(4)
    docs = [deep(40), {}, {"a": {"b": {"c": {"d": {"e": {"f": 1}}}}}}, {"a.b": 1, "a": {"b": 2}}] + [{"r": made(rng)} for _ in range(60)]
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "id long, j string").select("id", F.parse_json("j").alias("doc"))
    found = {}
    for r in formatting.flatten(df, ["id"]).collect():
        assert (r.id, r.path) not in found
        found[r.id, r.path] = r.value
    text = lambda v: v if isinstance(v, str) else json.dumps(v)
    assert found == {(k, path): text(v) for k, d in enumerate(docs) for path, v in dict(brute_flat(d)).items()}
    assert formatting.flatten(df.where("false"), ["id"]).count() == 0


def test_stored_documents_are_formatted(spark):
    rows = spark.sql(
        """SELECT 1 AS id, to_variant_object(named_struct('b', X'00FF', 'n', double('nan'), 'l', array(1.0D, double('inf')), 's', named_struct('x', double('nan'), 'y', 2.0D), 'z', array(named_struct('q', X'01')))) AS doc
        UNION ALL SELECT 2, parse_json('{"b": null, "new": {"k": [1, 2]}, "mixed": 1, "odd key": {"a.b": "t"}}') UNION ALL SELECT 3, parse_json('{"mixed": "text", "l": []}') UNION ALL SELECT 4, NULL"""
    )
    found = {r.id: r.j and json.loads(r.j) for r in formatting.format_state(rows).withColumn("j", F.to_json("doc")).collect()}
    assert found == {1: {"b": "AP8=", "s": {"y": 2.0}, "z": [{"q": "AQ=="}]}, 2: {"b": None, "new": {"k": [1, 2]}, "mixed": 1, "odd key": {"a.b": "t"}}, 3: {"mixed": "text", "l": []}, 4: None}
    assert formatting.format_state(rows.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_patterns_that_meet(seed):
    rng = random.Random(seed)
    part = lambda: "".join(rng.choice("ab*") for _ in range(rng.randrange(1, 4)))
    patterns = sorted({f"{part()}.{part()}" + rng.choice(["", ".a", "*"]) for _ in range(25)})
    names = [f"{''.join(x)}.{''.join(y)}" for n in range(4) for m in range(6) for x in itertools.product("ab", repeat=n) for y in itertools.product("ab.", repeat=m)]
    fits = {p: {n for n in names if re.match(ns_regex(p).replace(r"\z", r"\Z"), n, re.S)} for p in patterns}
    for p, q in itertools.combinations(patterns, 2):
        name, both = witness(p, q), fits[p] & fits[q]
        if name is None:
            assert not both, (p, q)
        else:
            assert all(re.match(ns_regex(x).replace(r"\z", r"\Z"), name, re.S) for x in (p, q)), (p, q, name)
            assert not both or len(name) <= min(map(len, both))


def test_overlaps_without_a_namespace(spark):
    df = spark.createDataFrame([("db*.x",), ("*1.x",), ("db.y*",), ("db.*z",), ("db.y.z",), ("other.x",), ("db.y*",)], "pattern string")
    found = {(r.pattern, r.other): r.name for r in pattern_overlaps(df).collect()}
    assert found == {("*1.x", "db*.x"): "db1.x", ("db.*z", "db.y*"): "db.yz", ("db.*z", "db.y.z"): "db.y.z", ("db.y*", "db.y.z"): "db.y.z"}


@pytest.mark.parametrize("seed", range(3))
def test_violations_of_a_table(spark, seed):
    rng = random.Random(seed)
    name = lambda: rng.choice(["a", "b*", "a.b", "a.c", "*.b", "a*.b", "a.b*", "a.*c*", ".x", "a."])
    fields = lambda: rng.choice([(), ("v",)])
    rules = Rules(tuple(Rule(name(), rng.choice([None, name()]), rng.random() < 0.3, rng.random() < 0.3, fields(), fields()) for _ in range(25)))
    rows = [(r.source, r.dest, r.gridfs, r.excluded, list(r.include), list(r.exclude)) for r in rules.rules]
    found = violations(spark.createDataFrame(rows, RULE_SCHEMA))
    assert {tuple(r) for r in found.collect()} == set(rules.violations())
