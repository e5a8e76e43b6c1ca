"""Namespaces, predicates, field projection, formatting, checkpoints."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidelog.functions.scalars import ns_coll, ns_db, pack_ts, ts_increment, ts_seconds
from tidelog.operators import fields, formatting, reconcile, routing
from tidelog.operators.routing import Rule, Rules, parse_rules
from tidelog.sinks import checkpoints, targets


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first().x


def routed(spark, rules, names):
    df = spark.createDataFrame([(n,) for n in names], "ns string")
    return {r.ns: r.dest for r in df.select("ns", rules.route(F.col("ns")).dest.alias("dest")).collect()}


def test_packed_timestamps(spark):
    df = spark.createDataFrame([(0x12345678, 0x10ABCDEF)], "s long, i long")
    packed = pack_ts(F.col("s"), F.col("i"))
    row = df.select(packed.alias("p"), ts_seconds(packed).alias("s"), ts_increment(packed).alias("i")).first()
    assert (row.p, row.s, row.i) == (0x1234567810ABCDEF, 0x12345678, 0x10ABCDEF)


def test_namespaces_split_at_the_first_dot(spark):
    assert one(spark, ns_db(F.col("n")), n="a.b.c") == "a"
    assert one(spark, ns_coll(F.col("n")), n="a.b.c") == "b.c"
    assert one(spark, F.coalesce(ns_coll(F.col("n")), F.lit("-")), n="a") == "-"


def test_routing(spark):
    rules = Rules(
        (Rule("db.*", "new_*.coll"[:0] or "new.*"), Rule("db.plain", "other.plain"), Rule("*.foo", "*.bar"), Rule("db.no*", excluded=True), Rule("a.b.c"))
    )
    found = routed(spark, rules, ["db.x", "db.x.y", "db.plain", "zz.foo", "z.z.foo", "db.nothing", "a.b.c", "a.b", "db.x\n"])
    assert found == {"db.x": "new.x", "db.x.y": "new.x.y", "db.plain": "other.plain", "zz.foo": "zz.bar", "z.z.foo": None, "db.nothing": None, "a.b.c": "a.b.c", "a.b": None, "db.x\n": "new.x\n"}


def test_no_rules_let_all_pass_but_the_excluded(spark):
    assert routed(spark, Rules((Rule("a.*", excluded=True),)), ["a.b", "c.d"]) == {"a.b": None, "c.d": "c.d"}


def test_first_wildcard_wins_and_unmap_inverts(spark):
    rules = Rules((Rule("a.b*", "x.b*"), Rule("a.*", "y.*")))
    assert routed(spark, rules, ["a.bc", "a.c"]) == {"a.bc": "x.bc", "a.c": "y.c"}
    assert one(spark, rules.unmap(F.col("n")), n="y.c") == "a.c"
    assert one(spark, rules.unmap(F.col("n")).isNull(), n="q.c")


def test_configuration_styles():
    rules = parse_rules({"a.b": True, "a.c": False, "a.d": "e.d", "a.f": {"rename": "e.f", "includeFields": ["x"]}}, exclude=("y", "_id"))
    assert [r.target for r in rules.included] == ["a.b", "e.d", "e.f"]
    assert rules.fields(rules.included[2]) == (["_id", "x"], ["y"])
    assert rules.databases() == ["a"] and parse_rules({"*.x": True}).databases() == []


@pytest.mark.parametrize(
    "rules,reason",
    [
        ((Rule("nodot"),), "no_dot"),
        ((Rule("a.*b*"),), "many_wildcards"),
        ((Rule("a.*", "b.c"),), "wildcard_count"),
        ((Rule("*.a", "b.*"),), "wildcard_moved"),
        ((Rule("a.b", "x.y"), Rule("a.c", "x.y")), "target_twice"),
        ((Rule("a.b"), Rule("a.b", excluded=True)), "included_and_excluded"),
        ((Rule("a.b", include=("x",), exclude=("y",)),), "both_field_kinds"),
        ((Rule("a.b", "a.c", gridfs=True),), "file_renamed"),
    ],
)
def test_violations(rules, reason):
    assert reason in {r for _, r in Rules(rules).violations()}
    assert not Rules((Rule("a.*", "b.*"), Rule("*.x"), Rule("a.*c*", excluded=True))).violations()


INCLUDE = [
    ({"name": "pen", "size": {"w": {}}}, ["name", "size.w.mm"], {"name": "pen"}),
    ({"size": {"w": {"mm": 2, "in": 3}, "h": 5}, "name": "pen"}, ["size.w.mm", "size.h"], {"size": {"w": {"mm": 2}, "h": 5}}),
    ({"name": "pen"}, ["price"], {}),
    ({"size": {"w": {"size": {"w": 1}}}, "w": 1}, ["size.w"], {"size": {"w": {"size": {"w": 1}}}}),
    ({"name": 1, "names": 2}, ["name"], {"name": 1}),
    ({"lots": [{"n": 1}]}, ["lots.n"], {}),
    ({"price": None, "name": 1}, ["price"], {"price": None}),
    ({"size": {"w": 1, "h": 2}}, ["size", "size.w"], {"size": {"w": 1, "h": 2}}),
]
EXCLUDE = [
    ({"size": {"w": {"mm": 2, "in": 3}}}, ["size.w.mm"], {"size": {"w": {"in": 3}}}),
    ({"size": {"w": 1}}, ["size.w"], {"size": {}}),
    ({"name": 1}, ["name"], {}),
    ({"name": 1}, ["name.first"], {"name": 1}),
    ({"size": {"w": 1}, "name": {"w": 1}}, ["size.w", "none.w"], {"size": {}, "name": {"w": 1}}),
    ({"price": None, "name": 1}, ["name"], {"price": None}),
    ({"lots": [{"n": 1}]}, ["lots.n"], {"lots": [{"n": 1}]}),
]


def document(spark, make, doc):
    df = spark.createDataFrame([(json.dumps(doc),)], "j string").withColumn("d", F.parse_json("j"))
    return json.loads(df.select(F.to_json(make(F.col("d"))).alias("x")).first().x)


@pytest.mark.parametrize("doc,names,result", INCLUDE)
def test_include(spark, doc, names, result):
    assert document(spark, lambda d: fields.include_fields(d, names), doc) == result


@pytest.mark.parametrize("doc,names,result", EXCLUDE)
def test_exclude(spark, doc, names, result):
    assert document(spark, lambda d: fields.exclude_fields(d, names), doc) == result


UPDATES = [
    (fields.include_update, {"size.w": 1, "size.h": 3, "name": 2, "lots": {"n": 3}}, ["size", "lots"], {"size.w": 1, "size.h": 3, "lots": {"n": 3}}),
    (fields.include_update, {"size": {"w": 3, "h": 1}, "sizes": 1}, ["size.w"], {"size": {"w": 3}}),
    (fields.include_update, {"tags.0": "x", "tags.3": "y", "name": 3}, ["tags"], {"tags.0": "x", "tags.3": "y"}),
    (fields.include_update, {"size.w": {"mm": 3}, "size.h": 1}, ["size.w.in"], None),
    (fields.exclude_update, {"size.w": 1, "size.h": 3, "name": 2, "lots": {"n": 3}}, ["size", "lots"], {"name": 2}),
    (fields.exclude_update, {"size": {"w": 3, "h": 1}, "sizes": 1}, ["size.w"], {"size": {"h": 1}, "sizes": 1}),
    (fields.exclude_update, {"size": {"w": 3}, "name": 1}, ["size.w", "name"], {"size": {}}),
    (fields.exclude_update, {"size.w.mm": 42, "lots.0.n": 1, "name": 4}, ["size.w", "lots"], {"name": 4}),
    (fields.exclude_update, {"size.w": 1, "name": 1}, ["size", "name"], None),
]


@pytest.mark.parametrize("make,sets,names,result", UPDATES)
def test_update_fields(spark, make, sets, names, result):
    df = spark.createDataFrame([({k: json.dumps(v) for k, v in sets.items()},)], "m map<string,string>")
    df = df.select(F.transform_values("m", lambda _, v: F.parse_json(v)).alias("m"))
    found = df.select(F.to_json(make(F.col("m"), names)).alias("x")).first().x
    assert (found and json.loads(found)) == result


def test_typed_values(spark):
    df = spark.sql("SELECT X'0001' AS b, double('nan') AS n, array(1.5D, double('inf')) AS l, struct('a.*' AS pattern, 'xzi' AS flags) AS r, 1.50BD AS d, struct(1 AS i) AS s, true AS t")
    row = formatting.format_documents(df).first()
    assert (row.b, row.n, row.l, row.r, row.d, row.s.i, row.t) == ("AAE=", None, None, "/a.*/ix", "1.50", 1, True)


def test_flatten(spark):
    doc = {"a": {"b": 1, "c": [10, {"d": "x"}]}, "e": {}, "f": [], "g": "t", "h": {"i": {"j": {"k": {"l": 1}}}}}
    df = spark.createDataFrame([(1, json.dumps(doc))], "id int, j string").select("id", F.parse_json("j").alias("doc"))
    found = {r.path: r.value for r in formatting.flatten(df, ["id"]).collect()}
    assert found == {"a.b": "1", "a.c.0": "10", "a.c.1.d": "x", "g": "t", "h.i.j.k": '{"l":1}'}


def test_progress_shapes(spark):
    lines = spark.createDataFrame([('["rs0", 5]',), ('[["rs1", 7], ["rs2", 8]]',), ("",), ("{broken",), (None,)], "progress string")
    assert sorted(map(tuple, checkpoints.from_json(lines).collect())) == [("rs0", 5), ("rs1", 7), ("rs2", 8)]
    single = spark.createDataFrame([("rs0", 5)], "replset string, ts long")
    assert checkpoints.to_json(single).first().progress == '["rs0", 5]'


def test_empty_target_needs_no_rollback(spark):
    from tidelog.operators.replay import STATE_SCHEMA

    empty = spark.createDataFrame([], STATE_SCHEMA)
    log = spark.createDataFrame([(1, "u")], "ts long, op string")
    assert reconcile.last_doc(empty).count() == 0
    assert reconcile.rollback_cutoff(log, empty).first().cutoff is None
    assert reconcile.reconcile(empty, log, empty)["state"].count() == 0


def test_fail_fast(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    good, bad = targets.split_valid(df, F.col("x") > 1)
    assert good.count() == bad.count() == 1
    with pytest.raises(Exception, match="can't be written"):
        targets.split_valid(df, F.col("x") > 1, fail_fast=True)[0].collect()


def test_strict_databases(spark):
    mapped = spark.createDataFrame([("a.x", "t.x"), ("b.y", "t.y")], "ns string, dest string")
    assert routing.conflicts(mapped).count() == 0 and routing.conflicts(mapped, strict_db=True).count() == 1


def test_a_failing_target_does_not_stop_others(spark):
    class Fails:
        name = "fails"

        def apply(self, log, batch_id):
            raise OSError("no disk")

    class Counts:
        name = "counts"
        n = 0

        def apply(self, log, batch_id):
            self.n = log.count()

    counts = Counts()
    outcome = targets.fan_out(spark.range(3), [Fails(), counts], 0)
    assert counts.n == 3 and outcome == [("fails", "OSError: no disk"), ("counts", None)]


def test_list_style_rules():
    rules = routing.rules_of_lists(include=("a.b", "a.c"), exclude=("a.d*",), mapping={"a.b": "x.b"}, gridfs=("a.fs",), include_fields=("f",))
    assert [(r.source, r.target, r.gridfs) for r in rules.included] == [("a.b", "x.b", False), ("a.c", "a.c", False), ("a.fs", "a.fs", True)]
    assert rules.fields(rules.included[0]) == (["_id", "f"], [])
