"""Routing without regular expressions: the same names, and a plan that has none."""

import re

import pytest
from pyspark.sql import functions as F

from tidelog.functions.scalars import ns_coll, ns_db
from tidelog.operators import predicates
from tidelog.operators.routing import matches, ns_regex, renamed
from tidelog.plans.replicate import RULES
from tidelog.sources.change_log import change_log

NAMES = ["", ".", "a", "a.", ".b", "a.b", "a.b.c", "a.bb", "a.bxb", "a.b\nb", "ab.b", "a.é𝄞b", "aXb.c", "a.b.files", "a..files", ".files", "files", "a.b.files.files", None]


@pytest.mark.parametrize("source, dest", [("a.*", "t.*"), ("a.b*", "t.x*y"), ("a.*b", "t.*"), ("a.b*b", "*.t"), ("*.b", "t*.b"), ("a*.c", "x*.c"), ("a*", "t*"), ("a.b", "t.u")])
def test_same_names_as_the_expression(spark, source, dest):
    df = spark.createDataFrame([(n,) for n in NAMES], "ns string")
    ns = F.col("ns")
    found = [tuple(r) for r in df.select("ns", matches(ns, source).alias("hit"), F.when(matches(ns, source), renamed(ns, source, dest)).alias("to")).collect()]
    pattern = re.compile("(?s)" + ns_regex(source).replace(r"\z", r"\Z"))
    for name, hit, to in found:
        fits = None if name is None else pattern.match(name)
        assert hit == (None if name is None else bool(fits)), name
        assert to == (dest.replace("*", fits[1]) if fits and "*" in dest else dest if fits else None), name


def test_same_parts_as_before(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "ns string")
    split = F.split("ns", r"\.", 2)
    both = df.select(
        ns_db(F.col("ns")).eqNullSafe(split[0]).alias("db"), ns_coll(F.col("ns")).eqNullSafe(F.get(split, F.lit(1))).alias("coll"),
        predicates.data_ns().eqNullSafe(F.regexp_replace("ns", r"\.files\z", "")).alias("data"),
    )
    assert all(all(r) for r in both.collect())


def test_entry_path_has_no_expressions(spark, sf_dir):
    """They took more than half of the time of a batch that goes through rules."""
    plan = predicates.prepare(change_log(spark, sf_dir), RULES)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("RLIKE", "regexp_replace", "regexp_extract", "split(") if w in plan]
