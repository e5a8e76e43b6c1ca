"""Licences wrapped over lines of longer texts, and what the keyword test may not lose."""

import random
import textwrap

from tests.compare import assert_same
from tidelog.llm import license_scan


def test_wrapped_notices_in_long_texts(spark):
    rng = random.Random(1)
    code = "\n".join(f"value_{k} = compute(value_{k - 1}, {rng.randrange(99)})" for k in range(200))
    rows, want = [], []
    for k, (name, text) in enumerate(license_scan.TEMPLATES):
        if len(license_scan.template_words(text)) < license_scan.LONG:
            continue
        for width in (40, 76):
            header = "\n".join(f" * {line}" for line in textwrap.wrap(text, width))
            for before in ("", "# Copyright 2020 Somebody\n", code[: rng.randrange(3000)] + "\n"):
                rows.append((len(rows), before + header + "\n" + code))
                want.append(name)
    found = {r.doc_id: r for r in license_scan.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[k].license for k in range(len(rows))] == want and all(found[k].license_dice > 0.9 for k in found)


def test_windows_as_in_sql(spark):
    import duckdb

    rng = random.Random(2)
    rows = []
    for k in range(60):
        words = rng.choice(license_scan.TEMPLATES)[1].split()
        for _ in range(rng.randrange(1 + len(words) // 5)):
            words[rng.randrange(len(words))] = rng.choice(("other", "word", "the"))
        rows.append((k, "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9)) + "\nand more text\n" * rng.randrange(30)))
    pandas = spark.createDataFrame(rows, "doc_id long, text string")
    db = duckdb.connect()
    db.register("documents", pandas.toPandas())
    assert_same(license_scan.license_report(pandas).toPandas(), db.sql(license_scan.oracle()).df())


def test_short_creative_commons_forms(spark):
    rows = [(k, f"some words here\nLicensed under CC {kind} 4.0.\nand more") for k, kind in enumerate(license_scan._CC)]
    found = {r.doc_id: r.license for r in license_scan.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[k] for k, _ in rows] == [f"CC-{kind}-4.0" for kind in license_scan._CC]


def test_key_words_can_not_be_missed():
    """What is left of any template without the key words has too few of its bigrams."""
    keys = set(license_scan.key_words(license_scan.TEMPLATES, license_scan.LEAST))
    for _, text in license_scan.TEMPLATES:
        own = license_scan.template_bigrams(text)
        assert sum(not keys & set(b.split()) for b in own) < license_scan.fewest_common(len(own), license_scan.LEAST)


def test_the_plan_is_native(spark, sf_dir):
    from tidelog.llm import queries

    plan = queries.op10_licenses(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
