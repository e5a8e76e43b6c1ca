"""Periodic runs against a brute-force version that tries every period at every place."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import periodic_runs, queries


def brute_runs(words, least=24, periods=3):
    """Every stretch whose words p apart are equal, kept if p is its smallest period and it is long enough."""
    n, out = len(words), set()
    for p in range(1, n // periods + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least, periods * p):
                own = words[i : i + length]
                if not any(own[q:] == own[:-q] for q in range(1, p)):
                    out.add((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, n_, p in runs for i in range(s + p, s + n_)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    shown = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *shown, digest("".join(f"{s},{n_},{p}\n" for s, n_, p in runs)), digest(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("seed", range(60))
def test_runs(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = []
        while len(words) < rng.randrange(1, 160):
            unit = [rng.choice("abc"[: rng.randrange(1, 4)]) for _ in range(rng.randrange(1, 14))]
            words += unit * rng.randrange(1, 9)
        texts.append([w.encode() for w in words])
    found = periodic_runs.find_all(texts, least_words=6)
    assert [list(map(tuple, runs)) for runs in found] == [brute_runs(words, 6) for words in texts]


def test_two_copies_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.runs_of([1, 1], least_periods=2)


def test_query(spark, sf_dir, docs):
    found = queries.op13_runs(spark, sf_dir).select(*COLUMNS).collect()
    rows = docs.select("doc_id", "text").collect()
    short = {r.doc_id for r in rows if len((r.text or "").split()) < 700}
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in rows)
    own = {r.doc_id: tuple(r) for r in found}
    assert {d: own[d] for d in short} == {r.doc_id: brute_row(*r) for r in rows if r.doc_id in short}
    assert any(own[d][1] for d in short)


def test_odd_rows(odd_docs, no_docs):
    found = periodic_runs.run_report(odd_docs)
    rows = odd_docs.select("doc_id", "text").collect()
    want = [brute_row(*r) for r in rows if len(r.text or "") < 10_000]
    assert sorted((tuple(r) for r in found.where("doc_id is null or doc_id <> 5").collect()), key=repr) == sorted(want, key=repr)
    long_ = found.where("doc_id = 5").first()
    assert (long_.n_runs, long_.start, long_.length, long_.period, long_.exponent_milli) == (1, 0, 60_000, 1, 60_000_000)
    assert periodic_runs.run_report(no_docs).count() == 0
    assert periodic_runs.collapse(odd_docs).where("doc_id = 5").select("text", "words").first() == ("word", "x")
    assert periodic_runs.collapse(odd_docs).where(F.col("text").isNull()).count() == odd_docs.where(F.col("text").isNull()).count()
