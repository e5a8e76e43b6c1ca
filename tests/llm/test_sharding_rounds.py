"""Extendible hashing with oversized rows and keys: few rounds, and the shards of a brute-force version."""

import hashlib
import random

import pytest

from tidelog.llm import sharding


def brute(rows, limit):
    """(key, size) -> (depth, bucket): each hash's first prefix whose rows fit, or all bits."""
    hashed = [(int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16), k, n) for k, n in rows]

    def split(own, depth):
        if sum(n for *_, n in own) <= limit or depth == 60:
            return {k: (depth, own[0][0] >> (60 - depth), len(own), sum(n for *_, n in own)) for _, k, _ in own}
        out = {}
        for bit in (0, 1):
            half = [r for r in own if r[0] >> (59 - depth) & 1 == bit]
            out |= split(half, depth + 1) if half else {}
        return out

    return split(hashed, 0)


@pytest.mark.parametrize("seed", range(3))
def test_shards_and_rounds(spark, monkeypatch, seed):
    rng, cuts, cut = random.Random(seed), [], sharding.cut
    monkeypatch.setattr(sharding, "cut", lambda df: cuts.append(1) or cut(df))
    rows = [(k, rng.randrange(1, 90)) for k in range(400)] + [(k, 5000) for k in range(1000, 1000 + 3 * seed + 1)]
    rows += [(7, 60)] * 40 if seed else []
    df = spark.createDataFrame([(k, "x" * n) for k, n in rows], "doc_id long, text string").repartition(3)
    found = sharding.shard(df, limit_bytes=1000).collect()
    assert len(found) == len(rows)
    want = brute(rows, 1000)
    assert {r.doc_id: (r.shard_depth, int(r.shard.split("-")[1], 16), r.shard_rows, r.shard_bytes) for r in found} == want
    assert {r.doc_id for r in found if r.oversized} == {k for k, (*_, n) in want.items() if n > 1000}
    assert len(cuts) <= 10
