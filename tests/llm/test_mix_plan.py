"""The plan of the mix: cycles, periods in which sources run out, and the query's positions."""

import random

import numpy as np
import pytest

from tidelog.llm import mixing


def order(plan, rows, block_rows):
    """(source, block, row) of all slots, from the phases."""
    out = []
    for phase in plan:
        first, own = dict(zip(phase.sources, phase.firsts)), dict(zip(phase.sources, phase.parts))
        period = list(mixing.places(phase, rows, block_rows))
        for r in range(phase.repeats):
            out += [(i, first[i] + r * own[i] + k, phase.row + r * sum(phase.parts) * block_rows + at) for i, k, at in period]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_every_source_stays_within_one_block(monkeypatch, seed):
    """Over cycles and the periods between them; the shares are those of the period's whole parts."""
    monkeypatch.setattr(mixing, "PERIOD", 40)
    rng = random.Random(seed)
    n, block = rng.randint(1, 7), rng.choice((1, 3))
    rows, weights = [rng.randint(0, 900) for _ in range(n)], [rng.choice((0.0, rng.random() + 0.02)) for _ in range(n)]
    plan = mixing.phases(weights, rows, block)
    found = order(plan, rows, block)
    assert sorted((i, k) for i, k, _ in found) == [(i, k) for i in range(n) for k in range(-(-rows[i] // block))]
    at = 0
    for i, k, row in found:
        assert row == at
        at += min(block, rows[i] - k * block)
    assert at == sum(rows)
    slot = 0
    for phase in plan:
        points, total = mixing.served_time([float(p) for p in phase.parts], phase.caps)
        v, t = zip(*points)
        had = dict.fromkeys(phase.sources, 0)
        for s in range(sum(phase.caps) * phase.repeats):
            had[found[slot + s][0]] += 1
            whole, rest = divmod(s + 1, sum(phase.caps))
            now = np.interp(rest, t, v)
            for i, p, cap in zip(phase.sources, phase.parts, phase.caps):
                assert abs(whole * cap + min(p * now, cap) - had[i]) < 1 + 1e-6
        slot += sum(phase.caps) * phase.repeats
    assert any(p.repeats > 1 for p in plan) or max(rows) < 900


def brute_positions(rows, block_rows, weights=None):
    """(doc_id, source) to (block, position), in plain Python from the rules of the module."""
    import hashlib

    by = {}
    for key, source in rows:
        by.setdefault(source, []).append(key)
    names = sorted(by, key=lambda s: (s is None, str(s)))
    for own in by.values():
        own.sort(key=lambda k: int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16))
    given = [weights.get(s, 1.0) if weights else (len(by[s]) / len(rows)) ** 0.5 for s in names]
    out, at, left = {}, 0, {s: -(-len(by[s]) // block_rows) for s in names}
    had = dict.fromkeys(names, 0)
    while any(left.values()):
        some = [i for i, s in enumerate(names) if left[s]]
        some = [i for i in some if given[i]] or some
        total, period = sum(given[i] for i in some), max(mixing.PERIOD, mixing.PERIOD_PARTS * len(some))
        parts = [max(1, round(given[i] / total * period)) if total else 1 for i in some]
        caps = [min(p, left[names[i]] if left[names[i]] <= p else p) for i, p in zip(some, parts)]
        for j, k in mixing.schedule([float(p) for p in parts], caps):
            s = names[some[j]]
            for r, key in enumerate(by[s][had[s] * block_rows : (had[s] + 1) * block_rows]):
                out[key, s] = (had[s], at)
                at += 1
            had[s] += 1
            left[s] -= 1
    return out


@pytest.mark.parametrize("period", [4096, 16])
def test_positions_of_the_query(spark, docs, monkeypatch, period):
    """Period by period; with the short one, cycles repeat."""
    monkeypatch.setattr(mixing, "PERIOD", period)
    monkeypatch.setattr(mixing, "PERIOD_PARTS", 1)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 30)
    few = docs.select("doc_id", "text", "source")
    for weights in (None, {"src0": 3.0, "web": 0.0}):
        found = {(r.doc_id, r.source): (r.mix_block, r.mix_position) for r in mixing.mix(few, weights, block_rows=2).collect()}
        assert found == brute_positions([(r.doc_id, r.source) for r in few.collect()], 2, weights)


def test_weights_that_are_none(docs):
    for bad in (-1.0, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing.mix(docs, {"a": bad})
