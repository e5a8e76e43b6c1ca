"""URL filter, WARC archives, SimHash, sharding, mixing, media, and the pipeline."""

import hashlib
import os
import random
import re
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import assert_same, database
from tidelog.llm import components, media, mixing, queries, sharding, simhash, url_filter, warc


def brute_rule(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


ODD_URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/71?x#y", "x://y://z/en/", "http://com/en/", "http://acom/en/1", "http://É.example.net/de/8#a", "http://net/de/8", "http://a.org\n/es/1", "http://h.com?/en/", "//x"]


def test_urls(spark, sf_dir, pages):
    odd = spark.createDataFrame([(k, u, None, "x", "y") for k, u in enumerate(ODD_URLS)], "page_id long, url string, html string, host string, words string")
    more = spark.createDataFrame([(None, "http://" + "ab" * 4000 + ".com/fr/" + "1/" * 1000, "<p>ab ab", None, None)], odd.schema)
    for df in (pages, odd.unionByName(more).unionByName(more), odd.where("false")):
        rows = url_filter.judge_urls(df).collect()
        want = sorted((brute_rule(r.url) for r in df.collect()), key=repr)
        assert sorted(((r.host, r.path, r.rule, r.rule and r.verdict) for r in rows), key=repr) == want
        assert all(r.verdict in ("allow", "block") for r in rows)
    assert url_filter.url_report(odd).count() == len(ODD_URLS)


def test_segmentation(spark):
    counts = spark.createDataFrame([("cheap", 50), ("pills", 40), ("pill", 5), ("heap", 9), ("the", 900), ("a", 100)], "word string, n long")
    labels = spark.createDataFrame([("cheappills",), ("zzqcheap",), ("the",)], "label string")
    found = {r.label: list(r.words) for r in url_filter.segment_labels(labels, counts).collect()}
    assert found["cheappills"] == ["cheap", "pills"] and found["zzqcheap"] == ["zzq", "cheap"] and found["the"] == ["the"]


def test_viterbi_is_the_best_split():
    import itertools
    import math

    rng = random.Random(2)
    for _ in range(50):
        label = "".join(rng.choice("ab") for _ in range(8))
        known = {(s, n): math.log(rng.random() / 10) for s in range(8) for n in range(1, 9 - s) if rng.random() < 0.3}
        cost = lambda s, n: known.get((s, n), math.log(10 / 1000) - n * math.log(10))  # noqa: B023, E731
        best = max(sum(cost(a, b - a) for a, b in zip((0, *cuts), (*cuts, 8))) for k in range(8) for cuts in itertools.combinations(range(1, 8), k))
        words, at, total = url_filter.viterbi(label, known, 1000), 0, 0.0
        for w in words:
            total += cost(at, len(w))
            at += len(w)
        assert "".join(words) == label and abs(total - best) < 1e-9


def test_naive_bayes_learns_from_rules(spark):
    rows = [(k, f"http://{'cheappills' if k % 2 else 'goodnews'}.example.com/{'en/1' if k % 2 else 'en/7'}", "<p>cheap pills good news</p>") for k in range(40)]
    rows += [(100, "http://cheappills.example.io/fr", ""), (101, "http://goodnews.example.io/fr", "")]
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[100] == "block" and found[101] == "allow"


def test_warc_query(spark, sf_dir):
    assert_same(queries.op2_warc(spark, sf_dir).toPandas(), database(sf_dir).sql(queries.oracle_sql()["op2_warc"]).df())


def test_warc_cases(spark):
    big, long_ = "é" * 60, "x" * 300_000
    rows = [(5, "u", big), (3, "u\r\nX: y", big), (9, None, big), (None, "u", big), (1, "u", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""), (7, "u", long_), (8, "u", long_), (8, "u", long_), (10, "u", "a\r\n\r\nb" * 30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("kind", F.lit(1)).withColumn("digest", F.lit(2))
    path = tempfile.mkdtemp() + "/w"
    manifest = warc.write_archives(df, path)
    found = warc.read_archives(manifest, path, with_payload=True).collect()
    assert len(found) == len(rows) == sum(r.records for r in manifest.collect())
    texts = {(r[0] and str(r[0])): (r[2] or "").encode() for r in rows}
    for r in found:
        want = texts[r.key]
        assert r.payload_bytes == len(want) and r.payload_digest == hashlib.sha256(want).hexdigest()
        assert bytes(r.payload) == (want if r.record_type == "response" else b"")
    assert sorted((r.key or "-", r.refers_to) for r in found if r.record_type == "revisit") == [("-", "3"), ("5", "3"), ("8", "7"), ("8", "7"), ("9", "3")]
    empty = tempfile.mkdtemp() + "/w"
    assert warc.read_archives(warc.write_archives(df.where("false"), empty), empty).count() == 0


def test_warc_is_gzip_by_member_and_verified():
    import gzip

    one = warc.member(warc.record("response", "u", "1", b"abc", 3, hashlib.sha256(b"abc").hexdigest(), None))
    two = warc.member(warc.record("revisit", "u", "2", b"", 3, "d", "1"))
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\n")
    for size in (1, 7, 10_000):
        data = one + two
        parts = list(warc.members(data[i : i + size] for i in range(0, len(data), size)))
        assert [warc.parse(p)[0]["WARC-Type"] for p in parts] == ["response", "revisit"]
    with pytest.raises(ValueError):
        list(warc.members(iter([(one + two)[:-9]])))
    with pytest.raises(ValueError):
        warc.parse(gzip.decompress(one).replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_groups(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for (k, _), p in zip(rows, prints):
        if k is not None:
            least[find(p)] = min(k, least.get(find(p), k))
    return [(k, f"{p:016x}", least.get(find(p))) for (k, _), p in zip(rows, prints)]


def test_simhash(spark, docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert sorted(map(tuple, simhash.simhash_report(df).collect()), key=repr) == sorted(brute_groups(rows), key=repr)
    assert simhash.simhash_report(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted([1, 0, 0, 3, 5, 7, 8, 9, 6])


@pytest.mark.parametrize("parts", [2, 3, 4, None])
def test_links_lose_none(spark, parts):
    rng = random.Random(parts)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:60]:
        for _ in range(4):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 3)):
                q ^= 1 << b
            prints.add(q)
    prints = np.array(sorted(prints), dtype=np.uint64)
    signed = prints.view(np.int64).tolist()
    want = {(max(signed[i], signed[j]), min(signed[i], signed[j])) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 2)}
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), parts=parts)
    assert {tuple(r) for r in found.collect()} == want


def test_allocation_adds_up_and_is_cheapest():
    import itertools

    rng = np.random.default_rng(1)
    costs = [np.sort(rng.random((3, 20)), axis=0) for _ in range(3)]
    found = simhash.allocate(costs, 2)
    assert (found.sum(axis=1) == 2 - 3 + 1).all()
    own = lambda ts, k: sum(c[t, k] for c, t in zip(costs, ts) if t >= 0)
    for k in range(20):
        best = min(own(ts, k) for ts in itertools.product(range(-1, 3), repeat=3) if sum(ts) == 0)
        assert abs(own(found[k], k) - best) < 1e-12


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[k] == 1 for k in range(1, 41)) and all(found[k] == 100 for k in range(100, 150)) and found[201] == found[200] == 200
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sharding(spark, sf_dir, docs, odd_docs, no_docs):
    duck = database(sf_dir)
    for limit in (20_000, 3_000, 64 << 20):
        found = sharding.shard(docs.select("doc_id", "text"), limit_bytes=limit).drop("text")
        assert_same(found.toPandas(), duck.sql(sharding.oracle(limit)).df())
    rows = sharding.shard(docs, limit_bytes=20_000).groupBy("shard").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.max("shard_bytes").alias("sb"), F.max("oversized").alias("o")).collect()
    assert sum(r.n for r in rows) == docs.count() and all(r.b == r.sb and (r.o or r.b <= 20_000) and (not r.o or r.n == 1) for r in rows)
    odd = sharding.shard(odd_docs, limit_bytes=100)
    assert odd.count() == odd_docs.count() and odd.where("oversized and shard_depth < 60").count() == 0
    assert sharding.shard_report(no_docs).count() == 0
    plan = sharding.shard(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mixing(spark, docs, odd_docs, no_docs):
    rows = mixing.mix(docs, {f"src{k}": 1.0 + k % 4 for k in range(20)}, block_rows=4).collect()
    assert sorted(r.mix_position for r in rows) == list(range(len(rows)))
    odd = mixing.mix(odd_docs, block_rows=1).collect()
    assert sorted(r.mix_position for r in odd) == list(range(odd_docs.count()))
    assert mixing.mix_report(no_docs).count() == 0
    ordered = mixing.in_order(mixing.mix(docs), docs.count())
    assert [r.mix_position for r in ordered.select("mix_position").collect()] == list(range(docs.count()))


def test_schedule_stays_within_one_block():
    rng = random.Random(4)
    for _ in range(20):
        n = rng.randint(1, 8)
        weights, blocks = [rng.random() + 0.01 for _ in range(n)], [rng.randint(0, 60) for _ in range(n)]
        points, total = mixing.served_time(weights, blocks)
        order = list(mixing.schedule(weights, blocks))
        assert len(order) == len(set(order)) == sum(blocks)
        v, t = zip(*points)
        had = [0] * n
        for slot, (i, k) in enumerate(order, 1):
            assert k == had[i]
            had[i] += 1
            now = np.interp(slot, t, v)
            assert max(abs(min(w * now, b) - h) for w, b, h in zip(weights, blocks, had)) < 1 + 1e-6


def test_media(spark, docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        stored = media.encode_media(df)
        found = media.decode_media(stored).drop("clips").collect()
        want = []
        for r in df.select("doc_id", "text").collect():
            data = (r.text or "").encode()
            padded = data + b"\xff" * ((-len(data)) % 576 if data else 576)
            want.append((r.doc_id, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:])))
        assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(want, key=repr)
        files = {r.doc_id: bytes(r.media) for r in stored.collect()}
        assert all(r.media_sha256 == hashlib.sha256(files[r.doc_id]).hexdigest() for r in found if r.doc_id not in (None, 2))
    assert media.decode_media(media.encode_media(no_docs)).count() == 0
    clips = media.clip_rows(media.decode_media(media.encode_media(docs)))
    assert clips.groupBy("doc_id").agg(F.min("first_frame").alias("a")).where("a <> 0").count() == 0


def test_avi_is_lossless_and_framed():
    for data in (b"", b"a", bytes(range(256)) * 9, os.urandom(576 * 5), b"\xff" * 5000, b"\x00\xff" * 3000):
        payload = media.pad_payload(data)
        stored = media.encode_avi(payload)
        assert media.decode_avi(stored).tobytes() == payload and len(payload) % 576 == 0 and payload.startswith(data)
        names = [name for name, *_ in media.riff_chunks(stored, 12, len(stored))]
        assert names == [b"hdrl", b"movi", b"idx1"] and stored.startswith(b"RIFF")


def slow_jpeg(data):
    """A plain bit-by-bit decoder of a lossless JPEG frame, from its own tables."""
    at, lengths = 2, None
    while True:
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        if marker == 0xC4:
            lengths, values = body[1:17], body[17:]
        if marker == 0xC3:
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
        at += 2 + size
        if marker == 0xDA:
            break
    bits = "".join(f"{b:08b}" for b in data[at:-2].replace(b"\xff\x00", b"\xff"))
    codes, code, k = {}, 0, 0
    for n in range(1, 17):
        for _ in range(lengths[n - 1]):
            codes[f"{code:0{n}b}"] = values[k]
            code, k = code + 1, k + 1
        code <<= 1
    out, p = np.zeros((height, width), int), 0
    for y in range(height):
        for x in range(width):
            n = 1
            while bits[p : p + n] not in codes:
                n += 1
            s, p = codes[bits[p : p + n]], p + n
            extra = int(bits[p : p + s] or "0", 2)
            p += s
            d = extra if not s or extra >> (s - 1) else extra - (1 << s) + 1
            out[y, x] = (out[y, x - 1] if x else out[y - 1, 0] if y else 128) + d
    return out & 0xFFFF


def test_frames_are_standard_lossless_jpeg():
    samples = np.frombuffer(os.urandom(576 * 2), np.uint8).reshape(2, 24, 24)
    for frame, want in zip(media._encode_block(samples), samples):
        assert (slow_jpeg(frame) == want).all()


def test_shots():
    rng = np.random.default_rng(0)
    dark, light = rng.integers(0, 40, (30, 24, 24)), rng.integers(200, 255, (20, 24, 24))
    first, _ = media.find_shots(np.concatenate([dark, light, dark]).astype(np.uint8))
    assert first.tolist() == [0, 30, 50]


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_tables(spark, sf_dir, odd_docs, no_docs, stage):
    name, function = corpus_pipeline.STAGES[stage]
    out = function(spark, odd_docs, sf_dir)
    assert set(docs_columns := odd_docs.columns) - {"shard"} <= set(out.columns) and out.count() <= odd_docs.count()
    if stage < 4:
        assert out.columns == docs_columns
    assert function(spark, no_docs, sf_dir).count() == 0
