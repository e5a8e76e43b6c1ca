"""Cross-tokenizer alignment against a brute-force version on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidelog.llm import alignment, queries

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies(*PATHS)


def brute_groups(v, text):
    """Groups of (a ids, b ids) of a whole text, encoded in one go; none where bytes differ."""
    if not text:
        return []
    a = v.a.encode(" " + text, add_special_tokens=False).ids
    b = v.b.encode(text)
    ends = []
    for ids, table in ((a, v.a_bytes), (b, v.b_bytes)):
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return []
        at, own = 0, []
        for i in ids:
            at += len(table[i])
            own.append(at)
        ends.append(own)
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def brute(v, rows):
    groups = [brute_groups(v, text) for _, text in rows]
    links = [Counter((x, y) for xs, ys in own for x in xs for y in ys) for own in groups]
    docs = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), own, linked in zip(rows, groups, links):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in own)
        best = sum(n for (x, y), n in linked.items() if docs[x, y] == most[x])
        total = sum(n * docs[pair] for pair, n in linked.items())
        sizes = (sum(len(xs) for xs, _ in own), sum(len(ys) for _, ys in own), len(own), sum(linked.values()))
        out.append((doc_id, *sizes, best, total, hashlib.sha256(text.encode()).hexdigest() if own else ""))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "  two  spaces  ", "tab\tand\r\nline\n\n  end", "\r\r\n x", "no break　space   x", "é  é", "x▁y", "▁",
    "<|endoftext|> and </s><s> <0x41>", "漢字かな交じり文 と 空白", "😀😀 👩‍👩‍👧", "don't can't 'll", "é combining ́ alone", "a" * 500, "12345 67 -- ... !!", "\x00\x01 \x1c\x1d \x7f", "\x85 x \x0b\x0c y",
]


def test_split(vocabularies):
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 40)
        a, b = (sorted({n, *(k for k in range(1, n) if rng.random() < rng.choice((0.2, 0.6)))}) for _ in "ab")
        found = alignment.split_groups(np.array(a), np.array(b), np.array([len(a)]), np.array([len(b)]))
        cuts = sorted(set(a) & set(b))
        assert [a[g[1] - 1] for g in found.tolist()] == cuts == [b[g[3] - 1] for g in found.tolist()]
        assert found[0, 0] == found[0, 2] == 0 and (found[1:, 0] == found[:-1, 1]).all() and (found[1:, 2] == found[:-1, 3]).all()


def test_large_groups(spark, vocabularies):
    """Long stretches without shared ends: distinct ids are paired once, with the product of their counts."""
    known = alignment.Aligned(vocabularies)
    xs, ys = np.array([1, 2, 1, 3] * 9), np.array([5, 6, 5] * 9)
    known._link(np.append(xs, 4), np.append(ys, 4), np.array([[0, 36, 0, 27], [36, 37, 27, 28]]), np.array([0, 1]), 2)
    known.pairs.settle(), known.links.settle()
    (pairs, _), (links, _) = known.pairs.take(np.array([0])), known.links.take(np.array([0]))
    assert {(p // alignment.SPREAD, p % alignment.SPREAD): n for p, n in zip(pairs.tolist(), links.tolist())} == Counter((x, y) for x in xs.tolist() for y in ys.tolist())


def test_odd_texts(spark, vocabularies):
    rng = random.Random(3)
    alphabet = [" ", "\n", "\t", "\r", "a", "b", "é", "1", ".", "'", " ", "漢", "s", " ", "\x1c"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "a null key"), (1, "twice"), (1, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pairs", F.lit("x")).withColumn("_row", F.lit("x")).repartition(3)
    want = brute(vocabularies, rows)
    for most in (alignment.HOT_PAIRS, 40, 0):
        assert rows_of(alignment.alignment_report(df, *PATHS, most=most)) == want
    assert alignment.alignment_report(df.where("false"), *PATHS).count() == 0


def test_query(spark, sf_dir, docs, vocabularies):
    assert rows_of(queries.op11_alignment(spark, sf_dir)) == brute(vocabularies, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_odd_docs(odd_docs, vocabularies):
    want = brute(vocabularies, [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()])
    assert rows_of(alignment.alignment_report(odd_docs, *PATHS)) == want


def test_pieces_end_at_blanks(vocabularies):
    """What the cuts rest on: no piece goes on over a space behind something else, or holds a line feed."""
    pieces = [vocabularies.b.id_to_piece(k) for k in range(vocabularies.b.get_piece_size())]
    assert not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
