"""The pipeline's near-duplicates against exact Jaccard similarities of all pairs."""

import random

import corpus_pipeline
from tidelog.llm import near_copies


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(rows):
    own = {k: shingles(t) for k, t in rows}
    keys = sorted(own)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(own[a] & own[b])
            if own[a] == own[b] or 9 * common >= 4 * (len(own[a]) + len(own[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [k for k in keys if find(k) == k]


def test_near_copies_of_five_words_go(spark, sf_dir):
    rng = random.Random(11)
    rows = []
    for _ in range(25):
        words = [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(rng.choice((4, 30, 120, 400)))]
        rows.append(words)
        for share in (0, 0.01, 0.02, 0.03, 0.06, 0.1):
            copy = list(words)
            for at in rng.sample(range(len(copy)), int(share * len(copy))):
                copy[at] = "edited"
            rows.append(copy)
    rng.shuffle(rows)
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)] + [(900, ""), (901, None), (902, " \n"), (903, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, sf_dir).collect())
    assert kept == brute_kept(rows)


def test_near_copies_of_documents(spark, sf_dir, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect())
    assert kept == brute_kept(rows)


def test_bands_meet_at_the_limit():
    rng = random.Random(3)
    met = 0
    for _ in range(300):
        words = [str(rng.randrange(10**9)) for _ in range(204)]
        cut = words[:182]
        a, b = (near_copies.shingle_set(" ".join(w)) for w in (words, cut + [str(rng.randrange(10**9)) for _ in range(22)]))
        common = len(set(a.tolist()) & set(b.tolist()))
        assert 0.79 < common / (len(a) + len(b) - common) < 0.81
        met += bool((near_copies.bands_of(a) == near_copies.bands_of(b)).any())
    assert met >= 298
