"""Language models against a plain Python Kneser-Ney, with and without a bound."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidelog.llm import language_id


class Plain:
    """Interpolated Kneser-Ney over dictionaries; ``least`` is the least count of each order that is kept."""

    def __init__(self, texts, alphabet, share=None):
        counts = Counter()
        for t in texts:
            own = [32, 32, 32, *language_id.symbols(t).tolist(), 32]
            counts.update(tuple(own[i : i + 4]) for i in range(len(own) - 3))
        self.alphabet, self.levels = alphabet, {}
        for order in (4, 3, 2, 1):
            ones, twos = (sum(n == k for n in counts.values()) for k in (1, 2))
            discount = min(0.9, max(0.1, ones / max(ones + 2 * twos, 1)))
            least = 1
            while share is not None and sum(n >= least for n in counts.values()) > share:
                least *= 2
            total, given = Counter(), Counter()
            for g, n in counts.items():
                total[g[:-1]] += n
                given[g[:-1]] += n - discount if n >= least else 0
            self.levels[order] = ({g: n - discount for g, n in counts.items() if n >= least}, total, given)
            below = defaultdict(set)
            for g in counts:
                below[g[1:]].add(g[0])
            counts = Counter({g: len(before) for g, before in below.items()})

    def probability(self, gram):
        if not gram:
            return 1 / self.alphabet
        grams, total, given = self.levels[len(gram)]
        lower = self.probability(gram[1:])
        context = gram[:-1]
        return (grams.get(gram, 0) + (total[context] - given[context]) * lower) / total[context] if total[context] else lower


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.lang) for r in docs.where(~language_id.held_out()).collect()], [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("bound", [None, 3000])
def test_models_and_predictions(spark, docs, rows, bound):
    train, every = rows
    train = [(k, t, lang) for k, t, lang in train if lang is not None and len(language_id.symbols(t))]
    names = sorted({lang for *_, lang in train})
    model = language_id.train(docs.where(~language_id.held_out()).select("text", "lang"), max_ngrams=bound)
    alphabet = len({c for _, t, _ in train for c in language_id.symbols(t).tolist()} | {32}) + 1
    plain = [Plain([t for _, t, own in train if own == name], alphabet, bound and bound // len(names)) for name in names]
    assert model.languages == names
    if bound:
        assert all(len(m.gram) <= bound // len(names) for m in model.models)
    some = [tuple(int(g) >> (16 * k) & 0xFFFF for k in (3, 2, 1, 0)) for g in language_id.grams([language_id.symbols(t) for _, t in every[:20]])][:3000:7]
    query = np.array([sum(c << (16 * k) for c, k in zip(g, (3, 2, 1, 0))) for g in some], np.uint64)
    for m, p in zip(model.models, plain):
        assert np.allclose(m.probability(query), [p.probability(g) for g in some], rtol=1e-9, atol=0)
    found = {r.doc_id: r.language.lang_pred for r in language_id.identify(docs, model).collect()}
    for k, t in every[::9]:
        own = language_id.symbols(t).tolist()
        if own:
            line = [32, 32, 32, *own, 32]
            cross = [-sum(math.log(p.probability(tuple(line[i : i + 4]))) for i in range(len(own) + 1)) / (len(own) + 1) for p in plain]
            assert found[k] == names[int(np.argmin(cross))]


def test_rejection_is_calibrated_on_rows_apart(docs):
    """Clean texts stay below their limit, the same letters in another order don't."""
    model = language_id.train(docs.where(~language_id.held_out()).select("text", "lang"))
    assert np.isfinite(model.limits).all()
    texts = [r.text for r in docs.where(language_id.held_out()).collect() if len(language_id.symbols(r.text)) > 40]
    assert model.predict(texts).accepted.all()
    assert not model.predict([language_id.shuffled(t) for t in texts]).accepted.any()


def test_limits_come_from_all_rows(docs):
    """Each row is judged by the half it isn't in; no row is left out."""
    from pyspark.sql import functions as F

    train = docs.where(~language_id.held_out()).select("text", "lang")
    model = language_id.train(train)
    rows = [(r.text, r.lang, r.half) for r in train.where("lang is not null").withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2))).collect() if len(language_id.symbols(r.text))]
    alphabets = [len({c for t, _, h in rows if h != half for c in language_id.symbols(t).tolist()} | {32}) + 1 for half in (0, 1)]
    for name, limit in zip(model.languages, model.limits):
        own, other = [], []
        for half in (0, 1):
            gram, n = np.unique(language_id.grams([language_id.symbols(t) for t, lang, h in rows if lang == name and h != half]), return_counts=True)
            judge = language_id.LanguageModel([name], [language_id.KneserNey(gram, n, alphabets[half])])
            texts = [t for t, lang, h in rows if lang == name and h == half]
            for found, every in ((own, texts), (other, [language_id.shuffled(t) for t in texts])):
                sizes, cross = judge.entropies(every)
                found += (cross[:, 0] - language_id.SYMBOL_SPREAD / np.sqrt(sizes)).tolist()
        rank = lambda values, share: sorted(values)[max(0, math.ceil(share * len(values)) - 1)]
        least, most = rank(own, language_id.QUANTILE), rank(other, 1 - language_id.QUANTILE)
        assert math.isclose(limit, max(least, (least + most) / 2), rel_tol=1e-4)
