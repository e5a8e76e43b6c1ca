"""The language model grows with its corpus."""

import random

import numpy as np

from tidelog.llm import language_id


def test_no_4_gram_is_left_out(spark):
    """More than 2**19 distinct 4-grams: all of them are kept, with the counts of one that set the discount."""
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    rows = [("".join(rng.choices(letters, k=6000)), "zh") for _ in range(100)] + [("the cat and the dog", "en")]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    for name, own in zip(model.languages, model.models):
        gram, n = np.unique(language_id.grams([language_id.symbols(t) for t, lang in rows if lang == name]), return_counts=True)
        assert (own.gram == gram).all() and (own.count == n).all()
    assert sum(len(m.gram) for m in model.models) > 1 << 19
    assert model.models[model.languages.index("zh")].orders[0][2] > 0.5


def test_more_than_64_languages(spark):
    rows = [(" ".join(["".join(chr(0x100 + 4 * k + j) for j in range(4))] * 9), f"l{k:02}") for k in range(70)]
    rows = [(t, name) for t, name in rows if language_id.symbols(t).size]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.train(df)
    assert len(model.languages) == len(rows) > 64
    found = language_id.identify(df, model).collect()
    assert sum(r.language.lang_pred == r.lang and r.language.accepted for r in found) >= 0.9 * len(rows)
