"""Decontamination of short and of edited items."""

import random

import pytest

from tidelog.llm import decontaminate


@pytest.mark.parametrize("size", [*range(5, 25), 40, 97])
def test_every_edited_item_is_found(size):
    """At the allowed distance, whatever words are edited; the first and the rarest ones too."""
    rng = random.Random(size)
    items = [[f"w{rng.randrange(400)}" for _ in range(size)] for _ in range(60)]
    finder = decontaminate.Finder(list(range(len(items))), items)
    most = size // 5
    texts, wanted = [], []
    for k, item in enumerate(items):
        for first in range(most and 6):
            own = list(item)
            for at in sorted({first, *rng.sample(range(size), most - 1)}, reverse=True)[:most] if most > 1 else [first % size]:
                own[at : at + 1] = rng.choice((["zzz"], []))
            texts.append(" ".join(["before"] * rng.randrange(9) + own + ["after"] * rng.randrange(9)))
            wanted.append(k)
    hits = finder.search(texts)
    assert texts and all(any(h[0] == k for h in own) for own, k in zip(hits, wanted))


def test_common_starts_don_t_hide_items():
    """Many items with one beginning; only the one whose words follow is a hit."""
    items = [["which", "of", "the", "following", f"a{k}", f"b{k}", f"c{k}"] for k in range(3000)]
    finder = decontaminate.Finder(list(range(len(items))), items)
    found = finder.search(["which of the following a7 x c7", "which of the following is", "x b9 c9", None, ""])
    assert [[h[:2] for h in own] for own in found] == [[(7, 1)], [], [], [], []]


def test_short_items_are_met_exactly(spark):
    items = spark.createDataFrame([(1, "one two"), (2, "Quartz"), (3, "a b c d"), (4, "..."), (5, None)], "item_id long, text string")
    texts = ["x One, two y", "one x two", "of quartz.", "quartzes", "a b c d", "a b x d", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(tuple(r) for r in decontaminate.find_leaks(df, items).collect())
    assert found == [(0, 1, 0, 1, 3), (2, 2, 0, 1, 2), (4, 3, 0, 0, 4)]
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(df, items).collect()) == [1, 3, 5, 6, 7]


@pytest.mark.parametrize("item, edited, other", [
    ("中国的首都是哪一座城市请选择正确答案", "据说中国的首都是哪一坐城市请选择正确答案吗", "今天天气很好我们去公园散步吧然后回家吃饭"),
    ("日本でいちばん高い山はどれですか", "さて日本でいちばん高い川はどれですかね", "きのうは友だちと映画を見に行きました"),
    ("เมืองหลวงของประเทศไทยคือเมืองใด", "ถามว่าเมืองหลวงของประเทศไทยคือเมืองไดครับ", "วันนี้อากาศดีมากเราไปเดินเล่นกัน"),
])
def test_scripts_without_spaces(item, edited, other):
    finder = decontaminate.Finder([1], [decontaminate.words_of(item)])
    assert [[h[0] for h in own] for own in finder.search([item, edited, other, f"abc{item}123"])] == [[1], [1], [], [1]]


def test_words_of_mixed_scripts():
    assert decontaminate.words_of("GPT4模型 über 10年, naïve_x") == ["gpt4", "模", "型", "über", "10", "年", "naïve_x"]


@pytest.mark.parametrize("size", [5, 8, 10, 15, 20, 30, 60])
def test_recall_by_place_of_the_edits(size):
    """Copies at the allowed distance with edits at random places, evenly spaced, in the first and in the last words."""
    rng = random.Random(size + 1000)
    items = [[f"w{rng.randrange(400)}" for _ in range(size)] for _ in range(200)]
    finder, most = decontaminate.Finder(list(range(len(items))), items), size // 5
    for places in (rng.sample(range(size), most), [i * size // most for i in range(most)], range(most), range(size - most, size)):
        texts = []
        for item in items:
            own = list(item)
            for at in sorted(places, reverse=True):
                own[at : at + 1] = rng.choice((["zzz"], [], [own[at], f"w{rng.randrange(400)}"]))
            texts.append(" ".join([f"w{rng.randrange(400)}" for _ in range(rng.randrange(9))] + own + ["after"] * rng.randrange(9)))
        found = sum(any(h[0] == k for h in own) for k, own in enumerate(finder.search(texts)))
        assert found >= 0.99 * len(items)


def test_keys_of_other_types(spark):
    items = spark.createDataFrame([(1.5, "one two three four five six")], "item_id double, text string")
    df = spark.createDataFrame([("a", "x one two three four nine six y")], "doc_id string, text string")
    assert [tuple(r)[:3] for r in decontaminate.find_leaks(df, items).collect()] == [("a", 1.5, 1)]


def test_all_texts_against_all_items(spark, sf_dir, docs):
    """A tenth of the documents, and edited items in other words, against every item by plain edit distance, none left out beforehand."""
    from tests.llm.test_text_scans import edit_distance_within

    rng = random.Random(9)
    items = [(r.item_id, decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()][::10]
    texts = [r.text for r in docs.orderBy("doc_id").collect() if r.text and len(r.text) < 800][::10]
    for _, words in items:
        own = list(words)
        for at in rng.sample(range(len(own)), len(own) // 5):
            own[at] = "other"
        texts.append(" ".join(own))
    hits = decontaminate.Finder([k for k, _ in items], [w for _, w in items]).search(texts)
    for text, own in zip(texts, hits):
        words = decontaminate.words_of(text)
        want = {k: n for k, item in items if (n := edit_distance_within(item, words)) <= len(item) // 5}
        assert {h[0]: h[1] for h in own} == want
