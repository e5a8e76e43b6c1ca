"""What token files cost: large blocks with many lanes, words as stretches of their own, learnt once in a process."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests.llm.test_alignment import ODD
from tests.llm.test_token_ids import brute
from tidelog.llm import range_coder, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def encoder():
    return token_ids.Encoder(PATH)


def encoded(encoder, texts):
    ids, bounds = encoder.ids(pa.array(texts, pa.string()))
    return [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])]


def test_one_block_of_many_lanes():
    ids = np.random.default_rng(5).zipf(1.2, 150_001) % 49_408
    (code,) = range_coder.encode(ids.reshape(1, -1), 49_408)
    assert (range_coder.decode([code], len(ids), 49_408)[0] == ids).all()
    split = sum(map(len, range_coder.encode(ids[:147_456].reshape(-1, 4096), 49_408)))
    assert len(code) < split, "lanes learn from each other"


def test_words_end_at_marks(encoder):
    texts = ["eine Größe, (Größe) Größe! eine. é les ñandú; ñandú?", "it's 'tis rock'n'roll x'.s a.'s İx × a×b ÷. é́, é. e.́ <|endoftext|>a <|x|>"]
    assert encoded(encoder, texts) == [encoder.model.encode(t, add_special_tokens=False).ids for t in texts]
    assert {"Größe".encode(), " Größe".encode(), b" les", " ñandú".encode(), b"."} <= set(encoder.memo)
    assert not any("Größe" in s.decode() and s.decode().strip() != "Größe" for s in encoder.memo)


def test_random_mixtures(encoder):
    rng = random.Random(8)
    alphabet = [*"aBcéÉßİΣσ漢1'.,!<|>×÷  ̸́ \n", "<|endoftext|>", "'s", "'LL", " "]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(4000)]
    assert encoded(encoder, texts) == [encoder.model.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_task_that_broke_off(encoder, monkeypatch):
    """What it hadn't learnt yet isn't taken for known by the next task."""
    monkeypatch.setattr(encoder, "learn", lambda stretches: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        encoded(encoder, ["one two"])
    monkeypatch.undo()
    assert encoded(encoder, ["two one", None, ""]) == [encoder.model.encode("two one", add_special_tokens=False).ids, [], []]


def test_writer_encodes(spark, encoder):
    rows = [(k, f"word {k}, and more" if k % 7 else None) for k in range(500)]
    path = token_ids.scratch(spark, "texts")
    token_ids.write_texts(token_ids.in_key_order(spark.createDataFrame(rows, "doc_id long, text string")), path, PATH, 49_408, 2)
    got = [(r.key, r.start, r.n_tokens) for r in token_ids.read_ids(spark, path).orderBy("start").collect()]
    assert got == [r[:3] for r in brute(encoder.model, rows)]
