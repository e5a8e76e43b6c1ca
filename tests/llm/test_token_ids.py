"""Token files: exact round trips, ids against whole texts encoded in one go, damaged files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_alignment import ODD
from tidelog.llm import queries, range_coder, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def brute(tokenizer, rows):
    """Rows of the contract; rows of one key in any order."""
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def found(df, **more):
    return [tuple(r) for r in token_ids.token_report(df, PATH, 49_408, 2, **more).orderBy("start").collect()]


@pytest.mark.parametrize("seed", range(8))
def test_coder(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [2, 33, 1024, 5000, 49_408, 65_536, 1 << 17, 70_000][seed]
    n = [1, 2, 50, 500, 700, 4096, 100, 900][seed]
    blocks = rng.zipf(1.3, size=(9, n)) % vocabulary
    blocks[1], blocks[2] = vocabulary - 1, rng.integers(0, vocabulary, n)
    blocks[3] = np.arange(n) % min(7, vocabulary)
    codes = range_coder.encode(blocks, vocabulary)
    assert (range_coder.decode(codes, n, vocabulary) == blocks).all()
    assert range_coder.encode(blocks[4:5], vocabulary)[0] == codes[4], "blocks don't depend on each other"
    if n > 400:
        assert len(codes[3]) < n / 4 and len(codes[1]) < n / 4


def test_block_of_too_many_ids():
    with pytest.raises(ValueError):
        range_coder.encode(np.zeros((1, range_coder.BLOCK + 1)), 10)


def test_carries():
    """Improbable ids after probable ones push the coder to the ends of its range."""
    rng = np.random.default_rng(3)
    blocks = np.where(rng.random((40, 3000)) < 0.02, rng.integers(0, 1000, (40, 3000)), 999)
    assert (range_coder.decode(range_coder.encode(blocks, 1000), 3000, 1000) == blocks).all()


def write_file(rows, vocabulary=1000):
    out = pa.BufferOutputStream()
    writer = token_ids.FileWriter(out, vocabulary)
    for key, ids in rows:
        writer.add(pa.array([key], pa.int64()), pa.array([None if ids is None else np.array(ids, dtype="<u4").tobytes()], pa.binary()))
    writer.close()
    return out.getvalue().to_pybytes()


def read_file(data, start=0):
    return [tuple(r.values()) for part in token_ids.read_file(pa.BufferReader(data), start) for r in part.to_pylist()]


def test_file():
    rng = random.Random(1)
    rows = [(k, [rng.randrange(1000) for _ in range(n)]) for k, n in enumerate((0, 1, 5000, 0, 4096, 8191, 3, 0, 0))] + [(None, [7]), (5, None)]
    want, start = [], 11
    for key, ids in rows:
        want.append((key, start, len(ids or []), np.array(ids or [], dtype="<u4").tobytes()))
        start += len(ids or [])
    assert read_file(write_file(rows), 11) == want
    assert read_file(write_file([])) == []
    with pytest.raises(ValueError, match="isn't below"):
        write_file([(1, [1000])])


def test_damaged_file():
    data = bytearray(write_file([(1, list(range(900)))]))
    for at, reason in ((60, "checksum"), (len(data) - 30, "table"), (len(data) - 1, "table")):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with pytest.raises(ValueError, match=reason):
            read_file(bytes(broken))


def test_query(spark, sf_dir, docs, tokenizer):
    want = brute(tokenizer, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, queries.op12_token_ids(spark, sf_dir).collect())) == sorted(want)


def test_odd_texts(spark, tokenizer):
    rng = random.Random(3)
    alphabet = [" ", "\n", "\t", "\r", "a", "b", "é", "1", ".", "'", " ", "漢", "S", "Σ", "́", "\x1c", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).repartition(3)
    assert found(df) == brute(tokenizer, rows)
    assert found(df.where("false")) == []


def test_odd_docs(odd_docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = found(odd_docs)
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((r[0], r[2], r[3]) for r in brute(tokenizer, rows) if r[0] is not None)
    assert [r[0] for r in got] == [r[0] for r in brute(tokenizer, rows)]
    ends = [r[1] + r[2] for r in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]


def test_hot_key(spark):
    """Rows of one key are dealt to several tasks, in one sequence."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows are few
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"))
    path = token_ids.scratch(spark, "hot")
    token_ids.write_ids(token_ids.encode_texts(token_ids.in_key_order(df), PATH, 2), path, 49_408)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = token_ids.read_ids(spark, path)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    ends = [(r.start, r.start + r.n_tokens) for r in rows.orderBy("start").collect()]
    assert len(ends) == 3000 and all(b == c for (_, b), (c, _) in zip(ends, ends[1:]))
