"""Binary files: streamed in order with a running digest, small ones as a column, large ones apart."""

import hashlib
import random
import tempfile

from pyspark.sql import functions as F

from tests.test_entry_path import insert, log_of
from tidelog.operators import files, predicates
from tidelog.operators.routing import Rule, Rules
from tidelog.sinks.targets import FileTarget


def contents():
    rng = random.Random(5)
    sizes = [0, 1, 999, 1000, 1001, 5000, 300_000, 4_000_000]
    return {k: rng.randbytes(n) for k, n in enumerate(sizes)} | {100: b"\xff\x00\xfe" * 700}


def table_of(spark, held):
    return spark.createDataFrame([(k, v) for k, v in held.items()], "k long, data binary")


def test_files_come_back(spark):
    held = contents()
    df = table_of(spark, held)
    table, chunks = files.binary_file_table(df, "k", "data", F.lit("name")), files.chunk_bytes(df, "k", "data", 1000)
    found = files.judge_files(chunks.repartition(7), table, tempfile.mkdtemp(), 2000)
    rows = {r._id: r for r in found.collect()}
    assert all(r.reason is None and r.length == len(held[k]) and r.md5 == hashlib.md5(held[k]).hexdigest() for k, r in rows.items()) and set(rows) == set(held)
    assert {k for k, r in rows.items() if r.stored_at} == {k for k, v in held.items() if len(v) > 2000}
    assert all(bytes(r.content) == held[k] for k, r in rows.items() if r.content is not None)
    assert all(open(r.stored_at, "rb").read() == held[k] for k, r in rows.items() if r.stored_at)
    read = {}
    for r in files.read_stored(found, 777).orderBy("_id", "n").collect():
        assert len(r.data) <= 777
        read[r._id] = read.get(r._id, b"") + bytes(r.data)
    assert read == held


def test_missing_and_doubled_chunks(spark):
    df = table_of(spark, contents())
    table, chunks = files.binary_file_table(df, "k", "data", F.lit("name")), files.chunk_bytes(df, "k", "data", 1000)
    lost = chunks.where("not (files_id = 5 and n = 2) and not (files_id = 6 and n = 299) and not (files_id = 4 and n = 0)")
    twice = lost.unionByName(chunks.where("files_id = 7 and n = 3999"))
    found = {r._id: r.reason for r in files.judge_files(twice, table, tempfile.mkdtemp(), 2000).where("reason is not null").collect()}
    assert found == {5: "missing_chunk", 6: "wrong_length", 4: "missing_chunk", 7: "missing_chunk"}
    wrong = table.withColumn("md5", F.lit("0"))
    assert {r.reason for r in files.judge_files(chunks, wrong, tempfile.mkdtemp()).collect()} == {"wrong_digest"}
    assert files.judge_files(chunks.where("false"), table, tempfile.mkdtemp()).where("reason = 'missing_chunk'").count() == 9
    assert files.judge_files(chunks, table.where("false"), tempfile.mkdtemp()).count() == 0


def test_target_of_bytes(spark):
    rules, df = Rules((Rule("a.fs", gridfs=True),)), table_of(spark, contents())
    table, chunks = files.binary_file_table(df, "k", "data", F.lit("name")), files.chunk_bytes(df, "k", "data", 1000)
    rows = [insert(k + 1, "a.fs.files", k, {}) for k in range(8)] + [(20, "d", "a.fs.files", 3, None, None, None), insert(30, "a.fs.files", 3, {}), (40, "d", "a.fs.files", 6, None, None, None)]
    own = predicates.prepare(log_of(spark, rows), rules)
    target = FileTarget(spark, tempfile.mkdtemp() + "/f", table, chunks, small=2000)
    for part in ("ts < 5", "ts >= 5 and ts < 25", "ts >= 25", "ts >= 25"):
        target.apply(own.where(part), 0)
    assert {r._id: r.length for r in target.contents().collect()} == {k: len(contents()[k]) for k in (0, 1, 2, 3, 4, 5, 7)}
    assert target.last().first()._ts == 40 and target.search(30, 40).count() == 2
