"""Token ids of documents in files of their own format, as a Spark data source.

``df.write.format("token_ids")`` takes rows (key, ids as little-endian unsigned 32-bit integers), or (key, text) and a tokenizer, and writes one file a task,
in the order of rows;
``spark.read.format("token_ids")`` gives back (key, start, n_tokens, ids), where start counts the ids of all rows before.

A file holds blocks of up to ``range_coder.BLOCK`` ids, coded independently of each other, each with its number of ids, its length and the CRC-32 of
its ids; then a table of its rows (keys, which of them are null, how many ids) with a CRC-32; then where that table begins.  A failed checksum raises.

Tasks write to names of their own attempt, and the commit lists the files of the attempts that counted in ``_files.json``, in the order of tasks, with the
ids before each: what lost or repeated tasks left behind is never read.  The driver sees one line a file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tidelog.llm import range_coder
from tidelog.llm.common import pieces, scratch
from tidelog.llm.stretches import BLANKS, Memo, begins, marks_apart

MAGIC, LISTED = b"TOKENID2", "_files.json"
HEAD, BLOCK_HEAD, TAIL = "<8sII", "<III", "<QI8s"
#: So many stretches are encoded at once.
AT_ONCE = 4096
#: A worker process keeps what it learnt for its next tasks, up to so many stretches, or bytes of them.
KEPT, KEPT_BYTES = 5 << 18, 80 << 20
APOSTROPHE = "'"
#: Letters of Latin scripts, each one character.
ALPHABET = "".join(c for c in map(chr, [*range(0x41, 0x7B), *range(0xC0, 0x250)]) if c.isalpha())
SCHEMA = "key long, start long, n_tokens long, ids binary"


@dataclass
class Written(WriterCommitMessage):
    task: int
    name: str
    rows: int
    ids: int


def store_of(path: str):
    """(file system, path in it) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


class FileWriter:
    """One file: ids are kept until there is a full block."""

    def __init__(self, out, vocabulary: int):
        self.out, self.vocabulary, self.size = out, vocabulary, 0
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.keys: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.write(struct.pack(HEAD, MAGIC, vocabulary, range_coder.BLOCK))

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, keys: pa.Array, cells: pa.Array) -> None:
        self.keys.append(keys.cast(pa.int64()))
        lengths = pa.compute.fill_null(pa.compute.binary_length(cells), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        self.lengths.append(lengths)
        for cell in cells:
            if cell.is_valid:
                self.keep(np.frombuffer(cell.as_buffer(), dtype="<u4"))

    def put(self, keys: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Rows whose ids stand one behind the other."""
        self.keys.append(keys.cast(pa.int64()))
        self.lengths.append(lengths)
        self.keep(ids)

    def keep(self, ids: np.ndarray) -> None:
        while len(ids):
            room = range_coder.BLOCK - self.held
            self.waiting.append(ids[:room])
            self.held += len(ids[:room])
            ids = ids[room:]
            if self.held == range_coder.BLOCK:
                self.flush()

    def flush(self) -> None:
        ids = np.concatenate([np.empty(0, dtype="<u4"), *self.waiting])
        self.waiting, self.held, self.ids = [], 0, self.ids + len(ids)
        if not len(ids):
            return
        if int(ids.max()) >= self.vocabulary:
            raise ValueError(f"id {ids.max()} isn't below {self.vocabulary}")
        (code,) = range_coder.encode(ids.reshape(1, -1), self.vocabulary)
        self.write(struct.pack(BLOCK_HEAD, len(ids), len(code), zlib.crc32(ids.tobytes())) + code)

    def close(self) -> tuple[int, int]:
        """Ends the file; gives how many rows and ids it has."""
        self.flush()
        keys = pa.concat_arrays(self.keys) if self.keys else pa.array([], pa.int64())
        lengths = np.concatenate([np.empty(0, dtype=np.int64), *self.lengths])
        nulls = keys.is_null().to_numpy(zero_copy_only=False)
        table = b"".join(x.tobytes() for x in (keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), lengths.astype("<i8"), nulls.astype("u1")))
        begun = self.size
        self.write(table + struct.pack(TAIL, begun, zlib.crc32(table), MAGIC))
        return len(keys), self.ids


def read_file(stream, start: int) -> Iterator[pa.RecordBatch]:
    """The rows of an open file of ids; ``start`` ids come before it."""
    size = stream.size()
    stream.seek(size - struct.calcsize(TAIL))
    begun, checksum, magic = struct.unpack(TAIL, stream.read(struct.calcsize(TAIL)))
    stream.seek(begun)
    table = stream.read(size - struct.calcsize(TAIL) - begun)
    if magic != MAGIC or zlib.crc32(table) != checksum:
        raise ValueError("a file of ids has a broken table")
    rows = len(table) // 17
    keys, lengths = np.frombuffer(table, "<i8", rows), np.frombuffer(table, "<i8", rows, 8 * rows)
    nulls = np.frombuffer(table, "u1", rows, 16 * rows).astype(bool)
    ends = np.cumsum(lengths)
    stream.seek(0)
    _, vocabulary, n = struct.unpack(HEAD, stream.read(struct.calcsize(HEAD)))
    at, row, held, before = struct.calcsize(HEAD), 0, [], 0

    def batch(first: int, last: int, ids: np.ndarray) -> pa.RecordBatch:
        own = lengths[first:last]
        offsets = np.append(0, np.cumsum(own)) * 4
        cells = pa.Array.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
        columns = [pa.array(keys[first:last], mask=nulls[first:last]), pa.array(start + ends[first:last] - own), pa.array(own), cells.cast(pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["key", "start", "n_tokens", "ids"])

    while at < begun:
        count, length, crc = struct.unpack(BLOCK_HEAD, stream.read(struct.calcsize(BLOCK_HEAD)))
        at += struct.calcsize(BLOCK_HEAD) + length
        own = range_coder.decode([stream.read(length)], count, vocabulary)[0] if count <= n else np.empty(0, dtype="<u4")
        if len(own) != count or zlib.crc32(own.astype("<u4").tobytes()) != crc:
            raise ValueError("a block of ids differs from its checksum")
        held.append(own)
        before += count
        # rows that are complete; those of a few million ids go at a time
        ready = int(np.searchsorted(ends, before, side="right"))
        if row == ready:
            continue
        ids = np.concatenate(held)
        while row < ready:
            base = int(ends[row] - lengths[row])
            last = max(row + 1, min(ready, int(np.searchsorted(ends, base + (1 << 20), side="right"))))
            taken = int(ends[last - 1]) - base
            yield batch(row, last, ids[:taken])
            ids, row = ids[taken:], last
        held = [ids]
    if row < rows:  # rows without ids behind the last block
        yield batch(row, rows, np.empty(0, dtype="<u4"))


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, vocabulary: int, tokenizer: str | None = None, end_id: int | None = None):
        self.path, self.vocabulary, self.tokenizer, self.end_id = path, vocabulary, tokenizer, end_id

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, base = store_of(self.path)
        store.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        with store.open_output_stream(f"{base}/{name}", compression=None) as out:
            writer = FileWriter(out, self.vocabulary)
            if self.tokenizer is None:
                for part in iterator:
                    writer.add(part.column(0), part.column(1))
            else:
                for part in pieces(iterator, 1):
                    ids, bounds = encoder(self.tokenizer).ids(part.column(1), self.end_id)
                    writer.put(part.column(0), np.diff(bounds), ids)
            rows, ids = writer.close()
        return Written(task.partitionId(), name, rows, ids)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.path)
        store.create_dir(base, recursive=True)
        listed, start = [], 0
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.task):
            listed.append({"name": m.name, "rows": m.rows, "ids": m.ids, "start": start})
            start += m.ids
        with store.open_output_stream(f"{base}/{LISTED}.new", compression=None) as out:
            out.write(json.dumps(listed).encode())
        store.move(f"{base}/{LISTED}.new", f"{base}/{LISTED}")

    def abort(self, messages: list[Written | None]) -> None:
        store, base = store_of(self.path)
        for m in messages:
            if m is not None:
                store.delete_file(f"{base}/{m.name}")


class Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        store, base = store_of(self.path)
        with store.open_input_stream(f"{base}/{LISTED}", compression=None) as stream:
            return [InputPartition((f["name"], f["start"])) for f in json.loads(stream.read()) if f["rows"]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing was written
            return
        name, start = partition.value
        store, base = store_of(self.path)
        with store.open_input_file(f"{base}/{name}") as stream:
            yield from read_file(stream, start)


class TokenIds(DataSource):
    """Options: path; for writing, vocabulary (ids are below it), and for rows of texts tokenizer and, if one goes behind each text, end_id."""

    @classmethod
    def name(cls) -> str:
        return "token_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> Writer:
        end_id = self.options.get("end_id")
        return Writer(self.options["path"], int(self.options["vocabulary"]), self.options.get("tokenizer"), None if end_id is None else int(end_id))


class Growing:
    """An array that further values are put behind, in time that grows with them alone."""

    def __init__(self, dtype: str):
        self.held, self.size = np.empty(1 << 16, dtype=dtype), 0

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            held = np.empty(size + size // 2, dtype=self.held.dtype)
            held[: self.size] = self.held[: self.size]
            self.held = held
        self.held[self.size : size] = values
        self.size = size


class Encoder:
    """The ids of texts, put together from those of their stretches, each of which is encoded once.

    A tokenizer normalizes a text, cuts it into pieces and tokenizes each.  Words of Latin letters take the first two steps letter by letter, in one
    translation, if the tokenizer treats the whole alphabet so, as one piece; any other stretch is encoded by itself.
    """

    def __init__(self, tokenizer: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(tokenizer)
        self.starts = begins(BLANKS)
        self.apart = marks_apart("".join([APOSTROPHE, *(t.content for t in self.model.get_added_tokens_decoder().values())]).encode())
        parted = {c: self.parted(c) for c in ALPHABET}
        self.table = {ord(c): own[0] for c, own in parted.items() if len(own) == 1}
        letters = "".join(map(chr, self.table))
        plain = bool(letters) and self.parted(letters) == [letters.translate(self.table)]
        self.word = re.compile(f"[{BLANKS.decode()}]?([{letters}]+)" if plain else "(?!)").fullmatch
        self.begin()

    def begin(self) -> None:
        self.memo = Memo(KEPT, KEPT_BYTES)
        # ids one behind the other; where each stretch's begin, and how many it has
        self.pool, self.begins, self.sizes = Growing("<u4"), Growing("i8"), Growing("i8")

    def parted(self, text: str) -> list[str]:
        """The pieces that are tokenized."""
        text = text if self.model.normalizer is None else self.model.normalizer.normalize_str(text)
        return [text] if self.model.pre_tokenizer is None else [piece for piece, _ in self.model.pre_tokenizer.pre_tokenize_str(text)]

    def learn(self, stretches: list[bytes]) -> None:
        """Puts the ids of further stretches into the pool."""
        ids: list[int] = []
        ends = []
        tokenize, table, word = self.model.model.tokenize, self.table, self.word
        for text in map(bytes.decode, stretches):
            if plain := word(text):
                ids += [token.id for token in tokenize(plain[1].translate(table))]
            else:
                ids += self.model.encode(text, add_special_tokens=False).ids
            ends.append(len(ids))
        sizes = np.diff(ends, prepend=0)
        self.begins.add(self.pool.size + np.array(ends, dtype=np.int64) - sizes)
        self.sizes.add(sizes)
        self.pool.add(np.array(ids, dtype="<u4"))

    def ids(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with ``end_id`` behind it; the bounds of each text's among them)."""
        if self.memo.full or self.memo.fresh:  # fresh ones were left by a task that broke off
            self.begin()
        numbers, lengths = self.memo.numbers(texts, self.starts, self.apart)
        for k in range(0, len(self.memo.fresh), AT_ONCE):
            self.learn(self.memo.fresh[k : k + AT_ONCE])
        self.memo.fresh = []
        sizes = self.sizes.held[numbers]
        ends = np.cumsum(sizes)
        bounds = np.append(0, ends)[np.append(0, np.cumsum(lengths))]
        ids = self.pool.held[np.repeat(self.begins.held[numbers] - (ends - sizes), sizes) + np.arange(bounds[-1])]
        if end_id is not None:
            ids, bounds = np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))
        return ids, bounds


@lru_cache(maxsize=1)
def encoder(tokenizer: str) -> Encoder:
    """This process's encoder: Spark gives a worker process one task after the other."""
    return Encoder(tokenizer)


def encode_texts(df: DataFrame, tokenizer: str, end_id: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): each text's ids, as little-endian unsigned 32-bit integers, with ``end_id`` behind them; null texts count as empty.

    The tokenizer must work on each stretch of a text by itself (``stretches``), as those do that drop white space and part letters from marks, but for
    apostrophes and the characters of added tokens.  Rows stay in their order.
    """
    kind = df.schema[key].dataType.simpleString()

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts, 1):
            ids, bounds = encoder(tokenizer).ids(part.column(1), end_id)
            cells = [ids[i:j].tobytes() for i, j in zip(bounds.tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cells, pa.binary())], ["key", "ids"])

    return df.select(key, text).mapInArrow(encoded, f"key {kind}, ids binary")


def write_ids(rows: DataFrame, path: str, vocabulary: int) -> None:
    """Writes (key, ids) in the order of their partitions and rows."""
    rows.sparkSession.dataSource.register(TokenIds)
    rows.write.format("token_ids").mode("append").option("path", path).option("vocabulary", vocabulary).save()


def write_texts(rows: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int | None = None) -> None:
    """Writes the ids of (key, text), as ``encode_texts`` and ``write_ids`` would, by one process a task."""
    rows.sparkSession.dataSource.register(TokenIds)
    out = rows.write.format("token_ids").mode("append").option("path", path).option("vocabulary", vocabulary).option("tokenizer", tokenizer)
    (out if end_id is None else out.option("end_id", end_id)).save()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids) of what ``write_ids`` wrote."""
    spark.dataSource.register(TokenIds)
    return spark.read.format("token_ids").option("path", path).load()


def in_key_order(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows by ascending key, null keys first; rows of one key stay in the order they are read in, and may spread over several tasks."""
    placed = df.select(key, text, F.monotonically_increasing_id().alias("_at"))
    return placed.repartitionByRange(key, "_at").sortWithinPartitions(key, "_at").select(key, text)


def token_report(df: DataFrame, tokenizer: str, vocabulary: int, end_id: int) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files its ids were written to in order of doc_id.

    Repeated rows are documents of their own; null and empty texts have the end id alone; an empty table gives no row.
    """
    spark = df.sparkSession
    path = scratch(spark, "token-ids")
    write_texts(in_key_order(df), path, tokenizer, vocabulary, end_id)
    kind = df.schema["doc_id"].dataType
    return read_ids(spark, path).select(F.col("key").cast(kind).alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
