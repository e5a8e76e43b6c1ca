"""Chunked files: cutting, assembling, checking."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.functions.folders import stored as stored_table

CHUNK = 1024
# A file of more bytes is stored by itself; others are a column.
SMALL_BYTES = 1 << 20
FILE_SCHEMA = "ns STRING, _id BIGINT, gridfs_id BIGINT, filename STRING, length BIGINT, md5 STRING, content STRING, _ts BIGINT, deleted BOOLEAN"
BINARY_FILE_SCHEMA = FILE_SCHEMA.replace("content STRING", "content BINARY, stored_at STRING")


def chunk_texts(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = CHUNK) -> DataFrame:
    """(files_id, n, data): each text in pieces of ``size`` characters, numbered from 0; an empty text has one empty piece.  One pass over a text."""
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), 0)
    whole = F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(pieces)
    return df.select(F.col(key).alias("files_id"), F.posexplode(whole).alias("n", "data"))


def file_table(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, filename, length, md5) of each text."""
    return df.select(F.col(key).alias("_id"), F.concat(F.lit("doc-"), F.col(key), F.lit(".txt")).alias("filename"), F.length(text).cast("long").alias("length"), F.md5(text).alias("md5"))


def _gathered(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """Each file with its chunks in order; a file's size bounds what is gathered."""
    parts = chunks.groupBy("files_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "data"))).alias("parts"), F.count("*").alias("chunks"), F.max("n").alias("last")
    )
    whole = files.join(parts, files["_id"] == parts["files_id"], "left")
    content = F.array_join(F.transform("parts", lambda p: p.data), "")
    numbers = F.size(F.array_distinct(F.transform("parts", lambda p: p.n)))
    return whole.withColumns({"content": F.coalesce(content, F.lit("")), "numbers": numbers}).drop("parts", "files_id")


def _broken() -> Column:
    missing = F.coalesce(F.col("last") + 1 != F.col("chunks"), F.lit(True)) | (F.col("numbers") != F.col("chunks"))
    return F.when(missing, "missing_chunk").when(F.length("content") != F.col("length"), "wrong_length").when(F.md5("content") != F.col("md5"), "wrong_digest")


def assemble(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """(_id, filename, length, md5, content) of the files whose chunks are complete."""
    return _gathered(chunks, files).where(_broken().isNull()).select("_id", "filename", "length", "md5", "content")


def broken_files(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """(_id, reason) of the others."""
    return _gathered(chunks, files).withColumn("reason", _broken()).where("reason is not null").select("_id", "reason")


# files of bytes


def chunk_bytes(df: DataFrame, key: str, data: str, size: int = CHUNK) -> DataFrame:
    """(files_id, n, data): each binary in pieces of ``size`` bytes, numbered from 0; an empty one has one empty piece."""
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length(data) / size).cast("int") - 1, F.lit(0))), lambda k: F.substring(data, k * size + 1, F.lit(size)))
    return df.select(F.col(key).alias("files_id"), F.posexplode(pieces).alias("n", "data"))


def binary_file_table(df: DataFrame, key: str, data: str, name: Column) -> DataFrame:
    """(_id, filename, length, md5) of each binary; length in bytes."""
    return df.select(F.col(key).alias("_id"), name.alias("filename"), F.octet_length(data).cast("long").alias("length"), F.md5(data).alias("md5"))


def store_files(chunks: DataFrame, path: str, small: int = SMALL_BYTES) -> DataFrame:
    """(files_id, whole, bytes, digest, content, stored_at) of each file that ``chunks`` (files_id, n, data as bytes) make.

    The chunks stream by in order of (files_id, n), with a running length and MD5 digest; up to ``small`` bytes are kept as ``content``, longer files
    are written to a file below ``path`` as they come, so a task never holds one.  ``whole`` is false where a chunk is missing or comes twice; such a
    file isn't stored.  Tasks write to names of their own attempt: only what their rows name counts.
    """
    key = chunks.schema["files_id"].dataType
    names = ["files_id", "whole", "bytes", "digest", "content", "stored_at"]
    kinds = [to_arrow_type(key), pa.bool_(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def stored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        attempt, out, count = TaskContext.get().taskAttemptId(), [], 0

        class Open:
            """The file whose chunks are going by."""

            def __init__(self, own: object):
                self.key, self.next, self.whole, self.size, self.digest = own, 0, True, 0, hashlib.md5()
                self.held: list[bytes] = []
                self.sink, self.name = None, None

            def add(self, n: int, data: bytes) -> None:
                self.whole = self.whole and n == self.next
                self.next += 1
                if not self.whole:
                    return
                self.size += len(data)
                self.digest.update(data)
                self.held.append(data)
                if self.size > small:
                    if self.sink is None:
                        store.create_dir(base, recursive=True)
                        self.name = f"{base}/{attempt}-{count}.bin"
                        self.sink = store.open_output_stream(self.name, compression=None)
                    self.sink.write(b"".join(self.held))
                    self.held = []

            def done(self) -> tuple:
                if self.sink is not None:
                    self.sink.close()
                    if not self.whole:
                        store.delete_file(self.name)
                if not self.whole:
                    return self.key, False, None, None, None, None
                content = None if self.sink is not None else b"".join(self.held)
                return self.key, True, self.size, self.digest.hexdigest(), content, self.name

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        file, held = None, 0
        for part in parts:
            for own, n, data in zip(*(part.column(k).to_pylist() for k in range(3))):
                if file is None or own != file.key:
                    if file is not None:
                        out.append(file.done())
                        held += len(out[-1][4] or b"")
                    file, count = Open(own), count + 1
                file.add(n, data or b"")
                if held > 4 * small or len(out) > 10_000:
                    yield batch()
                    out, held = [], 0
        if file is not None:
            out.append(file.done())
        if out:
            yield batch()

    rows = chunks.select("files_id", "n", F.col("data").cast("binary")).repartition("files_id").sortWithinPartitions("files_id", "n")
    return rows.mapInArrow(stored, f"files_id {key.simpleString()}, whole boolean, bytes long, digest string, content binary, stored_at string")


def judge_files(chunks: DataFrame, files: DataFrame, path: str, small: int = SMALL_BYTES) -> DataFrame:
    """(_id, filename, length, md5, content, stored_at, reason): every file of ``files`` with what its chunks make, or why they don't make it."""
    made = stored_table(store_files(chunks, path, small), "stored-files")
    both = files.join(made, files["_id"] == made["files_id"], "left")
    reason = (
        F.when(~F.coalesce("whole", F.lit(False)), "missing_chunk").when(F.col("bytes") != F.col("length"), "wrong_length").when(F.col("digest") != F.col("md5"), "wrong_digest")
    )
    kept = lambda name: F.when(reason.isNull(), F.col(name)).alias(name)
    return both.select("_id", "filename", "length", "md5", kept("content"), kept("stored_at"), reason.alias("reason"))


def read_stored(rows: DataFrame, piece: int = SMALL_BYTES) -> DataFrame:
    """(_id, n, data): the bytes of stored files (_id, content, stored_at) in pieces of ``piece`` bytes; a task holds one piece at a time."""
    key = rows.schema["_id"].dataType

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for part in parts:
            for own, content, path in zip(*(part.column(k).to_pylist() for k in range(3))):
                if path is None:
                    pieces: Iterable[bytes] = [content[k : k + piece] for k in range(0, max(1, len(content)), piece)]
                else:
                    store, name = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
                    stream = store.open_input_stream(name, compression=None)
                    pieces = iter(lambda: stream.read(piece), b"")  # noqa: B023
                for n, data in enumerate(pieces):
                    yield pa.RecordBatch.from_arrays([pa.array([own], to_arrow_type(key)), pa.array([n], pa.int64()), pa.array([data], pa.binary())], ["_id", "n", "data"])

    return rows.select("_id", "content", "stored_at").mapInArrow(read, f"_id {key.simpleString()}, n long, data binary")


def metadata(files: DataFrame) -> DataFrame:
    """(_id, md5, filename only where there is one) as a map that leaves absent fields out."""
    own = F.create_map(F.lit("md5"), F.col("md5"), F.lit("filename"), F.col("filename"))
    return files.select("_id", F.map_filter(own, lambda _, v: v.isNotNull()).alias("metadata"))


def newest(rows: DataFrame) -> DataFrame:
    """The newest row of each (ns, _id)."""
    rest = [c for c in rows.columns if c not in ("ns", "_id")]
    return rows.groupBy("ns", "_id").agg(F.max_by(F.struct(*rest), "_ts").alias("r")).select("ns", "_id", "r.*").select(*rows.columns)


def is_binary(chunks: DataFrame) -> bool:
    return isinstance(chunks.schema["data"].dataType, T.BinaryType)


def apply_files(log: DataFrame, files: DataFrame, chunks: DataFrame, path: str | None = None, small: int = SMALL_BYTES) -> DataFrame:
    """Rows of FILE_SCHEMA from a log's file entries: the last insert or delete of each file decides; inserted ones get the content their chunks
    make (only these are assembled), those of incomplete chunks are left out.  Chunks of bytes give rows of BINARY_FILE_SCHEMA, large files stored below ``path``."""
    last = log.where(F.col("op").isin("i", "d")).groupBy("ns", "_id").agg(F.max("ts").alias("_ts"), F.max_by("op", "ts").alias("op"))
    put = last.where("op = 'i'").drop("op")
    ids = put.select("_id").distinct()
    own = chunks.join(ids, chunks["files_id"] == ids["_id"], "left_semi"), files.join(ids, "_id", "left_semi")
    content = ["content", "stored_at"] if is_binary(chunks) else ["content"]
    whole = judge_files(*own, path, small).where("reason is null") if is_binary(chunks) else assemble(*own)
    stored = put.join(whole, "_id").select("ns", "_id", F.col("_id").alias("gridfs_id"), "filename", "length", "md5", *content, "_ts", F.lit(False).alias("deleted"))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in stored.schema if f.name not in ("ns", "_id", "_ts", "deleted")}
    gone = last.where("op = 'd'").withColumns({**empty, "deleted": F.lit(True)}).select(*stored.columns)
    return stored.unionByName(gone)


def remove_keys(meta: DataFrame, keys: DataFrame) -> DataFrame:
    """(_id, removed) of the ``keys`` that a target has: the file, where its meta row holds a file id, else the document."""
    return meta.join(keys.select("_id").distinct(), "_id", "left_semi").select("_id", F.when(F.col("gridfs_id").isNull(), "document").otherwise("file").alias("removed"))
