"""Ordered writes in chunks, as a Spark data sink: ``df.write.format("chunked_documents")``.

Each task sends its rows (key, ts, document as JSON text), in their order, ``chunk_size`` at a time to a ``Store``.  A store may refuse rows of a chunk (keys it
has already, where rows only insert): the others of the chunk are written, the refused ones counted, and the task goes on.  The commit message of
a task holds a row for each of its chunks, and the commit writes them all to ``outcomes``: (task, chunk, rows, written, duplicates).

The store here is a folder: a chunk is one file of JSON lines, its name the task's and the chunk's number and the attempt; the commit publishes the names of the attempts that
counted in ``chunks.list``, and readers look at nothing else, so lost or repeated tasks leave nothing behind that counts.  Other stores (a service's bulk
calls) are subclasses of ``Store``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

CHUNK_SIZE = 1000
LISTED = "chunks.list"
OUTCOMES = "task int, chunk int, rows int, written int, duplicates int, file string"


@dataclass
class Sent(WriterCommitMessage):
    chunks: list[tuple] = field(default_factory=list)


class Store:
    """A folder of JSON lines; ``insert`` takes a chunk and gives (rows written, rows refused, name)."""

    def __init__(self, path: str, name: str):
        from pyarrow import fs

        self.store, self.base = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        self.name, self.seen, self.number = name, set(), 0

    def insert(self, rows: list[tuple]) -> tuple[int, int, str]:
        self.store.create_dir(self.base, recursive=True)
        new = []
        for key, ts, doc in rows:
            if key not in self.seen:
                self.seen.add(key)
                new.append(json.dumps([key, ts, doc]))
        name = f"{self.name}-{self.number:06d}.jsonl"
        self.number += 1
        with self.store.open_output_stream(f"{self.base}/{name}", compression=None) as out:
            out.write("".join(line + "\n" for line in new).encode())
        return len(new), len(rows) - len(new), name


class ChunkWriter(DataSourceWriter):
    def __init__(self, path: str, chunk_size: int):
        self.path, self.chunk_size = path, chunk_size

    def write(self, iterator: Iterator) -> Sent:
        from pyspark import TaskContext

        task, sent, chunk = TaskContext.get(), Sent(), []
        store = Store(self.path, f"{task.partitionId():06d}-{task.taskAttemptId()}")

        def send() -> None:
            written, refused, name = store.insert(chunk)
            sent.chunks.append((task.partitionId(), len(sent.chunks), len(chunk), written, refused, name))
            chunk.clear()

        for row in iterator:
            chunk.append(tuple(row))
            if len(chunk) == self.chunk_size:
                send()
        if chunk:
            send()
        return sent

    def commit(self, messages: list[Sent | None]) -> None:
        store = Store(self.path, "")
        store.store.create_dir(store.base, recursive=True)
        rows = sorted(chunk for m in messages if m is not None for chunk in m.chunks)
        with store.store.open_output_stream(f"{store.base}/{LISTED}.new", compression=None) as out:
            out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        store.store.move(f"{store.base}/{LISTED}.new", f"{store.base}/{LISTED}")

    def abort(self, messages: list[Sent | None]) -> None:
        """Nothing was published, so nothing counts."""


class ChunkedDocuments(DataSource):
    """Options: path, chunk_size."""

    @classmethod
    def name(cls) -> str:
        return "chunked_documents"

    def schema(self) -> str:
        return "_key string, ts long, doc string"

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options["path"], int(self.options.get("chunk_size", CHUNK_SIZE)))


def write_chunks(rows: DataFrame, path: str, chunk_size: int = CHUNK_SIZE, tasks: int | None = None) -> DataFrame:
    """Writes rows (ns, _id, doc, _ts) in chunks, those of a key in one task and in order of key and time; gives the outcome of each chunk.

    Of several rows of a key the newest is written, the others are its duplicates.
    """
    if chunk_size < 1:
        raise ValueError("a chunk has a row at least")
    spark = rows.sparkSession
    spark.dataSource.register(ChunkedDocuments)
    key = F.concat_ws("/", "ns", F.col("_id").cast("string"))
    made = rows.select(key.alias("_key"), F.col("_ts").alias("ts"), F.to_json("doc").alias("doc"))
    dealt = made.repartition("_key") if tasks is None else made.repartition(tasks, "_key")
    ordered = dealt.sortWithinPartitions("_key", F.desc("ts"))
    ordered.write.format("chunked_documents").mode("append").option("path", path).option("chunk_size", chunk_size).save()
    return outcomes(spark, path)


def _published(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(f"{path}/{LISTED}")
    return lines.select(F.from_json("value", "array<string>").alias("v"))


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """(task, chunk, rows, written, duplicates) of the chunks that were published."""
    v = F.col("v")
    return _published(spark, path).select(*(F.get(v, F.lit(k)).cast("int").alias(n) for k, n in enumerate(("task", "chunk", "rows", "written", "duplicates"))))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(_key, ts, doc, task, chunk, line) of all published chunks."""
    named = _published(spark, path).select(F.get("v", F.lit(5)).alias("file"), *(F.get("v", F.lit(k)).cast("int").alias(n) for k, n in enumerate(("task", "chunk"))))
    lines = spark.read.option("pathGlobFilter", "*.jsonl").text(path).select("value", F.col("_metadata.file_name").alias("file"))
    own = lines.join(named, "file").select(F.from_json("value", "array<string>").alias("r"), "task", "chunk")
    return own.select(F.get("r", F.lit(0)).alias("_key"), F.get("r", F.lit(1)).cast("long").alias("ts"), F.get("r", F.lit(2)).alias("doc"), "task", "chunk")
