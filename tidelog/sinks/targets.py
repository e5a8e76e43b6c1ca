"""Targets: the protocol, Parquet tables of documents and of files, a JSON-lines mirror, and fan-out to several."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.folders import begun, listed
from tidelog.operators.files import BINARY_FILE_SCHEMA, FILE_SCHEMA, SMALL_BYTES, apply_files, is_binary, newest
from tidelog.operators.reconcile import last_doc, search_range
from tidelog.operators.replay import KEYS
from tidelog.sinks.parquet_target import ParquetTarget, documents_of, number

__all__ = ["FileTarget", "JsonTarget", "ParquetTarget", "Target", "documents_of", "fan_out", "remove", "split_valid", "upsert", "with_unique_key"]


class Target(Protocol):
    """What replication needs of a target."""

    name: str

    def apply(self, log: DataFrame, batch_id: int) -> None: ...

    def search(self, start: int, end: int) -> DataFrame: ...

    def last(self) -> DataFrame: ...


def upsert(state: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (columns of state) replace those of the same key; of several, the newest."""
    both = state.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    rest = [c for c in state.columns if c not in KEYS]
    newest = both.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), F.struct("_new", "_ts")).alias("r"))
    return newest.select(*KEYS, "r.*").select(*state.columns)


def remove(state: DataFrame, keys: DataFrame, ts: int) -> DataFrame:
    """Rows of ``keys`` (ns, _id) become tombstones; unknown keys do nothing."""
    gone = state.join(keys.select(*KEYS).distinct().withColumn("_gone", F.lit(True)), KEYS, "left")
    hit = F.coalesce("_gone", F.lit(False)) & ~F.col("deleted")
    return gone.withColumns(
        {"doc": F.when(~hit, F.col("doc")), "_ts": F.when(hit, ts).otherwise(F.col("_ts")), "deleted": hit | F.col("deleted")}
    ).select(*state.columns)


def with_unique_key(state: DataFrame, key: str) -> DataFrame:
    """The state as a target sees it whose key column is ``key``."""
    return state.withColumnRenamed("_id", key)


def split_valid(rows: DataFrame, valid: Column, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows; with ``fail_fast``, a bad row raises when it is read."""
    if fail_fast:
        checked = F.when(valid, F.lit(True)).otherwise(F.raise_error(F.lit("a row can't be written")).cast("boolean"))
        return rows.where(checked), rows.where("false")
    ok = F.coalesce(valid, F.lit(False))
    return rows.where(ok), rows.where(~ok)


@dataclass
class FileTarget:
    """Whole files with their content, from a log's file entries (``is_file``) and the source's ``files`` and ``chunks``.

    An inserted file is assembled from its chunks; one whose chunks aren't complete is left out (``broken_files`` and ``judge_files`` tell why).  A delete
    removes the file.  Rows keep the time of their entry and the target's file id; deletes stay as rows without content.  Chunks of bytes give bytes: files of more than
    ``small`` bytes are stored by themselves below ``path/contents``.  A batch writes a folder of its own, and the newest row of each file counts when
    the table is read, so a batch that breaks off or runs again changes nothing else.
    """

    spark: SparkSession
    path: str
    files: DataFrame
    chunks: DataFrame
    name: str = "files"
    buckets: int = 64
    small: int = SMALL_BYTES

    def table(self) -> DataFrame:
        """The newest row of each file, deleted ones included."""
        schema = BINARY_FILE_SCHEMA if is_binary(self.chunks) else FILE_SCHEMA
        schema = schema.replace(", _id BIGINT, gridfs_id BIGINT", ", _id {0}, gridfs_id {0}".format(self.files.schema["_id"].dataType.simpleString()))
        done = [f"{self.path}/{n}" for n in listed(self.spark, self.path) if number(n)]
        return newest(self.spark.read.schema(schema).parquet(*done)) if done else self.spark.createDataFrame([], schema)

    def contents(self) -> DataFrame:
        """The files there are."""
        return self.table().where("not deleted").drop("deleted")

    def apply(self, log: DataFrame, batch_id: int) -> None:
        own = log.where("is_file and op in ('i', 'd')")
        rows = apply_files(own, self.files, self.chunks, f"{self.path}/contents", self.small)
        rows.write.parquet(f"{self.path}/changes-{1 + max(map(number, begun(self.spark, self.path)), default=0):010d}")

    def search(self, start: int, end: int) -> DataFrame:
        return search_range(self.table(), start, end)

    def last(self) -> DataFrame:
        return last_doc(self.table())


@dataclass
class JsonTarget:
    """Every batch's entries as JSON lines, ``path/batch=<n>``: a mirror of the log for other readers."""

    spark: SparkSession
    path: str
    name: str = "json"

    def apply(self, log: DataFrame, batch_id: int) -> None:
        log.withColumn("o", F.to_json("o")).withColumn("set", F.to_json("set")).write.mode("overwrite").json(f"{self.path}/batch={batch_id}")

    def entries(self, schema: str | None = None) -> DataFrame:
        """The entries written; with a ``schema`` the lines aren't read a first time to find one."""
        reader = self.spark.read.option("basePath", self.path)
        return (reader.schema(schema) if schema else reader).json(f"{self.path}/batch=*")

    def search(self, start: int, end: int) -> DataFrame:
        return self.entries().where(F.col("ts").between(start, end))

    def last(self) -> DataFrame:
        return self.entries().orderBy(F.desc("ts")).limit(1)


def fan_out(log: DataFrame, targets: Iterable[Target], batch_id: int) -> list[tuple[str, str | None]]:
    """Applies a batch to every target, in order; a failure on one doesn't stop the others.  Returns (name, error).  What only one target takes isn't kept."""
    outcome: list[tuple[str, str | None]] = []
    targets = list(targets)
    held = log.persist() if len(targets) > 1 else log
    try:
        for target in targets:
            try:
                target.apply(held, batch_id)
                outcome.append((target.name, None))
            except Exception as problem:  # noqa: BLE001  each target's failure is its own
                outcome.append((target.name, f"{type(problem).__name__}: {problem}"[:500]))
    finally:
        if len(targets) > 1:
            held.unpersist()
    return outcome
