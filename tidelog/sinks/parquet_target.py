"""A table of documents that is merged when it is read.

Folders below the target's path, each named by a number that counts up:

* ``changes-<n>``: a batch's entries as they are.  A batch writes its own folder and reads or changes nothing else, whatever its keys or commands.
* ``rollback-<n>``: rows that replace all that is known of their keys from folders before.
* ``base-<n>``: the state after all folders up to n, written by ``compact``; ``rejects-<n>``: the entries up to n that couldn't be applied.

A folder counts once Spark has marked its writing as complete; nothing is deleted or overwritten to make room for it, so a crash at any time leaves the
table as it was before the batch.  A batch that runs again adds its entries a second time, which changes nothing: the replay takes a time's entry once, and entries at or before a
base row's time are hidden by it.  ``clean`` removes what the newest base has made superfluous.  One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.folders import begun, listed, removed
from tidelog.operators.reconcile import last_doc, reconcile, search_range, upserted_and_gone
from tidelog.operators.replay import KEYS, STATE_SCHEMA, Replayed, Signs, apply_commands, replay_all, replay_documents, signs_of, state_as_log, with_signs
from tidelog.operators.routing import Rules
from tidelog.sources.change_log import log_schema

REJECTS_SCHEMA = "ns STRING, _id BIGINT, ts BIGINT, op STRING, reason STRING"


def documents_of(log: DataFrame) -> DataFrame:
    """The entries that aren't about files."""
    return log.where("not is_file") if "is_file" in log.columns else log


def number(name: str) -> int:
    """The number in a folder's name; 0 for folders of others."""
    found = re.fullmatch(r"(?:changes|rollback|base|rejects)-(\d+)", name)
    return int(found[1]) if found else 0


@dataclass
class ParquetTarget:
    """A state table of documents; ``key`` is the type of their keys, ``buckets`` how many files a base gets at most."""

    spark: SparkSession
    path: str
    name: str = "parquet"
    replay: Callable[[DataFrame], DataFrame] = replay_documents
    buckets: int = 64
    key: str = "BIGINT"

    def _schema(self, schema: str) -> str:
        return schema.replace("_id BIGINT", f"_id {self.key}")

    def _new(self, what: str) -> str:
        """A folder of the next number."""
        return f"{self.path}/{what}-{1 + max(map(number, begun(self.spark, self.path)), default=0):010d}"

    def _read(self, what: str, schema: str, after: int = 0, up_to: int | None = None) -> DataFrame:
        """The rows of all folders of one kind, with the number of their folder."""
        own = [n for n in listed(self.spark, self.path) if n.startswith(what + "-") and number(n) > after and (up_to is None or number(n) <= up_to)]
        if not own:
            return self.spark.createDataFrame([], f"{schema}, _n BIGINT")
        rows = self.spark.read.schema(schema).parquet(*(f"{self.path}/{n}" for n in own))
        return rows.withColumn("_n", F.regexp_extract("_metadata.file_path", rf"{what}-(\d+)/", 1).cast("long"))

    def _base(self) -> int:
        return max((number(n) for n in listed(self.spark, self.path) if n.startswith("base-")), default=0)

    def _parts(self) -> tuple[DataFrame, DataFrame]:
        """(rows of state, entries) that are to be replayed: the base's rows and those of rollbacks, and the entries that no rollback replaces."""
        at = self._base()
        base = self._read("base", self._schema(STATE_SCHEMA), at - 1, at).drop("_n")
        log = self._read("changes", log_schema(self.key), at)
        if not any(n.startswith("rollback-") and number(n) > at for n in listed(self.spark, self.path)):
            return base, log.drop("_n")
        rest = [c for c in base.columns if c not in KEYS]
        rolled = self._read("rollback", self._schema(STATE_SCHEMA), at).groupBy(*KEYS).agg(F.max_by(F.struct(*rest, "_n"), "_n").alias("r")).select(*KEYS, "r.*")
        keys = rolled.select(*KEYS, F.col("_n").alias("_rolled"))
        later = log.join(keys, KEYS, "left").where("_rolled is null or _n > _rolled")
        kept = base.join(keys, KEYS, "left_anti")
        return kept.unionByName(rolled.drop("_n")), later.select(*log.columns).drop("_n")

    def _entries(self, base: DataFrame, log: DataFrame) -> tuple[DataFrame, Signs, DataFrame | None]:
        """(entries to replay, their signs, tombstones of what commands void or move away: None without commands)."""
        both, signs = state_as_log(base).unionByName(log), signs_of(log)
        if not signs.commands:
            return both, signs, None
        gone = both.where("op <> 'c'").select(*KEYS).distinct().withColumns(
            {"doc": F.lit(None).cast("variant"), "_ts": F.lit(signs.commands[-1][0]).cast("long"), "deleted": F.lit(True)}
        )
        return apply_commands(both, signs.commands), signs, gone

    def _with_gone(self, state: DataFrame, gone: DataFrame | None) -> DataFrame:
        return state if gone is None else state.unionByName(gone.join(state.select(*KEYS), KEYS, "left_anti"))

    def state(self) -> DataFrame:
        """Every document's row, tombstones included."""
        own, signs, gone = self._entries(*self._parts())
        return self._with_gone(with_signs(self.replay, own, signs), gone)

    def rejects(self) -> DataFrame:
        """(ns, _id, ts, op, reason) of all entries that couldn't be applied."""
        own, signs, _ = self._entries(*self._parts())
        earlier = self._read("rejects", self._schema(REJECTS_SCHEMA), 0, self._base()).drop("_n")
        return earlier.unionByName(replay_all(own, signs).rejects).distinct()

    def apply(self, log: DataFrame, batch_id: int) -> None:
        """Writes the batch's entries, and nothing else."""
        columns = [c.split()[0].strip("`") for c in log_schema().replace("MAP<STRING,VARIANT>", "MAP").split(", ")]
        documents_of(log).select(*columns).write.parquet(self._new("changes"))

    def roll_back(self, log: DataFrame, source: DataFrame, batch_id: int, rules: Rules | None = None, replsets: list[str] | None = None) -> None:
        """Makes the target agree with a source (its log and its documents) that has lost writes in ``replsets``; writes the rows that change."""
        state = self.state().persist()
        try:
            upserted_and_gone(reconcile(state, log, source, rules, replsets)).select(*state.columns).write.parquet(self._new("rollback"))
        finally:
            state.unpersist()

    def compact(self) -> None:
        """Writes a new base of all folders so far, its rows by time: a search for the newest ones reads few row groups."""
        done = [number(n) for n in listed(self.spark, self.path) if n.split("-")[0] in ("changes", "rollback")]
        if max(done, default=0) <= self._base():
            return
        own, signs, gone = self._entries(*self._parts())
        found: Replayed = replay_all(own, signs)
        found.rejects.write.mode("overwrite").parquet(f"{self.path}/rejects-{max(done):010d}")
        rows = self._with_gone(found.state if self.replay is replay_documents else self.replay(own), gone)
        # a base of this number whose writing broke off doesn't count, and is written anew
        rows.repartitionByRange(self.buckets, "_ts").sortWithinPartitions("_ts").write.mode("overwrite").parquet(f"{self.path}/base-{max(done):010d}")

    def clean(self) -> None:
        """Deletes folders that the newest base has made superfluous; for when nobody reads an older state any more."""
        at = self._base()
        for name in begun(self.spark, self.path):
            if name.split("-")[0] in ("changes", "rollback", "base") and number(name) < at + (not name.startswith("base-")):
                removed(self.spark, f"{self.path}/{name}")

    def search(self, start: int, end: int) -> DataFrame:
        """Rows with start <= _ts <= end.  Those of the base that no later entry touches are found by a filter on its scan."""
        base, log = self._parts()
        own, signs, gone = self._entries(base, log)
        if gone is not None:
            return search_range(self._with_gone(with_signs(self.replay, own, signs), gone), start, end)
        if log.isEmpty():
            return search_range(base, start, end)
        keys = log.select(*KEYS).distinct()
        quiet = search_range(base, start, end).join(keys, KEYS, "left_anti")
        touched = state_as_log(base.join(keys, KEYS, "left_semi")).unionByName(log)
        return quiet.unionByName(search_range(with_signs(self.replay, touched, signs), start, end))

    def last(self) -> DataFrame:
        return last_doc(self.state())
