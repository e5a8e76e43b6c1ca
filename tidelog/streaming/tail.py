"""A file stream of log entries, applied to targets batch by batch.

Delivery is at least once: entries a target has seen are dropped when a batch runs again, so the result is as if each had run once.  The progress
table gets the newest entry of every batch, skipped entries included, only after all targets succeeded.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidelog.functions.folders import listed
from tidelog.operators import predicates
from tidelog.operators.reconcile import replication_lag, resume_decision
from tidelog.operators.routing import Rules
from tidelog.sinks.checkpoints import advance
from tidelog.sinks.targets import Target, fan_out
from tidelog.sources.change_log import log_schema
from tidelog.sources.log_source import entries_of_segments, stream_segments


def log_stream(spark: SparkSession, path: str, files_per_batch: int = 1000, key: str = "BIGINT") -> DataFrame:
    return spark.readStream.schema(log_schema(key)).option("maxFilesPerTrigger", files_per_batch).parquet(path)


@dataclass(frozen=True)
class Watch:
    """What a stream looks at between its batches: the logs as they are now, and the source's documents (ns, _id, doc)."""

    log: Callable[[], DataFrame]
    source: Callable[[], DataFrame]


def tail(
    stream: DataFrame,
    targets: list[Target],
    checkpoint: str,
    rules: Rules | None = None,
    progress: str | None = None,
    interval: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda log: log,
    entries: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    watch: Watch | None = None,
    lag: str | None = None,
) -> StreamingQuery:
    """Starts applying ``stream`` to ``targets``: all there is now, or every ``interval`` (e.g. "5 seconds") on.

    With ``rules``, entries are routed, reduced to their fields, and commands name targets, as in ``replicate``.  ``entries`` makes log entries of a
    batch's rows (those of ``change_log`` name files).  With ``watch`` and ``progress``, each batch begins with a look at whether a log has lost what was
    read of it; if so, targets are rolled back before the batch is applied.  After each batch, ``lag`` gets how far every log is ahead of what has been applied.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        log = entries(rows)
        if watch and progress and (held := stored_progress(rows.sparkSession, progress)) is not None:
            recover(watch.log(), held, watch.source(), targets, batch_id, rules, progress)
        own = prepare(predicates.prepare(log, rules) if rules else log.where("op <> 'n'"))
        failed = [f"{name}: {error}" for name, error in fan_out(own, targets, batch_id) if error]
        if failed:
            raise RuntimeError("; ".join(failed))
        if progress:
            advance(log).write.mode("overwrite").parquet(f"{progress}/batch={batch_id}")
        if lag and watch and progress and (reached := stored_progress(rows.sparkSession, progress)) is not None:
            replication_lag(watch.log(), reached).write.mode("overwrite").parquet(f"{lag}/batch={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def counted(stream: DataFrame) -> DataFrame:
    """A stream of log entries whose progress tells, batch by batch, how many were removed, upserted and updated, and the newest time: no pass of its own."""
    return stream.observe(
        "entries", F.count_if(F.col("op") == "d").alias("removed"), F.count_if(F.col("op") == "i").alias("upserted"), F.count_if(F.col("op") == "u").alias("updated"), F.max("ts").alias("newest")
    )


class Monitor(StreamingQueryListener):
    """Writes the counters of ``counted`` streams to ``path/batch=<n>`` as their batches end."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get("entries")
        if found is not None:
            row = [(found["removed"], found["upserted"], found["updated"], found["newest"])]
            made = self.spark.createDataFrame(row, "removed long, upserted long, updated long, newest long")
            made.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={event.progress.batchId}")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def written(self, batch_id: int, seconds: float = 60) -> DataFrame:
        """What was counted up to and with a batch; events arrive a moment after it."""
        until = time.monotonic() + seconds
        while f"batch={batch_id}" not in listed(self.spark, self.path):
            if time.monotonic() > until:
                raise TimeoutError(f"no counters of batch {batch_id}")
            time.sleep(0.1)
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")


def tail_logs(spark: SparkSession, path: str, targets: list[Target], checkpoint: str, key: str = "BIGINT", start: dict[str, int] | None = None, **more) -> StreamingQuery:
    """``tail`` of all logs below ``path``, each from its own position on."""
    return tail(stream_segments(spark, path, start), targets, checkpoint, entries=lambda rows: entries_of_segments(rows, path, key), **more)


def stored_progress(spark: SparkSession, progress: str) -> DataFrame | None:
    """The newest checkpoint of each log, None before the first."""
    return read_progress(spark, progress) if listed(spark, progress) else None


def read_progress(spark: SparkSession, progress: str) -> DataFrame:
    """The newest checkpoint of each log."""
    rows = spark.read.option("basePath", progress).schema("replset STRING, ts BIGINT, batch BIGINT").parquet(f"{progress}/batch=*")
    # a rollback sets a log's position back, so the newest batch that says something of a log counts
    return rows.groupBy("replset").agg(F.max_by("ts", "batch").alias("ts"))


def recover(
    log: DataFrame, checkpoints: DataFrame, source: DataFrame, targets: list, batch_id: int, rules: Rules | None = None, progress: str | None = None
) -> DataFrame:
    """Before a tail is resumed, or between its batches: the decision for each log, after rolling targets back to before what the logs lost that say so.

    ``source`` has the documents (ns, _id, doc) as they are now.  Targets need ``roll_back``.  An ``unrecoverable`` log is an error where a stream goes on
    (``progress`` given).
    """
    found = resume_decision(log, checkpoints, noops=progress is not None)
    decisions = {r.replset: r.decision for r in found.collect()}  # a row for each log
    if progress and (gone := sorted(name for name, what in decisions.items() if what == "unrecoverable")):
        raise RuntimeError(f"unrecoverable: {', '.join(gone)}")
    lost = sorted(name for name, what in decisions.items() if what == "rollback")
    for target in targets if lost else ():
        if hasattr(target, "roll_back"):
            target.roll_back(log, source, batch_id, rules, lost)
    return found


def commit_interval(seconds: int | None) -> str | None:
    """A trigger's interval from a commit interval: null never, 0 every batch at once, n every n seconds."""
    if seconds is None:
        return None
    if seconds < 0:
        raise ValueError("a commit interval isn't negative")
    return f"{seconds} seconds"


def latest_entries(stream: DataFrame) -> DataFrame:
    """A running (ns, _id, last_ts, entries), for update mode; state is kept by Spark per key."""
    return stream.where("op <> 'n'").groupBy("ns", "_id").agg(F.max("ts").alias("last_ts"), F.count("*").alias("entries"))
