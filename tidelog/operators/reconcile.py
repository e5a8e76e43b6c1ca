"""Checkpoints, lag, and making a target agree with a source that has lost recent writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import ts_increment, ts_seconds
from tidelog.operators.fields import ruled_doc
from tidelog.operators.replay import KEYS
from tidelog.operators.routing import Rules


def log_bounds(log: DataFrame) -> DataFrame:
    """(replset, oldest, newest) without no-ops."""
    return log.where("op <> 'n'").groupBy("replset").agg(F.min("ts").alias("oldest"), F.max("ts").alias("newest"))


def seed_checkpoint(log: DataFrame) -> DataFrame:
    """Checkpoints at the end of each log, no-ops included."""
    return log.groupBy("replset").agg(F.max("ts").alias("ts"))


def resume_decision(log: DataFrame, checkpoints: DataFrame, noops: bool = False) -> DataFrame:
    """(replset, ts, decision): dump without a checkpoint; rollback if nothing is left from it on; unrecoverable if it
    fell off the log; rollback if its own entry is gone; else continue.  With ``noops``, a checkpoint may be at a no-op, as those of a stream are."""
    held = checkpoints.select("replset", F.col("ts").alias("cp"))
    own = (log if noops else log.where("op <> 'n'")).join(held, "replset", "left")
    seen = own.groupBy("replset").agg(
        F.min("ts").alias("oldest"), F.count_if(F.col("ts") >= F.col("cp")).alias("tail"), F.max(F.col("ts") == F.col("cp")).alias("there")
    )
    decision = (
        F.when(F.col("cp").isNull(), "dump")
        .when(F.coalesce("tail", F.lit(0)) == 0, "rollback")
        .when(F.col("cp") < F.col("oldest"), "unrecoverable")
        .when(~F.col("there"), "rollback")
        .otherwise("continue")
    )
    return seen.join(held, "replset", "full").select("replset", F.col("cp").alias("ts"), decision.alias("decision"))


def replication_lag(log: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(replset, status, lag): nothing if the checkpoint is ahead; seconds if they differ, else increments."""
    held = checkpoints.select("replset", F.col("ts").alias("cp"))
    both = log_bounds(log).join(held, "replset")
    seconds = ts_seconds(F.col("newest")) - ts_seconds(F.col("cp"))
    steps = ts_increment(F.col("newest")) - ts_increment(F.col("cp"))
    status = F.when(F.col("cp") > F.col("newest"), "ahead").when(seconds != 0, "seconds").when(steps != 0, "entries").otherwise("up_to_date")
    lag = F.when(F.col("cp") > F.col("newest"), None).when(seconds != 0, seconds).otherwise(steps)
    return both.select("replset", status.alias("status"), lag.alias("lag"))


def search_range(state: DataFrame, start: int, end: int) -> DataFrame:
    """Target rows with start <= _ts <= end; reaches the scan of a stored state."""
    return state.where(F.col("_ts").between(start, end))


def last_doc(state: DataFrame) -> DataFrame:
    """The newest row of a target; an empty target has none."""
    return state.orderBy(F.desc("_ts"), "ns", "_id").limit(1)


def rollback_cutoff(log: DataFrame, *targets: DataFrame, replsets: list[str] | None = None) -> DataFrame:
    """(newest, cutoff): the targets' newest _ts, and the newest log entry not after it; both null for empty targets.

    With ``replsets``, the logs that lost writes: each has its own newest entry, and the least of these is the cutoff.
    """
    last = targets[0].agg(F.max("_ts").alias("newest"))
    for t in targets[1:]:
        last = last.unionByName(t.agg(F.max("_ts").alias("newest")))
    last = last.agg(F.max("newest").alias("newest"))
    own = log.where("op <> 'n'")
    own = (own if replsets is None else own.where(F.col("replset").isin(replsets))).join(F.broadcast(last), F.col("ts") <= F.col("newest"))
    if replsets is None:
        return own.agg(F.max("newest").alias("newest"), F.max("ts").alias("cutoff"))
    each = own.groupBy("replset").agg(F.max("newest").alias("newest"), F.max("ts").alias("cutoff"))
    return each.agg(F.max("newest").alias("newest"), F.min("cutoff").alias("cutoff"))


def rollback_suspects(state: DataFrame, log: DataFrame, replsets: list[str] | None = None) -> DataFrame:
    """Target rows from the cutoff to the newest _ts, tombstones included."""
    bounds = rollback_cutoff(log, state, replsets=replsets).first()
    return search_range(state, bounds.cutoff, bounds.newest) if bounds.cutoff is not None else state.where("false")


def source_rows(keys: DataFrame, source: DataFrame, rules: Rules | None = None) -> DataFrame:
    """(ns, _id, doc): the source's documents of target keys (ns, _id), found under their source names, reduced to their rule's fields."""
    if rules is None:
        return source.join(keys.select(*KEYS), KEYS, "left_semi").select("ns", "_id", "doc")
    ns = F.col("ns")
    named = keys.select("ns", "_id", F.coalesce(rules.unmap(ns), ns).alias("_from"))
    found = named.join(source.select(ns.alias("_from"), "_id", "doc"), ["_from", "_id"])
    return found.select("ns", "_id", ruled_doc(F.col("doc"), rules.route(F.col("_from")).rule, rules).alias("doc"))


def reconcile(state: DataFrame, log: DataFrame, source: DataFrame, rules: Rules | None = None, replsets: list[str] | None = None) -> dict[str, DataFrame]:
    """deletes, upserts and the state after them, for a ``source`` snapshot (ns, _id, doc) that has lost writes.

    Suspects that the source has no more are deleted; the others get its version, stamped with the cutoff.  ``rules`` are those the
    target was made with: suspects are looked up under their source names.  ``replsets`` are the logs that lost writes (null: all as one).
    """
    bounds = rollback_cutoff(log, state, replsets=replsets).first()
    if bounds.cutoff is None:
        return {"deletes": state.where("false"), "upserts": state.where("false"), "state": state}
    suspects = search_range(state, bounds.cutoff, bounds.newest)
    cutoff = F.lit(bounds.cutoff)
    upserts = source_rows(suspects, source, rules).select("ns", "_id", "doc", cutoff.alias("_ts"), F.lit(False).alias("deleted"))
    deletes = suspects.join(upserts.select(*KEYS), KEYS, "left_anti")
    untouched = state.where((F.col("_ts") < cutoff) | (F.col("_ts") > bounds.newest))
    out = {"deletes": deletes, "upserts": upserts}
    return out | {"state": untouched.unionByName(upserted_and_gone(out, bounds.cutoff))}


def upserted_and_gone(found: dict[str, DataFrame], cutoff: int | None = None) -> DataFrame:
    """The rows that a rollback writes: the source's versions, and tombstones (at the cutoff, or at their own time)."""
    ts = F.col("_ts") if cutoff is None else F.lit(cutoff)
    gone = found["deletes"].select("ns", "_id", F.lit(None).cast("variant").alias("doc"), ts.alias("_ts"), F.lit(True).alias("deleted"))
    return found["upserts"].select("ns", "_id", "doc", "_ts", "deleted").unionByName(gone)


def op_counters(log: DataFrame) -> DataFrame:
    """(ns, removed, upserted, updated)."""
    return log.groupBy("ns").agg(
        F.count_if(F.col("op") == "d").alias("removed"), F.count_if(F.col("op") == "i").alias("upserted"), F.count_if(F.col("op") == "u").alias("updated")
    )
