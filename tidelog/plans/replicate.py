"""Replication as one plan: snapshot, log, routing, projection, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.fields import ruled_doc
from tidelog.operators.predicates import prepare
from tidelog.operators.replay import Replayed, Signs, apply_commands, replay_all, replay_documents, signs_of, snapshot_state, state_as_log, with_signs
from tidelog.operators.routing import Rule, Rules, matches

#: Rules over the derived log; they exercise every kind.
RULES = Rules(
    (
        Rule("shop0.*", "target0.*"),
        Rule("shop1.users", "people.main", include=("value",)),
        Rule("shop2.*", excluded=True),
        Rule("shop3.*", exclude=("flag",)),
        Rule("shop4.*"),
        Rule("shop4.fs", gridfs=True),
    )
)


def snapshot(snap: DataFrame, rules: Rules, ts: int | None) -> DataFrame:
    """Every included collection's documents with their target names, stamped ``ts``; without a log (null ts), none."""
    if ts is None:
        return snapshot_state(snap.where("false"), 0)
    routed = snap.withColumn("r", rules.route(F.col("ns"))).where("r is not null")
    return snapshot_state(routed.select(F.col("r.dest").alias("ns"), "_id", ruled_doc(F.col("doc"), F.col("r.rule"), rules).alias("doc")), ts)


def entries(log: DataFrame, rules: Rules, snap: DataFrame | None = None, ts: int | None = None, mode: str = "dump+tail") -> tuple[DataFrame, Signs]:
    """What is to be replayed for the targets (the snapshot's documents and the log's entries, commands applied) and its signs; ``mode`` is dump+tail, tail or dump."""
    parts, signs = [], Signs([], None)
    if mode != "tail" and snap is not None:
        parts.append(state_as_log(snapshot(snap, rules, ts)))
    if mode != "dump":
        own = prepare(log if ts is None or mode == "tail" else log.where(F.col("ts") > ts), rules)
        signs = signs_of(own)
        parts.append(own.select("ts", "replset", "event_id", "op", "ns", "_id", "from_migrate", "o", "set", "unset"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return apply_commands(out, signs.commands), signs


def replicate(log: DataFrame, rules: Rules, snap: DataFrame | None = None, ts: int | None = None, mode: str = "dump+tail", replay=replay_documents) -> DataFrame:
    """The targets' state (files by their metadata).  The log is read once; its commands and the keys of nested documents, a narrow second time."""
    return with_signs(replay, *entries(log, rules, snap, ts, mode))


def replicate_all(log: DataFrame, rules: Rules, snap: DataFrame | None = None, ts: int | None = None, mode: str = "dump+tail") -> Replayed:
    """The targets' state, and the entries that can't be applied."""
    return replay_all(*entries(log, rules, snap, ts, mode))


def with_files(state: DataFrame, rules: Rules) -> DataFrame:
    """A state with gridfs_id: the file's id in collections of files, else null."""
    is_file = F.lit(False)
    for rule in rules.included:
        if rule.gridfs:
            is_file = is_file | matches(F.col("ns"), rule.target)
    return state.withColumn("gridfs_id", F.when(is_file & ~F.col("deleted"), F.col("_id")))


def resume_scan(snap: DataFrame, ns: str, last_id: int | None = None, rules: Rules | None = None) -> DataFrame:
    """A collection's documents in order of _id, after ``last_id`` where a scan broke off, reduced to its rule's fields."""
    own = snap.where(F.col("ns") == ns)
    own = own if last_id is None else own.where(F.col("_id") > last_id)
    return (own if rules is None else routed_documents(own, rules)).orderBy("_id")


def routed_documents(snap: DataFrame, rules: Rules) -> DataFrame:
    """(ns, _id, doc) of the replicated documents, under their source names, reduced to their rules' fields."""
    routed = snap.withColumn("r", rules.route(F.col("ns"))).where("r is not null")
    return routed.select("ns", "_id", ruled_doc(F.col("doc"), F.col("r.rule"), rules).alias("doc"))
