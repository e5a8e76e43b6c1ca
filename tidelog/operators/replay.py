"""From a change log to current documents.

State: ns, _id, doc (VARIANT), _ts (of the last entry applied), deleted (a tombstone, without doc).

Flat replay needs no order within a task: the last entry that gives or takes a field wins, unless a
later whole document or delete (a barrier) hides it.  Both are ``max_by`` aggregations, combined
before the shuffle, so a document with very many entries costs one row for each task and field.
Nested replay (dotted paths, array positions) depends on order; it sorts by (ns, _id, ts) and folds the
sorted rows as they stream by, so a document's entries are never gathered either.  ``replay_documents`` does the one for
documents whose updates hold a dotted path, the other for all others; a narrow pass finds those documents first.

A state that a log goes on from takes part as entries of its own kind (``si`` and ``sd``): barriers at the time of the row, which
hide entries up to and including that time.  Keys may be of any type that can be grouped by; the log's schema says which.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.functions.folders import stored
from tidelog.functions.scalars import ns_db
from tidelog.functions.variants import VARIANT, from_python, to_python

STATE_SCHEMA = "ns STRING, _id BIGINT, doc VARIANT, _ts BIGINT, deleted BOOLEAN"
#: Entries that stand for rows of a state: documents and tombstones.
HELD, HELD_GONE = "si", "sd"
KEYS = ["ns", "_id"]
FIRST_TS, LAST_TS = -(1 << 63), (1 << 63) - 1
MAP = "map<string,variant>"
MAX_INDEX = 1 << 16


def kind() -> Column:
    """insert, replace, delta, delete, command or noop; null for other codes."""
    delta = F.col("set").isNotNull() | F.col("unset").isNotNull()
    return (
        F.when(F.col("op").isin("i", HELD), "insert")
        .when(F.col("op").isin("d", HELD_GONE), "delete")
        .when((F.col("op") == "u") & delta, "delta")
        .when(F.col("op") == "u", "replace")
        .when(F.col("op") == "c", "command")
        .when(F.col("op") == "n", "noop")
    )


def is_whole() -> Column:
    return kind().isin("insert", "replace")


def is_barrier() -> Column:
    return kind().isin("insert", "replace", "delete")


def is_change() -> Column:
    """Whether an entry is about a document."""
    return kind().isin("insert", "replace", "delta", "delete")


def is_held() -> Column:
    """Whether an entry stands for a row of a state."""
    return F.col("op").isin(HELD, HELD_GONE)


def is_nested() -> Column:
    """Whether an update holds a dotted path."""
    dotted = lambda path: F.contains(path, F.lit("."))
    given, taken = F.exists(F.map_keys("set"), dotted), F.exists("unset", dotted)
    return F.coalesce(given, F.lit(False)) | F.coalesce(taken, F.lit(False))


def field_changes(log: DataFrame) -> DataFrame:
    """(ns, _id, ts, held, field, value, gone): a row for each whole write or delete (field null, value its document), and one
    for each field an update gives or takes."""
    row = lambda field, value, gone: F.struct(field.alias("field"), value.alias("value"), gone.alias("gone"))
    null = F.lit(None)
    none = F.array().cast("array<struct<field:string,value:variant,gone:boolean>>")
    whole = F.array(row(null.cast("string"), F.col("o"), kind() == "delete"))
    given = F.transform(F.map_entries("set"), lambda e: row(e.key, e.value, F.lit(False)))
    taken = F.transform("unset", lambda f: row(f, null.cast("variant"), F.lit(True)))
    delta = F.concat(F.coalesce(given, none), F.coalesce(taken, none))
    changes = F.when(is_barrier(), whole).when(kind() == "delta", delta)
    own = log.where(is_change()).select("ns", "_id", "ts", is_held().alias("held"), F.explode(changes).alias("c"))
    return own.select("ns", "_id", "ts", "held", "c.*")


def replay_flat(log: DataFrame) -> DataFrame:
    """State after a log whose updates name top-level fields only."""
    order = F.struct("ts", "held", "gone")
    last = field_changes(log).groupBy("ns", "_id", "field").agg(F.max_by("value", order).alias("value"), F.max(order).alias("at"))
    own = F.col("field").isNull()
    doc = last.groupBy(*KEYS).agg(
        F.max(F.when(own, F.col("at"))).alias("b"),
        F.first(F.when(own, F.col("value")), ignorenulls=True).alias("base"),
        F.collect_list(F.when(~own, F.struct("field", "value", "at"))).alias("fields"),
    )
    live = doc.where("b is not null").withColumn("fields", F.filter("fields", lambda f: (f.at.ts > F.col("b.ts")) | ((f.at.ts == F.col("b.ts")) & ~F.col("b.held"))))
    names = F.transform("fields", lambda f: f.field)
    kept = F.map_filter(F.try_variant_get("base", "$", MAP), lambda k, _: ~F.array_contains(names, k))
    given = F.map_from_entries(F.transform(F.filter("fields", lambda f: ~f.at.gone), lambda f: F.struct(f.field.alias("key"), f.value.alias("value"))))
    newest = F.greatest(F.col("b.ts"), F.array_max(F.transform("fields", lambda f: f.at.ts)))
    gone = F.col("b.gone")
    return live.select(
        "ns", "_id",
        F.when(~gone, F.to_variant_object(F.map_concat(F.coalesce(kept, F.create_map().cast(MAP)), given))).alias("doc"),
        F.when(gone, F.col("b.ts")).otherwise(newest).alias("_ts"),
        gone.alias("deleted"),
    )


def visible(state: DataFrame) -> DataFrame:
    return state.where("not deleted").drop("deleted")


def latest_per_key(rows: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The newest row of each key, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), ts).alias("r")).select(*keys, "r.*")


#: A document's entries are looked at in so many stretches of time, cut where the log's entries are spread evenly.
STRETCHES = 64


def orphans(log: DataFrame) -> DataFrame:
    """(ns, _id, ts, op) of partial updates whose document doesn't exist at their time.

    Whether it does is decided by the last whole write or delete before.  Time is cut into stretches of about as many entries each, so that a
    document which holds a large part of them is dealt to many tasks; each stretch begins with what the ones before it end with, of
    which a document has ``STRETCHES`` at most.
    """
    own = log.where(is_change()).select(*KEYS, "ts", "op", kind().alias("kind"), is_held().alias("held"))
    cuts = own.agg(F.percentile_approx("ts", [k / STRETCHES for k in range(1, STRETCHES)], 10_000)).first()[0] or []
    cuts = F.array(*map(F.lit, sorted(set(cuts)))) if cuts else F.array().cast("array<bigint>")
    dealt = own.withColumn("part", F.size(F.filter(cuts, lambda c: F.col("ts") > c)))
    barrier = F.col("kind") != "delta"
    ends = dealt.groupBy(*KEYS, "part").agg(
        # a flag and not the kind, so that Spark groups by hash: texts would be sorted
        F.max_by(F.when(barrier, F.col("kind") == "delete"), F.when(barrier, F.col("ts"))).alias("end"), F.max(F.when(F.col("held"), F.col("ts"))).alias("held_ts")
    )
    document = Window.partitionBy(*KEYS)
    before = document.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    null, gone = F.lit(None), F.last("end", ignorenulls=True).over(before)
    carried = ends.select(
        *KEYS, null.cast("long").alias("ts"), null.cast("string").alias("op"), F.when(gone, "delete").when(~gone, "insert").alias("kind"),
        "part", F.max("held_ts").over(document).alias("held_ts"),
    )
    rows = carried.unionByName(dealt.drop("held").withColumn("held_ts", null.cast("long")))
    earlier = Window.partitionBy(*KEYS, "part").orderBy(F.col("ts").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    base = F.last(F.when(barrier, F.col("kind")), ignorenulls=True).over(earlier)
    held_ts = F.last("held_ts", ignorenulls=True).over(earlier)
    found = rows.withColumns({"base": base, "held_ts": held_ts}).where("kind = 'delta' and ts is not null and (base is null or base = 'delete')")
    return found.where("held_ts is null or ts > held_ts").select(*KEYS, "ts", "op")


def state_as_log(state: DataFrame) -> DataFrame:
    """A state's rows as entries at their own time."""
    null = F.lit(None)
    return state.select(
        F.col("_ts").alias("ts"), null.cast("string").alias("replset"), null.cast("long").alias("event_id"),
        F.when(F.col("deleted"), HELD_GONE).otherwise(HELD).alias("op"), "ns", "_id", F.lit(False).alias("from_migrate"),
        F.col("doc").alias("o"), null.cast(MAP).alias("set"), null.cast("array<string>").alias("unset"),
    )


def apply_incremental(state: DataFrame, log: DataFrame, replay: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The state after more of the log.  Entries the state has seen lie behind its rows' barriers, so applying twice changes nothing.

    Commands in the log (``c`` entries) void or move what the state and the log have from before them.
    """
    before, signs = state_as_log(state), signs_of(log)
    return with_signs(replay or replay_documents, apply_commands(before.unionByName(log.select(*before.columns)), signs.commands), signs)


def snapshot_state(snap: DataFrame, ts: int) -> DataFrame:
    """A snapshot's documents (ns, _id, doc) as a state of one time."""
    return snap.select("ns", "_id", "doc", F.lit(ts).cast("long").alias("_ts"), F.lit(False).alias("deleted"))


def snapshot_plus_log(snap: DataFrame, ts: int, log: DataFrame, replay: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A snapshot taken at ``ts`` or later, brought up to date."""
    return (replay or replay_documents)(state_as_log(snapshot_state(snap, ts)).unionByName(log.where(F.col("ts") > ts)))


# nested updates


class UpdateError(ValueError):
    """An update that can't be applied; the document stays as it is."""


def _index(name: str, size: int | None) -> int:
    if not (name.isascii() and name.isdigit()) or (size is not None and int(name) >= size) or int(name) >= MAX_INDEX:
        raise UpdateError(f"no such array position: {name}")
    return int(name)


def _parent(doc: object, names: list[str], create: bool) -> object:
    """The container that holds the last of ``names``.

    With ``create``, maps that are missing on the way are made, also past an array's end; else they are a KeyError.
    """
    for name in names[:-1]:
        if isinstance(doc, list):
            k = _index(name, None if create else len(doc))
            if k >= len(doc):
                doc += [None] * (k - len(doc)) + [{}]
            doc = doc[k]
        elif isinstance(doc, dict):
            if name not in doc and not create:
                raise KeyError(name)
            doc = doc.setdefault(name, {})
        else:
            raise UpdateError(f"{name} lies below a value that isn't a container")
    if not isinstance(doc, (dict, list)):
        raise UpdateError(f"{names[-1]} lies below a value that isn't a container")
    return doc


def apply_delta(doc: dict, sets: dict | None, unsets: list | None, missing_unset: str = "ignore") -> dict:
    """``doc`` after ``$set`` and then ``$unset``; either all of it is applied or UpdateError is raised.

    Setting past an array's end pads it with nulls; unsetting a position leaves a null.
    """
    doc = dict(doc)
    for top in {path.split(".")[0] for path in (*(sets or ()), *(unsets or ()))} & doc.keys():
        doc[top] = copy.deepcopy(doc[top])  # a failing update leaves the document as it was
    for path, value in (sets or {}).items():
        names = path.split(".")
        held = _parent(doc, names, create=True)
        if isinstance(held, list):
            k = _index(names[-1], None)
            held.extend([None] * (k + 1 - len(held)))
            held[k] = value
        else:
            held[names[-1]] = value
    for path in unsets or ():
        names = path.split(".")
        try:
            held = _parent(doc, names, create=False)
            if isinstance(held, list):
                held[_index(names[-1], len(held))] = None
            else:
                del held[names[-1]]
        except (KeyError, UpdateError) as problem:
            if missing_unset == "error":
                raise UpdateError(f"nothing to unset at {path}") from problem
    return doc


#: Updates of a document that wait for whether a whole write or a delete comes after them.
WAITING = 256


def fold(log: DataFrame, missing_unset: str = "ignore", every: bool = True) -> DataFrame:
    """The sequential fold: rows of state (reason null) and of rejects (reason set).

    One shuffle; the sorted entries stream by.  Without ``every``, updates that a later whole write or delete hides aren't looked at,
    nor are their rejects found.  Documents keep the types of their values.
    """
    names = ["ns", "_id", "doc", "_ts", "deleted", "op", "reason"]
    key = log.schema["_id"].dataType
    kinds = [pa.string(), to_arrow_type(key), VARIANT, pa.int64(), pa.bool_(), pa.string(), pa.string()]
    limit = 0 if every else WAITING

    class Document:
        """One document while its entries go by: ``raw`` until an update needs its values."""

        def __init__(self, key: tuple | None):
            self.key, self.raw, self.doc, self.ts, self.deleted, self.waiting, self.seen = key, None, None, None, None, [], FIRST_TS

        def whole(self, raw: dict | None, ts: int) -> None:
            self.raw, self.doc, self.ts, self.deleted, self.waiting = raw, None, ts, raw is None, []

        def update(self, ts: int, sets: list, unsets: list, out: list) -> None:
            self.waiting.append((ts, sets, unsets))
            if len(self.waiting) > limit:
                self.settle(out)

        def settle(self, out: list) -> None:
            for ts, sets, unsets in self.waiting:
                if self.deleted is not False:
                    out.append((*self.key, None, ts, None, "u", "no_base"))
                    continue
                self.doc, self.raw = to_python(self.raw) if self.raw is not None else self.doc, None
                try:
                    self.doc, self.ts = apply_delta(self.doc, {k: to_python(v) for k, v in sets or ()}, unsets, missing_unset), ts
                except UpdateError:
                    out.append((*self.key, None, ts, None, "u", "bad_update"))
            self.waiting = []

        def done(self, out: list) -> None:
            self.settle(out)
            if self.deleted is not None:
                value = None if self.deleted else self.raw if self.raw is not None else from_python(self.doc)
                out.append((*self.key, value, self.ts, self.deleted, None, None))

    def batch(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def folded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = Document(None), []
        for part in parts:
            for ns, id_, ts, what, o, sets, unsets, at, own in zip(*(part.column(i).to_pylist() for i in range(9))):
                if (ns, id_) != held.key:
                    if held.key is not None:
                        held.done(out)
                    held = Document((ns, id_))
                if what == "seen":
                    held.seen = at
                elif ts <= held.seen and not own:
                    continue
                elif what == "delta":
                    held.update(ts, sets, unsets, out)
                else:
                    held.whole(None if what == "delete" else o, ts)
            if len(out) > 10_000:
                yield batch(out)
                out = []
        if held.key is not None:
            held.done(out)
        if out:
            yield batch(out)

    # before all entries of a document comes what its row of the state has seen
    twice = F.explode(F.when(is_held(), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False))))
    own = log.where(is_change()).select("ns", "_id", "ts", kind().alias("kind"), "o", "set", "unset", F.col("ts").alias("at"), is_held().alias("held"), twice.alias("first"))
    first = F.col("first")
    own = own.withColumns({"kind": F.when(first, "seen").otherwise(F.col("kind")), "ts": F.when(first, FIRST_TS).otherwise(F.col("ts")), "o": F.when(~first, F.col("o"))}).drop("first")
    rows = own.repartition(*KEYS).sortWithinPartitions(*KEYS, "ts", "held")
    return rows.mapInArrow(folded, f"ns string, _id {key.simpleString()}, doc variant, _ts long, deleted boolean, op string, reason string")


def after_barrier(log: DataFrame) -> DataFrame:
    """Only the entries that can show: from each document's last whole write or delete on."""
    last = log.where(is_barrier()).groupBy(*KEYS).agg(F.max("ts").alias("_barrier"))
    return log.join(last, KEYS).where("ts >= _barrier").drop("_barrier")


def replay_nested(log: DataFrame) -> DataFrame:
    """State after a log with dotted paths and array positions."""
    return fold(log, every=False).where("reason is null").select("ns", "_id", "doc", "_ts", "deleted")


def rejected_of(folded: DataFrame) -> DataFrame:
    return folded.where("reason is not null").select(*KEYS, F.col("_ts").alias("ts"), "op", "reason")


class Replayed(NamedTuple):
    """What becomes of a log: the documents, and (ns, _id, ts, op, reason) of the entries that can't be applied."""

    state: DataFrame
    rejects: DataFrame


class Signs(NamedTuple):
    """What has to be known of a log before it is replayed: its commands, and (ns, _id) of documents with an update on a dotted path (None: there are none)."""

    commands: list
    nested: DataFrame | None


def signs_of(log: DataFrame) -> Signs:
    """One narrow pass over a log's commands and update columns; what it finds is a stored table.  The documents are under the names the commands leave them."""
    update = (F.col("op") == "u") & is_nested()
    found = stored(log.where((F.col("op") == "c") | update).select("ts", "op", *KEYS, F.when(F.col("op") == "c", F.col("o")).alias("o")), "signs")
    commands = commands_in(found)
    keys = found.where("op = 'u'")
    return Signs(commands, apply_commands(keys, commands).select(*KEYS).distinct() if keys.limit(1).count() else None)


def split_nested(log: DataFrame, signs: Signs | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The entries of documents without dotted paths, and of those with them (None if there are none).

    Where the keys are few, Spark broadcasts them (their table's size is known), so the log isn't shuffled for this.
    """
    keys = (signs or signs_of(log.where("op <> 'c'"))).nested
    if keys is None:
        return log, None
    return log.join(keys, KEYS, "left_anti"), log.join(keys, KEYS, "left_semi")


def replay_documents(log: DataFrame, signs: Signs | None = None) -> DataFrame:
    """State after any log: documents whose updates hold dotted paths are folded, all others go the flat way.  ``signs`` are the log's, where they are known."""
    flat, nested = split_nested(log, signs)
    return replay_flat(flat) if nested is None else replay_flat(flat).unionByName(replay_nested(nested))


def replay_all(log: DataFrame, signs: Signs | None = None) -> Replayed:
    """State and rejects after any log; what is folded is folded once, for both."""
    flat, nested = split_nested(log, signs)
    state, bad = replay_flat(flat), orphans(flat).withColumn("reason", F.lit("no_base"))
    if nested is None:
        return Replayed(state, bad)
    folded = stored(fold(nested), "folded")
    kept = folded.where("reason is null").select("ns", "_id", "doc", "_ts", "deleted")
    return Replayed(state.unionByName(kept), bad.unionByName(rejected_of(folded)))


def with_signs(replay: Callable[..., DataFrame], log: DataFrame, signs: Signs) -> DataFrame:
    """``replay`` of a log whose signs are known; replays of one kind don't ask for them."""
    return replay_documents(log, signs) if replay is replay_documents else replay(log)


def rejects(log: DataFrame) -> DataFrame:
    """(ns, _id, ts, op, reason) of entries that can't be applied."""
    return replay_all(log).rejects


# commands

COMMAND = "struct<what:string,name:string,new:string>"
#: Commands are rare; their names and times are planned on the driver, so many in one go.
AT_ONCE = 20_000
Command = tuple[int, str, str, str | None]


def command_of() -> Column:
    """struct(what, name, new) of a ``c`` entry, from its document and the database of its namespace: drop and rename name collections,
    dropDatabase a database; null for creations and others, which change no document."""
    o, db = F.col("o"), ns_db(F.col("ns"))
    named = lambda what, name, new=F.lit(None).cast("string"): F.struct(F.lit(what).alias("what"), name.alias("name"), new.alias("new"))
    text = lambda path: F.try_variant_get(o, path, "string")
    found = (
        F.when(F.try_variant_get(o, "$.dropDatabase", "variant").isNotNull(), named("dropDatabase", db))
        .when(text("$.renameCollection").isNotNull(), named("rename", text("$.renameCollection"), text("$.to")))
        .when(text("$.drop").isNotNull(), named("drop", F.concat(db, F.lit("."), text("$.drop"))))
    )
    return F.when(F.col("op") == "c", found)


def commands_in(log: DataFrame) -> list[Command]:
    """(ts, what, name, new) of a log's commands, by time."""
    rows = log.where(F.col("op") == "c").withColumn("c", command_of()).where("c is not null").select("ts", "c.*").distinct().collect()
    return sorted(map(tuple, rows), key=lambda c: (c[0], c[1:3]))


def epochs(names: list[str], commands: list[Command]) -> list[tuple[str, int, int, str | None]]:
    """(ns, from, to, final name): what becomes of entries of ``ns`` made in [from, to); null if a later command voids them.

    Commands are (ts, drop | rename | dropDatabase, name, new name).
    """
    bounds = [-(1 << 63), *sorted({c[0] for c in commands}), LAST_TS]
    out = []
    for ns in names:
        for start, end, final in _finals(commands, [ns])[ns]:
            cuts = [start, *(b for b in bounds if start < b < end), end]
            out += [(ns, a, b, final) for a, b in zip(cuts, cuts[1:])]
    return out


def _finals(commands: list[Command], names: list[str]) -> dict[str, list[tuple[int, int, str | None]]]:
    """For each name, (from, to, final name) in order.  Goes back in time: what becomes of an entry made before a command is what
    becomes of one made after it, but for the names the command touches."""
    touched = {*names, *(name for _, what, name, _ in commands if what != "dropDatabase"), *(new for *_, new in commands if new)}
    final: dict[str, str | None] = {name: name for name in touched}
    until = dict.fromkeys(touched, LAST_TS)
    out: dict[str, list[tuple[int, int, str | None]]] = {name: [] for name in touched}
    by_db: dict[str, list[str]] = {}
    for name in touched:
        by_db.setdefault(name.partition(".")[0], []).append(name)
    for ts, what, name, new in sorted(commands, key=lambda c: (c[0], c[1:3]), reverse=True):
        for own in by_db.get(name, ()) if what == "dropDatabase" else (name,):
            before = final[new] if what == "rename" else None
            if before != final[own]:
                if ts < until[own]:
                    out[own].append((ts, until[own], final[own]))
                    until[own] = ts
                final[own] = before
    for name in touched:
        out[name].append((-(1 << 63), until[name], final[name]))
        out[name].reverse()
    return out


def apply_commands(log: DataFrame, commands: list[Command] | None = None) -> DataFrame:
    """The log as if collections had always had their final names, without entries of what was dropped, and without its ``c`` entries.

    ``commands`` are the log's own where none are given.  Namespaces that a drop or a rename names get epochs; for all others the time their
    database was last dropped decides.  Both tables have a row for each command or so and are broadcast.
    """
    commands = commands_in(log) if commands is None else sorted(commands, key=lambda c: (c[0], c[1:3]))
    log = log.where(F.col("op") != "c")
    for k in range(0, len(commands), AT_ONCE):
        # what one slice has renamed or voided is what the next one finds
        log = _commanded(log, commands[k : k + AT_ONCE])
    return log


def _commanded(log: DataFrame, commands: list[Command]) -> DataFrame:
    spark, dropped = log.sparkSession, {}
    for ts, what, name, _ in sorted(commands, key=lambda c: c[0]):
        if what == "dropDatabase":
            dropped[name] = ts
    rows = [(ns, *epoch) for ns, own in _finals(commands, []).items() for epoch in own]
    table = spark.createDataFrame(rows, "_ns string, _from long, _to long, _final string")
    during = (F.col("ns") == F.col("_ns")) & (F.col("ts") >= F.col("_from")) & (F.col("ts") < F.col("_to"))
    joined = log.join(F.broadcast(table), during, "left").where("_ns is null or _final is not null")
    gone = spark.createDataFrame(list(dropped.items()), "_db string, _dropped long")
    joined = joined.join(F.broadcast(gone), ns_db(F.col("ns")) == F.col("_db"), "left").where("_ns is not null or _dropped is null or ts >= _dropped")
    return joined.withColumn("ns", F.coalesce("_final", "ns")).drop("_ns", "_from", "_to", "_final", "_db", "_dropped")
