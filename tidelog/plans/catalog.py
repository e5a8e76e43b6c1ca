"""Registered queries over the driver's tables, each with its SQL.

Every query derives its log, state or files from the tables it is given; the SQL is written
independently of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.folders import stored
from tidelog.functions.scalars import find_field, key_matches, ns_coll, ns_db, pack_ts, ts_increment, ts_seconds
from tidelog.operators import fields, files, formatting, predicates, reconcile, replay, routing
from tidelog.operators.routing import Rule, Rules
from tidelog.plans.replicate import RULES, replicate, snapshot, with_files
from tidelog.plans.replicate import resume_scan as scan_collection
from tidelog.plans.replicate import routed_documents
from tidelog.sinks import checkpoints, targets
from tidelog.sources.change_log import change_log, data_entries, merge_logs, n_events, resume_log, scan_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LOG_SQL = """
ev AS (SELECT *, (SELECT max(event_id) + 1 FROM events) AS n FROM events),
log AS (
  SELECT (epoch_us(ts) // 1000000) * 4294967296 + event_id AS ts, CASE WHEN user_id % 2 = 0 THEN 'rs0' ELSE 'rs1' END AS replset, event_id, n, user_id,
    CASE WHEN event_id % 97 = 0 THEN 'n' WHEN event_type = 'signup' THEN 'i' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
    'shop' || (user_id % 5) || '.' || CASE user_id % 7 WHEN 0 THEN 'system.profile' WHEN 1 THEN 'fs.files' WHEN 2 THEN 'fs.chunks' WHEN 3 THEN 'users' WHEN 4 THEN 'carts' ELSE 'orders' END AS ns,
    user_id AS _id, event_id % 89 = 0 AS from_migrate, value, regexp_extract(props, '(\\d+)', 1)::BIGINT AS k, event_type AS flag,
    CASE WHEN event_id % 97 = 0 THEN 'noop' WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'error' THEN 'delete' WHEN event_type = 'view' THEN 'replace' ELSE 'delta' END AS kind
  FROM ev),
data AS (SELECT * FROM log WHERE op <> 'n' AND user_id % 7 IN (3, 4, 5, 6))
"""


def flat_sql(source: str) -> str:
    """State rows of a flat replay of ``source``: ns, _id, value, flag, k, _ts, deleted."""
    return f"""
  SELECT ns, _id, CASE WHEN any_value(bkind) <> 'delete' THEN arg_max(value, ts) FILTER (WHERE kind IN ('insert', 'replace') OR flag = 'purchase') END AS value,
    CASE WHEN any_value(bkind) <> 'delete' AND NOT coalesce(bool_or(kind = 'delta' AND flag = 'click'), false) THEN arg_max(flag, ts) FILTER (WHERE kind IN ('insert', 'replace')) END AS flag,
    CASE WHEN any_value(bkind) <> 'delete' THEN arg_max(k, ts) FILTER (WHERE kind IN ('insert', 'replace')) END AS k,
    CASE WHEN any_value(bkind) = 'delete' THEN max(bts) ELSE max(ts) END AS _ts, any_value(bkind) = 'delete' AS deleted
  FROM (SELECT s.*, b.bts, b.bkind FROM {source} s JOIN (SELECT ns, _id, max(ts) AS bts, arg_max(kind, ts) AS bkind FROM {source} WHERE kind IN ('insert', 'replace', 'delete') GROUP BY ALL) b USING (ns, _id) WHERE s.ts >= b.bts)
  GROUP BY ns, _id"""


# Routing of the derived namespaces by RULES, as SQL over ``nsx``.
ROUTE_SQL = """CASE WHEN nsx LIKE 'shop2.%' THEN NULL WHEN nsx = 'shop1.users' THEN 'people.main' WHEN nsx = 'shop4.fs' THEN 'shop4.fs' WHEN nsx LIKE 'shop0.%' THEN 'target0.' || substr(nsx, 7) WHEN nsx LIKE 'shop3.%' OR nsx LIKE 'shop4.%' THEN nsx END"""
SKIP_SQL = f"""
r AS (SELECT *, regexp_replace(ns, '\\.files$', '') AS nsx FROM log),
sk AS (SELECT *, {ROUTE_SQL} AS dest, CASE WHEN from_migrate THEN 'migrate' WHEN op = 'n' THEN 'noop' WHEN ns LIKE '%.system.%' THEN 'system' WHEN ns LIKE '%.chunks' THEN 'chunks'
  WHEN ns LIKE '%.files' AND nsx <> 'shop4.fs' THEN 'not_file_ns' WHEN {ROUTE_SQL} IS NULL THEN 'not_included' END AS reason FROM r)
"""


def query(sql: str | None = None, log: bool = True) -> Callable[[Query], Query]:
    """Registers a query, with SQL that may use the views of LOG_SQL."""

    def add(make: Query) -> Query:
        QUERIES[make.__name__] = make
        if sql is not None:
            SQL[make.__name__] = f"WITH {LOG_SQL}{'' if sql.lstrip().startswith(',') else ' '}{sql}" if log else sql
        return make

    return add


def scalars(state: DataFrame, doc: str = "doc") -> list:
    """A document's fields as columns."""
    d = F.col(doc)
    return [find_field(d, "value", "double").alias("value"), find_field(d, "flag", "string").alias("flag"), find_field(d, "p.k", "bigint").alias("k")]


def shown(state: DataFrame) -> DataFrame:
    return state.select("ns", "_id", *scalars(state), *(c for c in ("_ts", "deleted") if c in state.columns))


def data_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_entries(change_log(spark, sf_dir))


def half_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after the first half of the log."""
    first = data_log(spark, sf_dir).where(F.col("event_id") < n_events(spark, sf_dir) // 2)
    return replay.visible(replay.replay_flat(first)).select("ns", "_id", "doc")


def half_ts(spark: SparkSession, sf_dir: str) -> int:
    n = n_events(spark, sf_dir)
    return change_log(spark, sf_dir).where((F.col("event_id") < n // 2) & (F.col("op") != "n")).agg(F.max("ts")).first()[0]


HALF_SQL = """, hs AS (SELECT * FROM data WHERE event_id < n // 2), half AS (SELECT ns, _id, value, flag, k FROM (""" + flat_sql("hs") + """) WHERE NOT deleted),
half_ts AS (SELECT max(ts) AS t FROM log WHERE event_id < n // 2 AND op <> 'n')"""


# scans


@query("SELECT ts, replset, op, ns, _id FROM log WHERE op <> 'n' AND event_id >= n // 2")
def log_scan(spark, sf_dir):
    log = change_log(spark, sf_dir)
    since = log.where(F.col("event_id") == n_events(spark, sf_dir) // 2).first().ts
    return scan_log(log, since).select("ts", "replset", "op", "ns", "_id")


CP_SQL = """, cp AS (SELECT replset, max(ts) AS ts FROM log WHERE (replset = 'rs0' AND event_id <= n // 2) OR (replset = 'rs1' AND event_id <= n * 9 // 10) GROUP BY ALL)"""


def sample_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rs0 half way, rs1 at nine tenths."""
    n = n_events(spark, sf_dir)
    log = change_log(spark, sf_dir)
    reached = ((F.col("replset") == "rs0") & (F.col("event_id") <= n // 2)) | ((F.col("replset") == "rs1") & (F.col("event_id") <= n * 9 // 10))
    return log.where(reached).groupBy("replset").agg(F.max("ts").alias("ts"))


@query(CP_SQL + " SELECT log.ts, replset, op, ns, _id FROM log JOIN cp USING (replset) WHERE op <> 'n' AND log.ts > cp.ts")
def log_resume(spark, sf_dir):
    return resume_log(change_log(spark, sf_dir), sample_checkpoints(spark, sf_dir)).select("ts", "replset", "op", "ns", "_id")


@query("SELECT replset, ns, count(*) AS entries, min(ts) AS first_ts, max(ts) AS last_ts FROM log GROUP BY ALL")
def multi_shard_log(spark, sf_dir):
    log = change_log(spark, sf_dir)
    both = merge_logs(log.where("replset = 'rs0'"), log.where("replset = 'rs1'"))
    return both.groupBy("replset", "ns").agg(F.count("*").alias("entries"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


SNAP_SQL = HALF_SQL + f""", x AS (SELECT *, ns AS nsx FROM half), rt AS (SELECT *, {ROUTE_SQL} AS dest FROM x)"""


@query(SNAP_SQL + " SELECT dest AS ns, _id, value, CASE WHEN ns NOT LIKE 'shop3.%' AND ns <> 'shop1.users' THEN flag END AS flag, CASE WHEN ns <> 'shop1.users' THEN k END AS k, t AS _ts, false AS deleted FROM rt, half_ts WHERE dest IS NOT NULL")
def snapshot_copy(spark, sf_dir):
    return shown(snapshot(half_snapshot(spark, sf_dir), RULES, half_ts(spark, sf_dir)))


QUERIES["snapshot"], SQL["snapshot"] = QUERIES.pop("snapshot_copy"), SQL.pop("snapshot_copy")


@query(f", x AS (SELECT DISTINCT ns, regexp_replace(ns, '\\.files$', '') AS nsx FROM log), d AS (SELECT ns, {ROUTE_SQL} AS dest, ns LIKE '%.files' AS is_file, nsx FROM x WHERE ns NOT LIKE '%.system.%' AND ns NOT LIKE '%.chunks') SELECT ns, dest, is_file FROM d WHERE dest IS NOT NULL AND (NOT is_file OR nsx = 'shop4.fs')")
def discover_namespaces(spark, sf_dir):
    return routing.discover(routing.namespaces(change_log(spark, sf_dir)), RULES)


@query(HALF_SQL + " SELECT _id, ns, value, NULL::VARCHAR AS flag FROM half WHERE ns = 'shop3.orders' AND _id > 10 ORDER BY _id")
def resume_scan(spark, sf_dir):
    """A scan that broke off after _id 10; the collection's rule leaves the flag out."""
    snap = scan_collection(half_snapshot(spark, sf_dir), "shop3.orders", 10, RULES)
    return snap.select("_id", "ns", *scalars(snap)[:2])


@query(HALF_SQL + " SELECT ns, count(*) AS n FROM half GROUP BY ns")
def source_counts(spark, sf_dir):
    return half_snapshot(spark, sf_dir).groupBy("ns").agg(F.count("*").alias("n"))


@query(HALF_SQL + " SELECT ns, _id, value, flag, k FROM half SEMI JOIN (SELECT DISTINCT ns, _id FROM data WHERE event_id >= n - n // 100) USING (ns, _id)")
def fetch_by_keys(spark, sf_dir):
    n = n_events(spark, sf_dir)
    keys = data_log(spark, sf_dir).where(F.col("event_id") >= n - n // 100).select("ns", "_id")
    return shown(half_snapshot(spark, sf_dir).join(keys, ["ns", "_id"], "left_semi"))


@query(SQL["snapshot"].removeprefix(f"WITH {LOG_SQL}"))
def mode_only_dump(spark, sf_dir):
    return shown(replicate(change_log(spark, sf_dir), RULES, half_snapshot(spark, sf_dir), half_ts(spark, sf_dir), mode="dump"))


# sinks

TAIL_SQL = """, a AS (SELECT * FROM data WHERE event_id < n * 3 // 4), b AS (SELECT * FROM data WHERE event_id >= n * 3 // 4), sa AS (""" + flat_sql("a") + """),
nb AS (SELECT ns, _id, arg_max(value, ts) AS value, arg_max(flag, ts) AS flag, arg_max(k, ts) AS k, max(ts) AS _ts FROM b WHERE kind IN ('insert', 'replace') GROUP BY ALL)"""


def early_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_flat(data_log(spark, sf_dir).where(F.col("event_id") < n_events(spark, sf_dir) * 3 // 4))


def late_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_log(spark, sf_dir).where(F.col("event_id") >= n_events(spark, sf_dir) * 3 // 4)


def late_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = late_log(spark, sf_dir).where(replay.is_whole())
    return whole.select("ns", "_id", F.col("o").alias("doc"), F.col("ts").alias("_ts"), F.lit(False).alias("deleted"))


UPSERT_SQL = TAIL_SQL + " SELECT * FROM (SELECT *, false AS deleted FROM nb UNION ALL BY NAME SELECT * FROM sa ANTI JOIN nb USING (ns, _id))"


@query(UPSERT_SQL)
def upsert(spark, sf_dir):
    newest = replay.latest_per_key(late_documents(spark, sf_dir), ["ns", "_id"], "_ts")
    return shown(targets.upsert(early_state(spark, sf_dir), newest.select("ns", "_id", "doc", "_ts", "deleted")))


@query(UPSERT_SQL)
def bulk_upsert(spark, sf_dir):
    return shown(targets.upsert(early_state(spark, sf_dir), late_documents(spark, sf_dir)))


@query(", s AS (" + flat_sql("data") + ") SELECT * FROM s")
def replay_flat(spark, sf_dir):
    return shown(replay.replay_flat(data_log(spark, sf_dir)))


@query(TAIL_SQL + ", g AS (SELECT DISTINCT ns, _id FROM b WHERE op = 'd'), t AS (SELECT max(ts) AS t FROM b) SELECT ns, _id, CASE WHEN g.ns IS NULL THEN value END AS value, CASE WHEN g.ns IS NULL THEN flag END AS flag, CASE WHEN g.ns IS NULL THEN k END AS k, CASE WHEN g.ns IS NOT NULL AND NOT deleted THEN t ELSE _ts END AS _ts, deleted OR g.ns IS NOT NULL AS deleted FROM sa LEFT JOIN (SELECT *, ns AS m FROM g) g USING (ns, _id), t".replace("g.ns IS", "g.m IS"))
def remove(spark, sf_dir):
    late = late_log(spark, sf_dir)
    return shown(targets.remove(early_state(spark, sf_dir), late.where("op = 'd'"), late.agg(F.max("ts")).first()[0]))


FILES_SQL = """WITH f AS (SELECT doc_id, text, ceil(length(text) / 1024.0)::BIGINT AS pieces FROM documents)"""


@query("SELECT doc_id AS _id, 'doc-' || doc_id || '.txt' AS filename, length(text)::BIGINT AS length, md5(text) AS md5, md5(text) AS content_md5 FROM documents", log=False)
def assemble_files(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = files.assemble(files.chunk_texts(docs), files.file_table(docs))
    return whole.select("_id", "filename", "length", "md5", F.md5("content").alias("content_md5"))


def damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return files.chunk_texts(docs).where("not (n = 1 and files_id % 10 = 0)"), files.file_table(docs)


@query(FILES_SQL + " SELECT doc_id AS _id, CASE WHEN pieces > 2 THEN 'missing_chunk' ELSE 'wrong_length' END AS reason FROM f WHERE doc_id % 10 = 0 AND pieces > 1", log=False)
def broken_files(spark, sf_dir):
    return files.broken_files(*damaged(spark, sf_dir))


FILE_ENTRIES_SQL = """, e AS (SELECT doc_id AS _id, doc_id AS _ts, doc_id % 4 = 0 AS deleted, text FROM f WHERE doc_id % 4 = 0 OR NOT (doc_id % 10 = 0 AND pieces > 1))"""


def file_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert of every document as a file, and a later delete of every fourth."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    inserts = docs.select(F.lit("shop4.fs").alias("ns"), F.col("doc_id").alias("_id"), F.lit("i").alias("op"), (F.col("doc_id") - 1).alias("ts"))
    rest = inserts.withColumn("ts", F.when(F.col("_id") % 4 == 0, F.col("ts")).otherwise(F.col("_id")))
    return rest.unionByName(inserts.where("_id % 4 = 0").withColumns({"op": F.lit("d"), "ts": F.col("_id")}))


@query(FILES_SQL + FILE_ENTRIES_SQL + """ SELECT 'shop4.fs' AS ns, _id, CASE WHEN NOT deleted THEN _id END AS gridfs_id, CASE WHEN NOT deleted THEN length(text)::BIGINT END AS length,
  CASE WHEN NOT deleted THEN md5(text) END AS content_md5, _ts, deleted FROM e""", log=False)
def file_upsert(spark, sf_dir):
    """Stored files with their content; those with a lost chunk are left out."""
    chunks, table = damaged(spark, sf_dir)
    rows = files.apply_files(file_entries(spark, sf_dir), table, chunks)
    return rows.select("ns", "_id", "gridfs_id", "length", F.md5("content").alias("content_md5"), "_ts", "deleted")


@query(FILES_SQL + " SELECT doc_id AS _id, CASE WHEN doc_id % 3 = 0 THEN 'document' ELSE 'file' END AS removed FROM f WHERE doc_id % 4 = 0", log=False)
def file_remove(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    meta = files.file_table(docs).select("_id", F.when(F.col("_id") % 3 != 0, F.col("_id")).alias("gridfs_id"))
    gone = docs.where("doc_id % 4 = 0").select(F.col("doc_id").alias("_id"))
    return files.remove_keys(meta, gone)


COMMAND_SQL = """, c AS (SELECT max(ts) FILTER (WHERE event_id = n // 4) AS c1, max(ts) FILTER (WHERE event_id = n // 2) AS c2, max(ts) FILTER (WHERE event_id = n * 3 // 4) AS c3 FROM log),
moved AS (SELECT data.* REPLACE (CASE WHEN ns = 'shop1.users' AND ts < c2 THEN 'shop1.people' ELSE ns END AS ns) FROM data, c
  WHERE NOT (ns = 'shop0.carts' AND ts < c1) AND NOT (ns LIKE 'shop3.%' AND ts < c3))"""


def command_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop after a quarter of the log, a rename after half of it, and a dropped database after three quarters, as entries."""
    n, log = n_events(spark, sf_dir), change_log(spark, sf_dir)
    at, null = F.col("event_id"), F.lit(None)
    made = lambda **pairs: F.to_variant_object(F.struct(*(F.lit(v).alias(k) for k, v in pairs.items())))
    doc = F.when(at == n // 4, made(drop="carts")).when(at == n // 2, made(renameCollection="shop1.users", to="shop1.people")).otherwise(made(dropDatabase=1))
    db = F.when(at == n // 4, "shop0.$cmd").when(at == n // 2, "shop1.$cmd").otherwise("shop3.$cmd")
    return log.where(at.isin(n // 4, n // 2, n * 3 // 4)).select(
        "ts", "replset", "event_id", F.lit("c").alias("op"), db.alias("ns"), null.cast("long").alias("_id"), F.lit(False).alias("from_migrate"),
        doc.alias("o"), null.cast("map<string,variant>").alias("set"), null.cast("array<string>").alias("unset"),
    )


@query(COMMAND_SQL + ", s AS (" + flat_sql("moved") + ") SELECT * FROM s")
def apply_commands(spark, sf_dir):
    log = data_log(spark, sf_dir).unionByName(command_entries(spark, sf_dir))
    return shown(replay.replay_flat(replay.apply_commands(log)))


@query(", s AS (" + flat_sql("data") + ") SELECT ns, count(*) AS n, max(_ts) AS newest, count(*) FILTER (WHERE deleted) AS tombstones FROM s GROUP BY ns")
def meta_table(spark, sf_dir):
    state = replay.replay_flat(data_log(spark, sf_dir))
    return state.groupBy("ns").agg(F.count("*").alias("n"), F.max("_ts").alias("newest"), F.count_if("deleted").alias("tombstones"))


@query(", s AS (" + flat_sql("data") + "), c AS (SELECT max(ts) FILTER (WHERE event_id = n * 9 // 10) AS a, max(ts) AS b FROM log) SELECT ns, _id, _ts FROM s, c WHERE _ts BETWEEN a AND b")
def search_range(spark, sf_dir):
    n, log = n_events(spark, sf_dir), change_log(spark, sf_dir)
    bounds = log.agg(F.max(F.when(F.col("event_id") == n * 9 // 10, F.col("ts"))).alias("a"), F.max("ts").alias("b")).first()
    return reconcile.search_range(replay.replay_flat(data_entries(log)), bounds.a, bounds.b).select("ns", "_id", "_ts")


@query(", s AS (" + flat_sql("data") + ") SELECT ns, _id, _ts FROM s ORDER BY _ts DESC, ns, _id LIMIT 1")
def last_doc(spark, sf_dir):
    return reconcile.last_doc(replay.replay_flat(data_log(spark, sf_dir))).select("ns", "_id", "_ts")


@query(", s AS (" + flat_sql("data") + ") SELECT ns, _id AS user_key, value, flag, k, _ts, deleted FROM s")
def unique_key(spark, sf_dir):
    return targets.with_unique_key(shown(replay.replay_flat(data_log(spark, sf_dir))), "user_key")


CP_TEXT_SQL = CP_SQL + """ SELECT '[' || string_agg('["' || replset || '", ' || ts || ']', ', ' ORDER BY replset) || ']' AS progress FROM cp"""


@query(CP_TEXT_SQL)
def checkpoint_write(spark, sf_dir):
    return checkpoints.to_json(sample_checkpoints(spark, sf_dir))


@query(CP_SQL + " SELECT replset, ts FROM cp")
def checkpoint_read(spark, sf_dir):
    return checkpoints.from_json(checkpoints.to_json(sample_checkpoints(spark, sf_dir)))


ORPHAN_SQL = """, o AS (SELECT *, last_value(CASE WHEN kind IN ('insert', 'replace', 'delete') THEN kind END IGNORE NULLS) OVER (PARTITION BY ns, _id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM data)
SELECT ns, _id, ts, op, 'no_base' AS reason FROM o WHERE kind = 'delta' AND (base IS NULL OR base = 'delete')"""


@query(ORPHAN_SQL)
def rejects(spark, sf_dir):
    return replay.rejects(data_log(spark, sf_dir))


@query(HALF_SQL + " SELECT ns, _id, value >= 10 AS written FROM half")
def dump_continue_on_error(spark, sf_dir):
    good, bad = targets.split_valid(half_snapshot(spark, sf_dir), find_field(F.col("doc"), "value", "double") >= 10)
    return good.select("ns", "_id", F.lit(True).alias("written")).unionByName(bad.select("ns", "_id", F.lit(False).alias("written")))


# predicates

ENTRY = "ts", "op", "ns", "_id"


@query("SELECT ts, op, ns, _id FROM log WHERE NOT from_migrate")
def skip_migrate(spark, sf_dir):
    return change_log(spark, sf_dir).where(~predicates.is_migration()).select(*ENTRY)


@query("SELECT ts, op, ns, _id FROM log WHERE op <> 'n'")
def skip_noop(spark, sf_dir):
    return change_log(spark, sf_dir).where(~predicates.is_noop()).select(*ENTRY)


@query("SELECT ts, op, CASE WHEN event_id % 10 = 0 THEN replace(ns, '.', '_') ELSE ns END AS ns, _id FROM log WHERE event_id % 10 <> 0")
def skip_undotted(spark, sf_dir):
    log = change_log(spark, sf_dir)
    odd = log.withColumn("ns", F.when(F.col("event_id") % 10 == 0, F.replace("ns", F.lit("."), F.lit("_"))).otherwise(F.col("ns")))
    return odd.where(~predicates.is_undotted()).select(*ENTRY)


@query("SELECT ts, op, ns, _id FROM log WHERE ns NOT LIKE '%.system.%'")
def skip_system(spark, sf_dir):
    return change_log(spark, sf_dir).where(~predicates.is_system()).select(*ENTRY)


@query("SELECT ts, op, ns, _id FROM log WHERE ns NOT LIKE '%.chunks'")
def skip_chunks(spark, sf_dir):
    return change_log(spark, sf_dir).where(~predicates.is_chunks()).select(*ENTRY)


@query("SELECT ts, op, 'shop4.fs' AS ns, _id FROM log WHERE ns = 'shop4.fs.files'")
def route_files(spark, sf_dir):
    log = change_log(spark, sf_dir).where(predicates.is_file())
    routed = log.withColumn("r", RULES.route(predicates.data_ns())).where("r.gridfs")
    return routed.select("ts", "op", F.col("r.dest").alias("ns"), "_id")


@query("SELECT ts, split_part(ns, '.', 1) || '.$cmd' AS ns FROM log WHERE event_id % 20 = 1 AND NOT from_migrate AND op <> 'n'")
def route_commands(spark, sf_dir):
    log = change_log(spark, sf_dir)
    command = log.where("event_id % 20 = 1 and op <> 'n'").withColumns({"op": F.lit("c"), "ns": F.concat(ns_db(F.col("ns")), F.lit(".$cmd"))})
    return predicates.applicable(command, RULES).select("ts", "ns")


@query(", " + SKIP_SQL + " SELECT ts, op, dest AS ns, _id, ns LIKE '%.files' AS is_file FROM sk WHERE reason IS NULL")
def ns_filter(spark, sf_dir):
    return predicates.applicable(change_log(spark, sf_dir), RULES).select(*ENTRY, "is_file")


@query("SELECT ts, op, ns, _id FROM data WHERE kind <> 'delta' OR flag <> 'click'")
def drop_nullified(spark, sf_dir):
    return fields.project_log(data_log(spark, sf_dir), exclude=["flag"]).select(*ENTRY)


@query(", " + SKIP_SQL + " SELECT ts, reason FROM sk")
def skip_reason(spark, sf_dir):
    return change_log(spark, sf_dir).select("ts", predicates.skip_reason(RULES).alias("reason"))


# fields


@query("SELECT ts, value, NULL::VARCHAR AS flag, k FROM data WHERE kind IN ('insert', 'replace')")
def include_fields(spark, sf_dir):
    own = data_log(spark, sf_dir).where(replay.is_whole()).withColumn("doc", fields.include_fields(F.col("o"), ["value", "p.k", "p.none", "x.y"]))
    return own.select("ts", *scalars(own))


@query("SELECT ts, value, NULL::VARCHAR AS flag, NULL::BIGINT AS k, 0 AS left_in_p FROM data WHERE kind IN ('insert', 'replace')")
def exclude_fields(spark, sf_dir):
    own = data_log(spark, sf_dir).where(replay.is_whole()).withColumn("doc", fields.exclude_fields(F.col("o"), ["flag", "p.k"]))
    left = F.size(F.map_keys(find_field(F.col("doc"), "p", "map<string,variant>")))
    return own.select("ts", *scalars(own), left.alias("left_in_p"))


def nested_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_entries(change_log(spark, sf_dir, nested=True)).where(replay.kind() == "delta")


@query("SELECT ts, CASE WHEN flag = 'purchase' THEN 'p.k' END AS set_keys, CASE WHEN flag = 'click' THEN 'p.k' END AS unset_keys FROM data WHERE kind = 'delta' AND (flag = 'purchase' OR event_id % 2 = 0)")
def include_update_fields(spark, sf_dir):
    return update_keys(fields.project_log(nested_updates(spark, sf_dir), include=["p"]))


@query("SELECT ts, CASE WHEN flag = 'purchase' THEN 'tags.' || (user_id % 3) END AS set_keys, CASE WHEN flag = 'click' THEN 'flag' END AS unset_keys FROM data WHERE kind = 'delta' AND (flag = 'purchase' OR event_id % 2 = 1)")
def exclude_update_fields(spark, sf_dir):
    return update_keys(fields.project_log(nested_updates(spark, sf_dir), exclude=["p"]))


def update_keys(log: DataFrame) -> DataFrame:
    return log.select("ts", F.array_join(F.array_sort(F.map_keys("set")), ",").alias("set_keys"), F.array_join(F.array_sort("unset"), ",").alias("unset_keys"))


@query(SNAP_SQL + " SELECT 'documents' AS source, ns, _id, value, CASE WHEN ns NOT LIKE 'shop3.%' AND ns <> 'shop1.users' THEN flag END AS flag FROM rt WHERE dest IS NOT NULL UNION ALL SELECT 'columns', c_name, c_custkey, c_acctbal, NULL FROM customer")
def snapshot_projection(spark, sf_dir):
    """Documents reduced by their rules, and a table of known columns of which the scan reads three."""
    docs = routed_documents(half_snapshot(spark, sf_dir), RULES)
    table = fields.project_columns(spark.read.parquet(f"{sf_dir}/customer.parquet"), include=["c_name", "c_acctbal"], key="c_custkey")
    rows = table.select(F.lit("columns").alias("source"), F.col("c_name").alias("ns"), F.col("c_custkey").cast("long").alias("_id"), F.col("c_acctbal").cast("double").alias("value"), F.lit(None).cast("string").alias("flag"))
    return docs.select(F.lit("documents").alias("source"), "ns", "_id", *scalars(docs)[:2]).unionByName(rows)


@query(f", x AS (SELECT DISTINCT ns, ns AS nsx FROM log), r AS (SELECT ns, {ROUTE_SQL} AS dest FROM x) SELECT ns, CASE WHEN ns = 'shop1.users' THEN '_id,value' ELSE '' END AS include_fields, CASE WHEN ns LIKE 'shop3.%' THEN 'flag' ELSE '' END AS exclude_fields FROM r WHERE dest IS NOT NULL")
def effective_fields(spark, sf_dir):
    mapped = routing.map_namespaces(routing.namespaces(change_log(spark, sf_dir)), RULES)
    table = RULES.table(spark).select("rule", *(F.array_join(c, ",").alias(c) for c in ("include_fields", "exclude_fields")))
    return mapped.join(table, "rule").select("ns", "include_fields", "exclude_fields")


@query("SELECT ts, 'value' AS set_keys FROM data WHERE flag = 'purchase' AND kind = 'delta'")
def strip_version(spark, sf_dir):
    marked = F.map_concat("set", F.create_map(F.lit("$v"), F.lit(1).cast("variant")))
    own = data_log(spark, sf_dir).where("set is not null").withColumn("set", fields.strip_version(marked))
    return own.select("ts", F.array_join(F.array_sort(F.map_keys("set")), ",").alias("set_keys"))


# routing

NS_SQL = f", x AS (SELECT ns, ns AS nsx, count(*) AS entries FROM log GROUP BY ALL), r AS (SELECT ns, {ROUTE_SQL} AS dest, entries FROM x)"


@query(NS_SQL + " SELECT ns, dest, coalesce(ns = 'shop4.fs', false) AS gridfs FROM r WHERE dest IS NOT NULL")
def map_namespace(spark, sf_dir):
    return routing.map_namespaces(routing.namespaces(change_log(spark, sf_dir)), RULES).drop("rule")


@query("SELECT DISTINCT ns, regexp_matches(ns, '^[^.]*\\.fs\\..*$') AS fs, CASE WHEN ns LIKE 'shop3.%' THEN substr(ns, 7) ELSE '' END AS matched FROM log")
def wildcard_match(spark, sf_dir):
    names = routing.namespaces(change_log(spark, sf_dir))
    matched = F.regexp_extract("ns", routing.ns_regex("shop3.*"), 1)
    return names.select("ns", routing.matches(F.col("ns"), "*.fs.*").alias("fs"), matched.alias("matched"))


@query("SELECT DISTINCT ns FROM log WHERE ns NOT LIKE 'shop2.%' AND ns NOT LIKE '%.fs.%'")
def exclude_namespaces(spark, sf_dir):
    rules = routing.Rules((routing.Rule("shop2.*", excluded=True), routing.Rule("*.fs.*", excluded=True)))
    return routing.namespaces(change_log(spark, sf_dir)).where(~rules.is_excluded(F.col("ns")))


@query(NS_SQL + " SELECT dest, ns AS source FROM r WHERE dest IS NOT NULL")
def unmap_namespace(spark, sf_dir):
    mapped = routing.map_namespaces(routing.namespaces(change_log(spark, sf_dir)), RULES)
    return mapped.select("dest", RULES.unmap(F.col("dest")).alias("source"))


@query(NS_SQL + " SELECT DISTINCT split_part(ns, '.', 1) AS db, split_part(dest, '.', 1) AS dest_db FROM r WHERE dest IS NOT NULL")
def map_db(spark, sf_dir):
    mapped = routing.map_namespaces(routing.namespaces(change_log(spark, sf_dir)), RULES)
    each = mapped.groupBy(ns_db(F.col("ns")).alias("db")).agg(F.collect_set(ns_db(F.col("dest"))).alias("dest_dbs"))
    return each.select("db", F.explode("dest_dbs").alias("dest_db"))


@query(NS_SQL + " SELECT split_part(ns, '.', 1) AS db, substr(ns, 7) AS coll, split_part(dest, '.', 1) AS dest_db, substr(dest, strpos(dest, '.') + 1) AS dest_coll FROM r")
def map_collection(spark, sf_dir):
    names = routing.namespaces(change_log(spark, sf_dir)).withColumn("dest", RULES.route(F.col("ns")).dest)
    return names.select(ns_db(F.col("ns")).alias("db"), ns_coll(F.col("ns")).alias("coll"), ns_db(F.col("dest")).alias("dest_db"), ns_coll(F.col("dest")).alias("dest_coll"))


@query("SELECT DISTINCT split_part(ns, '.', 1) AS db FROM log WHERE split_part(ns, '.', 1) <> 'shop2'")
def included_databases(spark, sf_dir):
    dbs = RULES.databases()
    names = change_log(spark, sf_dir).select(ns_db(F.col("ns")).alias("db")).distinct()
    return names.where(F.col("db").isin(*dbs)) if dbs else names


@query(NS_SQL + ", q AS (SELECT *, CASE WHEN ns = 'shop1.users' THEN 'shop1.users' WHEN ns LIKE 'shop0.%' THEN 'shop0.*' WHEN ns LIKE 'shop3.%' THEN 'shop3.*' ELSE 'shop4.*' END AS source FROM r WHERE dest IS NOT NULL) SELECT source, count(*) AS namespaces, sum(entries)::BIGINT AS entries FROM q GROUP BY source")
def rules_table(spark, sf_dir):
    counts = change_log(spark, sf_dir).groupBy("ns").agg(F.count("*").alias("entries"))
    routed = counts.withColumn("r", RULES.route(F.col("ns"))).where("r is not null").select("ns", "entries", F.col("r.rule").alias("rule"))
    joined = routed.join(RULES.table(spark), "rule")
    return joined.groupBy("source").agg(F.count("*").alias("namespaces"), F.sum("entries").alias("entries"))


@query("SELECT ns AS source, 'target_twice' AS reason FROM (SELECT DISTINCT ns FROM log) WHERE ns LIKE '%.orders' OR ns LIKE '%.carts'")
def rule_violations(spark, sf_dir):
    """A table of rules made from the log's namespaces, all orders and all carts to one target each."""
    merged = F.when(F.col("ns").endswith(".orders"), "all.orders").when(F.col("ns").endswith(".carts"), "all.carts")
    none = F.array().cast("array<string>")
    rules = routing.namespaces(change_log(spark, sf_dir)).select(
        F.col("ns").alias("source"), merged.alias("dest"), F.lit(False).alias("gridfs"), F.lit(False).alias("excluded"), none.alias("include"), none.alias("exclude")
    )
    return routing.violations(rules)


@query("SELECT 'all.' || substr(ns, 7) AS dest, count(DISTINCT ns) AS sources FROM log GROUP BY ALL HAVING count(DISTINCT ns) > 1")
def route_conflicts(spark, sf_dir):
    rules = routing.Rules(tuple(routing.Rule(f"shop{k}.*", "all.*") for k in range(5)))
    return routing.conflicts(routing.map_namespaces(routing.namespaces(change_log(spark, sf_dir)), rules))


@query("SELECT DISTINCT ns, 1 + (ns LIKE 'shop4.%')::INTEGER AS patterns FROM log WHERE ns LIKE '%.fs.%' AND ns LIKE 'shop4.%'")
def rule_overlaps(spark, sf_dir):
    return routing.overlaps(routing.namespaces(change_log(spark, sf_dir)), ["shop4.*", "*.fs.*", "shop3.users"])


PATTERN_SQL = """, x AS (SELECT DISTINCT ns, split_part(ns, '.', 1) AS db, substr(ns, 7) AS coll FROM log),
pt AS (SELECT DISTINCT unnest([db || '.*', '*.' || coll, db || '.' || coll[1] || '*x' || coll[-1], '*' || db[-1] || '.y*' || coll[-1], ns]) AS p FROM x),
sides AS (SELECT p, split_part(p, '.', 1) AS d, substr(p, strpos(p, '.') + 1) AS c FROM pt),
pr AS (SELECT a.p AS pattern, b.p AS other, a.d AS ad, b.d AS bd, a.c AS ac, b.c AS bc FROM sides a JOIN sides b ON a.p < b.p)"""


def globs_meet(a: str, b: str) -> str:
    """SQL: whether two texts with one ``*`` at most match a common text (neither holds other special characters)."""
    head, tail = (lambda x: f"split_part({x}, '*', 1)"), (lambda x: f"substr({x}, strpos({x}, '*') + 1)")
    like = lambda x, p: f"({x} LIKE replace({p}, '*', '%'))"
    both = f"((starts_with({head(a)}, {head(b)}) OR starts_with({head(b)}, {head(a)})) AND (ends_with({tail(a)}, {tail(b)}) OR ends_with({tail(b)}, {tail(a)})))"
    return f"CASE WHEN {a} NOT LIKE '%*%' THEN {like(a, b)} WHEN {b} NOT LIKE '%*%' THEN {like(b, a)} ELSE {both} END"


@query(PATTERN_SQL + f" SELECT pattern, other, true AS both_match FROM pr WHERE {globs_meet('ad', 'bd')} AND {globs_meet('ac', 'bc')}")
def pattern_overlaps(spark, sf_dir):
    """Patterns made from the namespaces, and which of them can meet, in names that don't exist too; the name found is matched by both."""
    ns = F.col("ns")
    db, coll = ns_db(ns), ns_coll(ns)
    first, last = F.substring(coll, 1, 1), F.substring(coll, -1, 1)
    made = F.array(F.concat(db, F.lit(".*")), F.concat(F.lit("*."), coll), F.concat(db, F.lit("."), first, F.lit("*x"), last), F.concat(F.lit("*"), F.substring(db, -1, 1), F.lit(".y*"), last), ns)
    found = routing.pattern_overlaps(routing.namespaces(change_log(spark, sf_dir)).select(F.explode(made).alias("pattern")))
    return found.select("pattern", "other", (F.length("name") > 0).alias("both_match"))


# replay


@query("SELECT ts, kind FROM log")
def classify_ops(spark, sf_dir):
    return change_log(spark, sf_dir).select("ts", replay.kind().alias("kind"))


NESTED_SQL = """, n1 AS (SELECT s.*, b.bts, b.bkind FROM data s JOIN (SELECT ns, _id, max(ts) AS bts, arg_max(kind, ts) AS bkind FROM data WHERE kind IN ('insert', 'replace', 'delete') GROUP BY ALL) b USING (ns, _id) WHERE s.ts >= b.bts),
g AS (SELECT ns, _id, any_value(bkind) = 'delete' AS deleted, any_value(user_id) % 3 AS c, arg_max(value, ts) FILTER (WHERE kind <> 'delta') AS value,
  bool_or(kind = 'delta' AND flag = 'click' AND event_id % 2 = 1) AS unflagged, arg_max(flag, ts) FILTER (WHERE kind <> 'delta') AS flag,
  arg_max_null(CASE WHEN flag = 'click' THEN NULL ELSE k END, ts) FILTER (WHERE kind <> 'delta' OR flag = 'purchase' OR event_id % 2 = 0) AS k,
  arg_max(value, ts) FILTER (WHERE kind = 'delta' AND flag = 'purchase') AS tag, CASE WHEN any_value(bkind) = 'delete' THEN max(bts) ELSE max(ts) END AS _ts FROM n1 GROUP BY ns, _id)
SELECT ns, _id, CASE WHEN NOT deleted THEN value END AS value, CASE WHEN NOT deleted AND NOT unflagged THEN flag END AS flag, CASE WHEN NOT deleted THEN k END AS k, CASE WHEN NOT deleted THEN tag END AS tag, _ts, deleted FROM g"""


@query(NESTED_SQL)
def replay_nested(spark, sf_dir):
    return shown_nested(replay.replay_nested(data_entries(change_log(spark, sf_dir, nested=True))))


def shown_nested(state: DataFrame) -> DataFrame:
    tag = F.coalesce(*(find_field(F.col("doc"), f"tags.{k}", "double") for k in range(3)))
    return state.select("ns", "_id", *scalars(state), tag.alias("tag"), "_ts", "deleted")


@query(", nd AS (SELECT * FROM data WHERE NOT from_migrate)" + NESTED_SQL.replace("FROM data", "FROM nd"))
def replicate_nested(spark, sf_dir):
    """Replication of a log with dotted paths, as it is by default."""
    return shown_nested(replicate(data_entries(change_log(spark, sf_dir, nested=True)), Rules(), mode="tail"))


@query("""SELECT event_id AS _id, CASE WHEN event_id % 5 IN (0, 4) THEN 4 ELSE 2 END AS n_b, CASE WHEN event_id % 5 = 0 THEN value END AS b3,
  event_id % 5 <> 1 AS has_b0, CASE WHEN event_id % 5 = 2 THEN k END AS y, CASE WHEN event_id % 5 = 4 THEN k END AS c, event_id % 5 = 3 AS rejected FROM data WHERE kind IN ('insert', 'replace')""")
def apply_delta_cases(spark, sf_dir):
    """Every written document as one of its own, and then an update on a path of it: past an array's end, on an array
    position, through missing maps, below a scalar, and below a position past the end."""
    own, null = data_log(spark, sf_dir).where(replay.is_whole()), F.lit(None)
    k, value, case = find_field(F.col("o"), "p.k", "bigint"), find_field(F.col("o"), "value", "double"), F.col("event_id") % 5
    base = F.to_variant_object(F.struct(k.alias("a"), F.array(k, k).alias("b"), F.struct(k.alias("k")).alias("p")))
    pair = lambda path, v: F.create_map(F.lit(path), v.cast("variant"))
    sets = F.when(case == 0, pair("b.3", value)).when(case == 2, pair("p.x.y", k)).when(case == 3, pair("a.z", k)).when(case == 4, pair("b.3.c", k))
    keyed = own.select("ts", "replset", "event_id", "ns", F.col("event_id").alias("_id"), "from_migrate", base.alias("o"), sets.alias("set"), F.when(case == 1, F.array(F.lit("b.0"))).alias("unset"))
    inserts = keyed.withColumns({"op": F.lit("i"), "set": null.cast("map<string,variant>"), "unset": null.cast("array<string>")})
    updates = keyed.withColumns({"op": F.lit("u"), "o": null.cast("variant"), "ts": F.col("ts") + 1})
    rows = replay.fold(inserts.unionByName(updates))
    state = rows.where("reason is null").select("_id", "doc")
    b = find_field(F.col("doc"), "b", "array<variant>")
    rejected = rows.where("reason is not null").select("_id", F.lit(True).alias("rejected"))
    return state.join(rejected, "_id", "left").select(
        "_id", F.size(b).alias("n_b"), F.try_variant_get(F.get(b, F.lit(3)), "$", "double").alias("b3"),
        (~F.is_variant_null(F.get(b, F.lit(0)))).alias("has_b0"), find_field(F.col("doc"), "p.x.y", "bigint").alias("y"),
        F.try_variant_get(F.get(b, F.lit(3)), "$.c", "bigint").alias("c"), F.coalesce("rejected", F.lit(False)).alias("rejected"),
    )


@query(HALF_SQL + ", s AS (" + flat_sql("data") + """)
SELECT s.ns, s._id, s.value, s.flag, s.k, greatest(s._ts, CASE WHEN s.deleted THEN s._ts ELSE t END) AS _ts, s.deleted FROM s, half_ts WHERE NOT s.deleted OR s._ts > t""")
def snapshot_plus_log(spark, sf_dir):
    ts = half_ts(spark, sf_dir)
    return shown(replay.snapshot_plus_log(half_snapshot(spark, sf_dir), ts, data_log(spark, sf_dir)))


@query(ORPHAN_SQL)
def orphan_updates(spark, sf_dir):
    return replay.orphans(data_log(spark, sf_dir)).withColumn("reason", F.lit("no_base"))


@query(", s AS (" + flat_sql("data") + ") SELECT * FROM s")
def incremental_apply(spark, sf_dir):
    """State of three quarters, then the second half: a quarter of the log is seen twice."""
    late = data_log(spark, sf_dir).where(F.col("event_id") >= n_events(spark, sf_dir) // 2)
    return shown(replay.apply_incremental(early_state(spark, sf_dir), late))


# reconciliation

LOST_SQL = """, kept AS (SELECT * FROM data WHERE event_id < n - n // 100), tgt AS (""" + flat_sql("data") + """), src AS (SELECT * FROM (""" + flat_sql("kept") + """) WHERE NOT deleted),
b AS (SELECT max(_ts) AS newest, (SELECT max(ts) FROM log WHERE event_id < n - n // 100 AND op <> 'n' AND ts <= (SELECT max(_ts) FROM tgt)) AS cutoff FROM tgt),
sus AS (SELECT tgt.* FROM tgt, b WHERE _ts BETWEEN cutoff AND newest)"""


def lost_writes(spark: SparkSession, sf_dir: str, replset: str | None = None, rules: Rules | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(target state, log without its last hundredth, documents of that log); only ``replset`` has lost its entries where one is given."""
    n, log = n_events(spark, sf_dir), change_log(spark, sf_dir)
    lost = F.col("event_id") >= n - n // 100
    kept = log.where(~(lost if replset is None else lost & (F.col("replset") == replset)))
    source = replay.visible(replay.replay_flat(data_entries(kept))).select("ns", "_id", "doc")
    state = replay.replay_flat(data_entries(log)) if rules is None else replicate(data_entries(log), rules, mode="tail")
    return stored(state, "target"), kept, stored(source, "source")


@query(""", cps(replset, ts) AS (SELECT replset, ts FROM (SELECT replset, max(ts) AS ts FROM log WHERE op <> 'n' AND ((replset = 'rs0' AND event_id <= n // 2) OR (replset = 'rs1' AND event_id <= n * 9 // 10)) GROUP BY ALL)
  UNION ALL SELECT 'rs2', min(ts) - 1 FROM log UNION ALL SELECT 'rs3', max(ts) + 1 FROM log),
l3 AS (SELECT ts, replset FROM log WHERE op <> 'n' UNION ALL SELECT ts, 'rs' || (2 + event_id % 2) FROM log WHERE op <> 'n')
SELECT replset, any_value(c.ts) AS ts, CASE WHEN count(*) FILTER (WHERE l3.ts >= c.ts) = 0 THEN 'rollback' WHEN any_value(c.ts) < min(l3.ts) THEN 'unrecoverable' WHEN NOT bool_or(l3.ts = c.ts) THEN 'rollback' ELSE 'continue' END AS decision
FROM cps c JOIN l3 USING (replset) GROUP BY replset""")
def resume_decision(spark, sf_dir):
    """rs2's checkpoint lies before its log, and rs3's after."""
    n, log = n_events(spark, sf_dir), change_log(spark, sf_dir)
    reached = ((F.col("replset") == "rs0") & (F.col("event_id") <= n // 2)) | ((F.col("replset") == "rs1") & (F.col("event_id") <= n * 9 // 10))
    held = log.where(reached & (F.col("op") != "n")).groupBy("replset").agg(F.max("ts").alias("ts"))
    ends = log.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(F.explode(F.array(F.struct(F.lit("rs2").alias("replset"), (F.col("a") - 1).alias("ts")), F.struct(F.lit("rs3").alias("replset"), (F.col("b") + 1).alias("ts")))).alias("e")).select("e.*")
    more = log.withColumn("replset", F.concat(F.lit("rs"), F.col("event_id") % 2 + 2))
    return reconcile.resume_decision(log.unionByName(more), held.unionByName(ends))


@query(LOST_SQL + " SELECT newest, cutoff FROM b")
def rollback_cutoff(spark, sf_dir):
    state, kept, _ = lost_writes(spark, sf_dir)
    return reconcile.rollback_cutoff(kept, state)


@query(LOST_SQL + " SELECT ns, _id, _ts, deleted FROM sus")
def rollback_suspects(spark, sf_dir):
    state, kept, _ = lost_writes(spark, sf_dir)
    return reconcile.rollback_suspects(state, kept).select("ns", "_id", "_ts", "deleted")


@query(LOST_SQL + " SELECT ns, _id, _ts FROM sus ANTI JOIN src USING (ns, _id)")
def rollback_deletes(spark, sf_dir):
    return reconcile.reconcile(*lost_writes(spark, sf_dir))["deletes"].select("ns", "_id", "_ts")


@query(LOST_SQL + " SELECT src.ns, src._id, src.value, src.flag, src.k, cutoff AS _ts, false AS deleted FROM src, b WHERE (src.ns, src._id) IN (SELECT (ns, _id) FROM sus)")
def rollback_upserts(spark, sf_dir):
    return shown(reconcile.reconcile(*lost_writes(spark, sf_dir))["upserts"])


@query(LOST_SQL + """ SELECT tgt.* FROM tgt ANTI JOIN sus USING (ns, _id) UNION ALL BY NAME
SELECT src.* REPLACE (cutoff AS _ts) FROM src, b WHERE (src.ns, src._id) IN (SELECT (ns, _id) FROM sus) UNION ALL BY NAME
SELECT ns, _id, NULL AS value, NULL AS flag, NULL AS k, cutoff AS _ts, true AS deleted FROM sus ANTI JOIN src USING (ns, _id), b""")
def rollback_state(spark, sf_dir):
    return shown(reconcile.reconcile(*lost_writes(spark, sf_dir))["state"])


def lost_sql(kept: str, logged: str, target: str, source: str) -> str:
    """State after a rollback: ``kept`` says which entries are left, ``logged`` which of them the cutoff is taken from, ``target`` and
    ``source`` are the target's entries and those the source's documents are made of, both under the target's names."""
    return f""", kl AS (SELECT * FROM log WHERE {kept}), tgt AS ({flat_sql(target)}), src AS (SELECT * FROM ({flat_sql(source)}) WHERE NOT deleted),
b AS (SELECT max(_ts) AS newest, (SELECT max(ts) FROM kl WHERE op <> 'n' AND {logged} AND ts <= (SELECT max(_ts) FROM tgt)) AS cutoff FROM tgt),
sus AS (SELECT tgt.* FROM tgt, b WHERE _ts BETWEEN cutoff AND newest)
SELECT ns, _id, value, flag, k, _ts, deleted FROM tgt ANTI JOIN sus USING (ns, _id) UNION ALL BY NAME
SELECT ns, _id, value, flag, k, cutoff AS _ts, deleted FROM src, b WHERE (src.ns, src._id) IN (SELECT (ns, _id) FROM sus) UNION ALL BY NAME
SELECT ns, _id, NULL AS value, NULL AS flag, NULL AS k, cutoff AS _ts, true AS deleted FROM sus ANTI JOIN src USING (ns, _id), b"""


@query(", ke AS (SELECT * FROM data WHERE NOT (event_id >= n - n // 100 AND replset = 'rs0'))" + lost_sql("NOT (event_id >= n - n // 100 AND replset = 'rs0')", "replset = 'rs0'", "data", "ke"))
def rollback_one_log(spark, sf_dir):
    """rs0 has lost its last writes, rs1 goes on; the cutoff is rs0's own."""
    return shown(reconcile.reconcile(*lost_writes(spark, sf_dir, "rs0"), replsets=["rs0"])["state"])


RENAMES = Rules((Rule("shop0.*", "target0.*"), Rule("shop1.*", "people.*"), Rule("shop3.*", exclude=("flag",))))
RENAMED_SQL = """, rn AS (SELECT * REPLACE (CASE WHEN ns LIKE 'shop0.%' THEN 'target0.' || substr(ns, 7) WHEN ns LIKE 'shop1.%' THEN 'people.' || substr(ns, 7) ELSE ns END AS ns), ns AS from_ns
  FROM data WHERE ns LIKE 'shop0.%' OR ns LIKE 'shop1.%' OR ns LIKE 'shop3.%'),
rt AS (SELECT * REPLACE (CASE WHEN from_ns NOT LIKE 'shop3.%' OR flag IN ('purchase', 'click') THEN flag END AS flag) FROM rn WHERE NOT from_migrate AND NOT (from_ns LIKE 'shop3.%' AND kind = 'delta' AND flag = 'click')),
re AS (SELECT * FROM rn WHERE event_id < n - n // 100)"""


@query(RENAMED_SQL + ", st AS (" + lost_sql("event_id < n - n // 100", "true", "rt", "re").removeprefix(", ").replace("kl AS", "WITH kl AS", 1) + ") SELECT * REPLACE (CASE WHEN ns NOT LIKE 'shop3.%' THEN flag END AS flag) FROM st")
def rollback_renamed(spark, sf_dir):
    """A target whose names differ from the source's, and whose rule leaves a field out."""
    return shown(reconcile.reconcile(*lost_writes(spark, sf_dir, rules=RENAMES), rules=RENAMES)["state"])


# aggregates


@query("SELECT replset, min(ts) AS oldest, max(ts) AS newest FROM log WHERE op <> 'n' GROUP BY replset")
def log_bounds(spark, sf_dir):
    return reconcile.log_bounds(change_log(spark, sf_dir))


@query("SELECT replset, max(ts) AS ts FROM log GROUP BY replset")
def seed_checkpoint(spark, sf_dir):
    return reconcile.seed_checkpoint(change_log(spark, sf_dir))


@query("SELECT ns, count(*) FILTER (WHERE op = 'd') AS removed, count(*) FILTER (WHERE op = 'i') AS upserted, count(*) FILTER (WHERE op = 'u') AS updated FROM log GROUP BY ns")
def op_counters(spark, sf_dir):
    return reconcile.op_counters(change_log(spark, sf_dir))


@query(CP_SQL + ", m AS (SELECT replset, max(ts) AS newest FROM log WHERE op <> 'n' GROUP BY ALL) SELECT replset, CASE WHEN ts > newest THEN 'ahead' WHEN newest >> 32 <> ts >> 32 THEN 'seconds' WHEN newest <> ts THEN 'entries' ELSE 'up_to_date' END AS status, CASE WHEN ts > newest THEN NULL WHEN newest >> 32 <> ts >> 32 THEN (newest >> 32) - (ts >> 32) ELSE newest - ts END AS lag FROM m JOIN cp USING (replset)")
def replication_lag(spark, sf_dir):
    return reconcile.replication_lag(change_log(spark, sf_dir), sample_checkpoints(spark, sf_dir))


@query("SELECT ns, _id, arg_max(op, ts) AS op, max(ts) AS ts FROM data GROUP BY ALL")
def latest_per_key(spark, sf_dir):
    return replay.latest_per_key(data_log(spark, sf_dir).select("ns", "_id", "ts", "op"), ["ns", "_id"], "ts").select("ns", "_id", "op", "ts")


# scalars


@query("SELECT event_id, ts AS packed FROM log")
def ts_pack(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return log.select("event_id", pack_ts(ts_seconds(F.col("ts")), ts_increment(F.col("ts"))).alias("packed"))


@query("SELECT event_id, (ts >> 32) AS seconds, event_id AS increment FROM log")
def ts_unpack(spark, sf_dir):
    return change_log(spark, sf_dir).select("event_id", ts_seconds(F.col("ts")).alias("seconds"), ts_increment(F.col("ts")).alias("increment"))


@query("SELECT DISTINCT ns, split_part(ns, '.', 1) AS db, substr(ns, strpos(ns, '.') + 1) AS coll FROM log")
def split_namespace(spark, sf_dir):
    return routing.namespaces(change_log(spark, sf_dir)).select("ns", ns_db(F.col("ns")).alias("db"), ns_coll(F.col("ns")).alias("coll"))


@query("SELECT ts, k, value, false AS has_none FROM data WHERE kind IN ('insert', 'replace')")
def find_fields(spark, sf_dir):
    own = data_log(spark, sf_dir).where(replay.is_whole())
    return own.select("ts", find_field(F.col("o"), "p.k", "bigint").alias("k"), find_field(F.col("o"), "value", "double").alias("value"), find_field(F.col("o"), "p.k.none").isNotNull().alias("has_none"))


QUERIES["find_field"], SQL["find_field"] = QUERIES.pop("find_fields"), SQL.pop("find_fields")


@query("SELECT ts, 'tags.' || (user_id % 3) AS matched FROM data WHERE kind = 'delta' AND flag = 'purchase'")
def find_update_fields(spark, sf_dir):
    own = nested_updates(spark, sf_dir).where("set is not null")
    return own.select("ts", F.array_join(F.filter(F.map_keys("set"), lambda k: key_matches(k, ["tags"])), ",").alias("matched"))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a value that isn't finite every 50 rows, alone and in a list, and with other types."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    value = F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return events.select(
        "event_id", value.alias("value"), F.array(value, F.lit(1.0)).alias("list"), F.encode("event_type", "UTF-8").alias("data"),
        F.struct(F.col("event_type").alias("pattern"), F.lit("xmi").alias("flags")).alias("rx"), F.col("value").cast("decimal(12,2)").alias("amount"),
    )


@query("SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN value END AS value, base64(event_type::BLOB) AS data, '/' || event_type || '/imx' AS rx, printf('%.2f', value) AS amount FROM events", log=False)
def format_documents(spark, sf_dir):
    return formatting.format_documents(typed_events(spark, sf_dir)).drop("list")


@query("SELECT event_id, event_id % 50 <> 0 AS has_value, event_id % 50 <> 0 AS has_list FROM events", log=False)
def drop_non_finite(spark, sf_dir):
    own = formatting.format_documents(typed_events(spark, sf_dir).select("event_id", "value", "list"))
    return own.select("event_id", F.col("value").isNotNull().alias("has_value"), F.col("list").isNotNull().alias("has_list"))


@query("""SELECT event_id, path, val AS value FROM (SELECT event_id, unnest([{'path': 'flag', 'val': flag}, {'path': 'p.k', 'val': k::VARCHAR}, {'path': 'list.0', 'val': user_id::VARCHAR}, {'path': 'list.1.x', 'val': event_id::VARCHAR}], recursive := true) FROM data WHERE kind IN ('insert', 'replace'))""")
def flatten_documents(spark, sf_dir):
    own = data_log(spark, sf_dir).where(replay.is_whole())
    doc = F.to_variant_object(
        F.struct(
            find_field(F.col("o"), "flag", "string").alias("flag"), F.struct(find_field(F.col("o"), "p.k", "bigint").alias("k")).alias("p"),
            F.array(F.col("_id").cast("variant"), F.to_variant_object(F.struct(F.col("event_id").alias("x")))).alias("list"), F.array().cast("array<int>").alias("none"),
        )
    )
    return formatting.flatten(own.select("event_id", doc.alias("doc")), ["event_id"])


@query("""SELECT event_id, value, base64(flag::BLOB) AS data, (DATE '2020-01-01' + (event_id % 300)::INTEGER)::DATE::VARCHAR AS day, event_id % 5 <> 0 AS has_list, event_id % 3 = 0 AS null_stays, event_id % 2 = 0 AS mixed_is_text FROM data WHERE kind IN ('insert', 'replace')""")
def format_state(spark, sf_dir):
    """Documents with binaries, dates, lists with a NaN, nulls, and a field of two types, formatted as they are stored."""
    k = F.col("event_id")
    own = data_log(spark, sf_dir).where(replay.is_whole())
    doc = F.to_variant_object(
        F.map_filter(
            F.create_map(
                F.lit("value"), find_field(F.col("o"), "value", "double").cast("variant"), F.lit("data"), find_field(F.col("o"), "flag", "string").cast("binary").cast("variant"),
                F.lit("day"), F.date_add(F.lit("2020-01-01").cast("date"), (k % 300).cast("int")).cast("variant"),
                F.lit("list"), F.to_variant_object(F.array(F.lit(1.5), F.when(k % 5 == 0, float("nan")).otherwise(2.0))),
                F.lit("none"), F.when(k % 3 == 0, F.parse_json(F.lit("null"))), F.lit("mixed"), F.when(k % 2 == 0, F.lit("t").cast("variant")).otherwise(k.cast("variant")),
            ),
            lambda _, v: v.isNotNull(),
        )
    )
    made = formatting.format_state(own.select("event_id", doc.alias("doc")))
    get = lambda path, kind: F.try_variant_get("doc", path, kind)
    return made.select(
        "event_id", get("$.value", "double").alias("value"), get("$.data", "string").alias("data"), get("$.day", "date").cast("string").alias("day"), get("$.list", "array<double>").isNotNull().alias("has_list"),
        F.coalesce(F.is_variant_null(get("$.none", "variant")), F.lit(False)).alias("null_stays"), (F.schema_of_variant(get("$.mixed", "variant")) == "STRING").alias("mixed_is_text"),
    )


@query("SELECT doc_id, base64(encode(text)) AS b FROM documents", log=False)
def fmt_binary(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", formatting.binary_text(F.encode("text", "UTF-8")).alias("b"))


@query("SELECT doc_id, md5(text) AS u FROM documents", log=False)
def fmt_uuid(spark, sf_dir):
    digest = F.upper(F.md5("text"))
    dashed = F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", formatting.uuid_text(dashed).alias("u"))


@query("SELECT event_id, '/' || event_type || '/' || CASE WHEN event_id % 2 = 0 THEN 'imx' ELSE 's' END AS r FROM events", log=False)
def fmt_regex(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    flags = F.when(F.col("event_id") % 2 == 0, "xmi").otherwise("sz")
    return events.select("event_id", formatting.regex_text(F.col("event_type"), flags).alias("r"))


@query("SELECT doc_id AS _id, md5(text) AS md5, CASE WHEN doc_id % 5 <> 0 THEN 'doc-' || doc_id || '.txt' END AS filename, CASE WHEN doc_id % 5 <> 0 THEN 2 ELSE 1 END AS fields FROM documents", log=False)
def file_metadata(spark, sf_dir):
    table = files.file_table(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    own = files.metadata(table.withColumn("filename", F.when(F.col("_id") % 5 != 0, F.col("filename"))))
    return own.select("_id", F.col("metadata")["md5"].alias("md5"), F.col("metadata")["filename"].alias("filename"), F.size("metadata").alias("fields"))


@query("SELECT doc_id AS files_id, g::INTEGER AS n, md5(substr(text, (g * 1024 + 1)::BIGINT, 1024)) AS data FROM documents, range(0, 1 + (SELECT max(length(text)) // 1024 FROM documents)) r(g) WHERE g < greatest(1, ceil(length(text) / 1024.0))", log=False)
def chunk_documents(spark, sf_dir):
    return files.chunk_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("data", F.md5("data"))


# whole plans

REPLICA_SQL = ", " + SKIP_SQL + """, ap AS (SELECT * REPLACE (dest AS ns), ns AS src FROM sk WHERE reason IS NULL AND NOT (ns = 'shop1.users' AND kind = 'delta' AND flag = 'click') AND NOT (ns LIKE 'shop3.%' AND kind = 'delta' AND flag = 'click')), st AS (""" + flat_sql("ap") + """)
SELECT ns, _id, value, CASE WHEN ns <> 'people.main' AND ns NOT LIKE 'shop3.%' THEN flag END AS flag, CASE WHEN ns <> 'people.main' THEN k END AS k, _ts, deleted"""


@query(REPLICA_SQL + ", CASE WHEN ns = 'shop4.fs' AND NOT deleted THEN _id END AS gridfs_id FROM st")
def current_documents(spark, sf_dir):
    """The flagship: every target collection as it is now, and which of its rows are files."""
    state = with_files(replicate(change_log(spark, sf_dir), RULES, mode="tail"), RULES)
    return state.select("ns", "_id", *scalars(state), "_ts", "deleted", "gridfs_id")


@query("SELECT event_id, upper(event_type) AS event_type, value FROM events", log=False)
def custom_formatter(spark, sf_dir):
    """A formatter that raises strings to upper case, and drops the props."""

    def own(field, value):
        if field.name in ("props", "ts", "user_id"):
            return None
        return F.upper(value) if field.dataType.simpleString() == "string" else formatting.default_format(field, value)

    return formatting.format_documents(spark.read.parquet(f"{sf_dir}/events.parquet"), own)

