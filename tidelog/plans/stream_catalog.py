"""Registered queries that run a stream to its end: the log is stored as files, and read as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.folders import files_in
from tidelog.functions.folders import scratch as folder
from tidelog.operators import files
from tidelog.operators.replay import is_whole, latest_per_key, replay_flat, visible
from tidelog.operators.routing import Rule, Rules
from tidelog.plans.catalog import COMMAND_SQL, LOST_SQL, NESTED_SQL, ORPHAN_SQL, REPLICA_SQL, command_entries, flat_sql, query, shown, shown_nested
from tidelog.plans.replicate import RULES
from tidelog.sinks.chunked import read_chunks, write_chunks
from tidelog.sinks.targets import FileTarget, JsonTarget, ParquetTarget
from tidelog.sources.change_log import DATA_COLLECTIONS, change_log, data_entries, n_events
from tidelog.streaming.keyed import PARTITIONS, PROVIDER, ROCKSDB, documents
from tidelog.streaming.tail import Monitor, Watch, counted, latest_entries, log_stream, read_progress, tail, tail_logs

FLAT = ", s AS (" + flat_sql("data") + ") SELECT * FROM s"


def scratch(spark: SparkSession) -> str:
    return folder(spark, "stream")


#: Entries of a file of a stored log, about.
FILE_ROWS = 1 << 17


def stored_stream(spark: SparkSession, sf_dir: str, base: str, parts: int = 3, more: DataFrame | None = None, log: DataFrame | None = None, key: str = "BIGINT") -> DataFrame:
    """The log (and ``more`` entries) in ``parts`` stretches of event_id, as a stream of one stretch a batch.

    A stretch has a file for each ``FILE_ROWS`` of its numbers, written and read by so many tasks.  A file that would have no entry is written without any, since a batch takes files by
    their number.
    """
    log, n = change_log(spark, sf_dir) if log is None else log, n_events(spark, sf_dir)
    log = log if more is None else log.unionByName(more)
    count, written = max(1, -(-n // (parts * FILE_ROWS))), 0
    for k in range(parts):
        low, high = (n * j // parts for j in (k, k + 1))
        part = log.where((F.col("event_id") >= low) & (F.col("event_id") < high))
        place = F.floor((F.col("event_id") - low) * count / (high - low)).cast("int")
        dealt = part.coalesce(1) if count == 1 else part.repartitionById(count, place)
        dealt.sortWithinPartitions("ts").write.mode("append").parquet(f"{base}/log")
        written += count
        for _ in range(written - files_in(spark, f"{base}/log")):
            part.where("false").coalesce(1).write.mode("append").parquet(f"{base}/log")
    return log_stream(spark, f"{base}/log", files_per_batch=count, key=key)


def run(spark: SparkSession, stream: DataFrame, targets: list, base: str, name: str = "run") -> None:
    tail(stream, targets, f"{base}/checkpoint-{name}", progress=f"{base}/progress", prepare=data_entries).awaitTermination()


@query(FLAT)
def stream_replay(spark, sf_dir):
    base = scratch(spark)
    target = ParquetTarget(spark, f"{base}/state")
    run(spark, stored_stream(spark, sf_dir, base), [target], base)
    return shown(target.state())


@query(FLAT)
def restart_idempotent(spark, sf_dir):
    """The whole stream twice, the second time without the first's checkpoint."""
    base = scratch(spark)
    target = ParquetTarget(spark, f"{base}/state")
    stream = stored_stream(spark, sf_dir, base)
    run(spark, stream, [target], base, "first")
    run(spark, stream, [target], base, "second")
    return shown(target.state())


@query(NESTED_SQL)
def stream_nested(spark, sf_dir):
    """Dotted paths through a stream; the table is compacted half way."""
    base = scratch(spark)
    target = ParquetTarget(spark, f"{base}/state")
    stream = stored_stream(spark, sf_dir, base, log=change_log(spark, sf_dir, nested=True))

    def batch(log: DataFrame, batch_id: int) -> None:
        target.apply(data_entries(log), batch_id)
        if batch_id == 1:
            target.compact()

    stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()
    return shown_nested(target.state())


@query(ORPHAN_SQL)
def stream_rejects(spark, sf_dir):
    """What a target couldn't apply of a stream; a compaction keeps it."""
    base = scratch(spark)
    target = ParquetTarget(spark, f"{base}/state")
    run(spark, stored_stream(spark, sf_dir, base), [target], base)
    target.compact()
    return target.rejects()


@query(LOST_SQL + """, rolled AS (SELECT tgt.* FROM tgt ANTI JOIN sus USING (ns, _id) UNION ALL BY NAME
SELECT src.* REPLACE (cutoff AS _ts) FROM src, b WHERE (src.ns, src._id) IN (SELECT (ns, _id) FROM sus) UNION ALL BY NAME
SELECT ns, _id, NULL AS value, NULL AS flag, NULL AS k, _ts, true AS deleted FROM sus ANTI JOIN src USING (ns, _id))
SELECT * REPLACE ('user-' || _id AS _id) FROM rolled""")
def text_keys(spark, sf_dir):
    """Keys that are texts: a stream to its end, a rollback, a compaction."""
    base, n = scratch(spark), n_events(spark, sf_dir)
    log = change_log(spark, sf_dir).withColumn("_id", F.concat(F.lit("user-"), "_id"))
    target = ParquetTarget(spark, f"{base}/state", key="STRING")
    run(spark, stored_stream(spark, sf_dir, base, log=log, key="STRING"), [target], base)
    kept = log.where(F.col("event_id") < n - n // 100)
    target.roll_back(kept, visible(replay_flat(data_entries(kept))).select("ns", "_id", "doc"), 3)
    target.compact()
    return shown(target.state())


@query("SELECT replset, max(ts) AS ts FROM log GROUP BY replset")
def checkpoint_progress(spark, sf_dir):
    base = scratch(spark)
    run(spark, stored_stream(spark, sf_dir, base), [ParquetTarget(spark, f"{base}/state")], base)
    return read_progress(spark, f"{base}/progress")


@query("SELECT ns, _id, max(ts) AS last_ts, count(*) AS entries FROM log WHERE op <> 'n' GROUP BY ALL")
def stream_state(spark, sf_dir):
    base = scratch(spark)
    rows = latest_entries(stored_stream(spark, sf_dir, base))

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    writer = rows.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint")
    writer.foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()
    return latest_per_key(spark.read.parquet(f"{base}/out").drop("batch"), ["ns", "_id"], "entries").select("ns", "_id", "last_ts", "entries")


@query(", s AS (" + flat_sql("data") + ") SELECT 'parquet' AS target, count(*) AS n FROM s UNION ALL SELECT 'json', count(*) FROM data")
def fan_out(spark, sf_dir):
    base = scratch(spark)
    both = [ParquetTarget(spark, f"{base}/state"), JsonTarget(spark, f"{base}/mirror")]
    run(spark, stored_stream(spark, sf_dir, base), both, base)
    counts = [t.agg(F.count("*").alias("n")).withColumn("target", F.lit(name)) for name, t in (("parquet", both[0].state()), ("json", both[1].entries("ts BIGINT")))]
    return counts[0].unionByName(counts[1])


@query("SELECT ns, op, count(*) AS n, max(ts) AS newest FROM data GROUP BY ALL")
def custom_sink(spark, sf_dir):
    """A target of one's own: it keeps counts for each batch."""
    base = scratch(spark)

    class Counts:
        name = "counts"

        def apply(self, log, batch_id):
            log.groupBy("ns", "op").agg(F.count("*").alias("n"), F.max("ts").alias("newest")).write.mode("overwrite").parquet(f"{base}/counts/batch={batch_id}")

    run(spark, stored_stream(spark, sf_dir, base), [Counts()], base)
    return spark.read.parquet(f"{base}/counts").groupBy("ns", "op").agg(F.sum("n").alias("n"), F.max("newest").alias("newest"))


COMMITS = ", ".join(f"d{k} AS (SELECT * FROM data WHERE event_id < n * {k + 1} // 3), s{k} AS ({flat_sql(f'd{k}')})" for k in range(3))


@query(f", {COMMITS} " + " UNION ALL ".join(f"SELECT {k} AS batch, count(*) AS documents, max(_ts) AS newest FROM s{k}" for k in range(3)))
def micro_batch_commit(spark, sf_dir):
    """What the target held after each batch was committed."""
    base = scratch(spark)

    class Watched(ParquetTarget):
        def apply(self, log, batch_id):
            super().apply(log, batch_id)
            held = self.state().agg(F.count("*").alias("documents"), F.max("_ts").alias("newest"))
            held.write.mode("overwrite").parquet(f"{base}/held/batch={batch_id}")

    run(spark, stored_stream(spark, sf_dir, base), [Watched(spark, f"{base}/state")], base)
    return spark.read.option("basePath", f"{base}/held").parquet(f"{base}/held/batch=*").select("batch", "documents", "newest")


def routed_run(spark: SparkSession, stream: DataFrame, targets: list, base: str, rules: Rules) -> None:
    tail(stream, targets, f"{base}/checkpoint", rules).awaitTermination()


@query(REPLICA_SQL.replace("WHERE reason IS NULL AND", "WHERE reason IS NULL AND NOT ns LIKE '%.files' AND") + " FROM st")
def stream_rules(spark, sf_dir):
    """A stream through rules of every kind; what they exclude never gets to the target."""
    base = scratch(spark)
    target = ParquetTarget(spark, f"{base}/state")
    routed_run(spark, stored_stream(spark, sf_dir, base), [target], base, RULES)
    return shown(target.state())


MOVES = Rules((Rule("shop0.*", "target0.*"), Rule("shop1.*"), Rule("shop3.*", "moved.*")))
MOVES_SQL = """, ap AS (SELECT * REPLACE (CASE WHEN ns LIKE 'shop0.%' THEN 'target0.' || substr(ns, 7) WHEN ns LIKE 'shop3.%' THEN 'moved.' || substr(ns, 7) ELSE ns END AS ns)
  FROM moved WHERE NOT from_migrate AND (ns LIKE 'shop0.%' OR ns LIKE 'shop1.%' OR ns LIKE 'shop3.%'))"""


@query(COMMAND_SQL + MOVES_SQL + ", s AS (" + flat_sql("ap") + ") SELECT ns, _id, value, flag, k, _ts FROM s WHERE NOT deleted")
def stream_commands(spark, sf_dir):
    """A drop, a rename and a dropped database in the stream, through rules that rename."""
    base = scratch(spark)
    target = ParquetTarget(spark, f"{base}/state")
    routed_run(spark, stored_stream(spark, sf_dir, base, more=command_entries(spark, sf_dir)), [target], base, MOVES)
    return shown(visible(target.state()))


@query(""", f AS (SELECT _id, max(ts) AS _ts, arg_max(op, ts) AS op FROM log WHERE ns = 'shop4.fs.files' AND NOT from_migrate AND op IN ('i', 'd') GROUP BY _id)
SELECT 'shop4.fs' AS ns, _id, _id AS gridfs_id, 'doc-' || _id || '.txt' AS filename, length(text)::BIGINT AS length, md5(text) AS content_md5, _ts FROM f JOIN documents ON doc_id = _id WHERE op = 'i'""")
def stream_files(spark, sf_dir):
    """File entries of the stream, with content from the chunks; documents of the same stream go to their own target."""
    base, docs = scratch(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = FileTarget(spark, f"{base}/files", files.file_table(docs), files.chunk_texts(docs))
    routed_run(spark, stored_stream(spark, sf_dir, base), [ParquetTarget(spark, f"{base}/state"), target], base, RULES)
    return target.contents().select("ns", "_id", "gridfs_id", "filename", "length", F.md5("content").alias("content_md5"), "_ts")


def add_to_logs(log: DataFrame, path: str) -> None:
    log.coalesce(2).write.partitionBy("replset").mode("append").parquet(path)


@query(FLAT)
def stream_source(spark, sf_dir):
    """Two logs followed as one stream; the second appears with the second batch, older entries and all."""
    base, log, n = scratch(spark), change_log(spark, sf_dir), n_events(spark, sf_dir)
    target, first = ParquetTarget(spark, f"{base}/state"), (F.col("replset") == "rs0") & (F.col("event_id") < n // 2)
    for part in (log.where(first), log.where(~first)):
        add_to_logs(part, f"{base}/logs")
        tail_logs(spark, f"{base}/logs", [target], f"{base}/checkpoint", prepare=data_entries).awaitTermination()
    return shown(target.state())


@query(""", kl AS (SELECT * FROM log WHERE event_id < n - n // 100), kept AS (SELECT * FROM data WHERE event_id < n - n // 100),
tgt AS (""" + flat_sql("data") + """), src AS (SELECT * FROM (""" + flat_sql("kept") + """) WHERE NOT deleted),
lr AS (SELECT replset FROM log GROUP BY replset HAVING max(ts) <> max(ts) FILTER (WHERE event_id < n - n // 100)),
b AS (SELECT max(_ts) AS newest, (SELECT min(c) FROM (SELECT max(ts) AS c FROM kl SEMI JOIN lr USING (replset) WHERE op <> 'n' AND ts <= (SELECT max(_ts) FROM tgt) GROUP BY replset)) AS cutoff FROM tgt),
sus AS (SELECT tgt.* FROM tgt, b WHERE _ts BETWEEN cutoff AND newest)
SELECT ns, _id, value, flag, k, _ts, deleted FROM tgt ANTI JOIN sus USING (ns, _id) UNION ALL BY NAME
SELECT ns, _id, value, flag, k, cutoff AS _ts, deleted FROM src, b WHERE (src.ns, src._id) IN (SELECT (ns, _id) FROM sus) UNION ALL BY NAME
SELECT ns, _id, NULL AS value, NULL AS flag, NULL AS k, _ts, true AS deleted FROM sus ANTI JOIN src USING (ns, _id)""")
def stream_rollback(spark, sf_dir):
    """The logs lose their last hundredth between two batches of a stream, which rolls its target back before it goes on."""
    base, log, n = scratch(spark), change_log(spark, sf_dir), n_events(spark, sf_dir)
    kept = log.where(F.col("event_id") < n - n // 100)
    target, watch = ParquetTarget(spark, f"{base}/state"), Watch(lambda: kept, lambda: visible(replay_flat(data_entries(kept))).select("ns", "_id", "doc"))
    more = {"prepare": data_entries, "progress": f"{base}/progress"}
    add_to_logs(log, f"{base}/logs")
    tail_logs(spark, f"{base}/logs", [target], f"{base}/checkpoint", **more).awaitTermination()
    kept.coalesce(2).write.partitionBy("replset").mode("overwrite").parquet(f"{base}/logs")
    tail_logs(spark, f"{base}/logs", [target], f"{base}/checkpoint", watch=watch, **more).awaitTermination()
    return shown(target.state())


THIRDS = " UNION ALL ".join(f"SELECT {k} AS batch, replset, max(ts) AS ts FROM log WHERE event_id < n * {k + 1} // 3 GROUP BY replset" for k in range(3))


@query(f""", r AS ({THIRDS}), m AS (SELECT replset, max(ts) AS newest FROM log WHERE op <> 'n' GROUP BY ALL)
SELECT batch, replset, CASE WHEN ts > newest THEN 'ahead' WHEN newest >> 32 <> ts >> 32 THEN 'seconds' WHEN newest <> ts THEN 'entries' ELSE 'up_to_date' END AS status,
  CASE WHEN ts > newest THEN NULL WHEN newest >> 32 <> ts >> 32 THEN (newest >> 32) - (ts >> 32) ELSE newest - ts END AS lag FROM r JOIN m USING (replset)""")
def stream_lag(spark, sf_dir):
    """How far each log is ahead of a stream after each of its batches."""
    base, log = scratch(spark), change_log(spark, sf_dir)
    stream, watch = stored_stream(spark, sf_dir, base), Watch(lambda: log, lambda: log.where("false"))
    tail(stream, [JsonTarget(spark, f"{base}/mirror")], f"{base}/checkpoint", progress=f"{base}/progress", watch=watch, lag=f"{base}/lag").awaitTermination()
    return spark.read.option("basePath", f"{base}/lag").parquet(f"{base}/lag/batch=*").select("batch", "replset", "status", "lag")


COUNTS = " UNION ALL ".join(
    f"SELECT {k} AS batch, count(*) FILTER (WHERE op = 'd') AS removed, count(*) FILTER (WHERE op = 'i') AS upserted, count(*) FILTER (WHERE op = 'u') AS updated, max(ts) AS newest "
    f"FROM log WHERE event_id >= n * {k} // 3 AND event_id < n * {k + 1} // 3" for k in range(3)
)


@query(" " + COUNTS)
def stream_counters(spark, sf_dir):
    """What a stream's batches held, by the metrics of its progress."""
    base = scratch(spark)
    monitor = Monitor(spark, f"{base}/counters")
    spark.streams.addListener(monitor)
    try:
        query_ = tail(counted(stored_stream(spark, sf_dir, base)), [JsonTarget(spark, f"{base}/mirror")], f"{base}/checkpoint")
        query_.awaitTermination()
        return monitor.written(2).select("batch", "removed", "upserted", "updated", "newest")
    finally:
        spark.streams.removeListener(monitor)


BINARY_FILES_SQL = """, last AS (SELECT _id, max(ts) AS _ts, arg_max(op, ts) AS op FROM log WHERE ns = 'shop4.fs.files' AND NOT from_migrate AND op IN ('i', 'd') GROUP BY _id),
bin AS (SELECT doc_id, unhex(md5(text) || 'ff00fe') || text::BLOB AS data FROM documents)
SELECT _id, octet_length(data)::BIGINT AS length, md5(data) AS md5, octet_length(data) > 4096 AS stored_apart, _ts FROM last JOIN bin ON doc_id = _id WHERE op = 'i'"""


def as_bytes(docs: DataFrame) -> DataFrame:
    """Documents as binaries that are no texts: 19 bytes of any value, then the text's."""
    return docs.select("doc_id", F.concat(F.unhex(F.concat(F.md5("text"), F.lit("ff00fe"))), F.encode("text", "UTF-8")).alias("data"))


@query(BINARY_FILES_SQL.replace("text::BLOB", "encode(text)"))
def stream_binary_files(spark, sf_dir):
    """Binary files of a stream, in chunks of 1000 bytes; those over 4096 bytes are stored apart.  Digests are of the bytes read back."""
    base, docs = scratch(spark), as_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    table = files.binary_file_table(docs, "doc_id", "data", F.concat(F.lit("doc-"), "doc_id", F.lit(".bin")))
    target = FileTarget(spark, f"{base}/files", table, files.chunk_bytes(docs, "doc_id", "data", 1000), small=4096)
    routed_run(spark, stored_stream(spark, sf_dir, base), [target], base, RULES)
    held = target.contents()
    read = files.store_files(files.read_stored(held, 3000).withColumnRenamed("_id", "files_id"), f"{base}/again", 1 << 30)
    return held.join(read.select(F.col("files_id").alias("_id"), "bytes", "digest"), "_id").select(
        "_id", F.col("bytes").alias("length"), F.col("digest").alias("md5"), F.col("stored_at").isNotNull().alias("stored_apart"), "_ts"
    )


@query("""WITH bin AS (SELECT doc_id, unhex(md5(text) || 'ff00fe') || encode(text) AS data FROM documents), f AS (SELECT doc_id, octet_length(data)::BIGINT AS size, ceil(octet_length(data) / 1000.0)::BIGINT AS pieces FROM bin)
SELECT doc_id AS _id, CASE WHEN doc_id % 7 = 0 AND pieces > 2 THEN 'missing_chunk' WHEN doc_id % 7 = 0 AND pieces = 2 THEN 'wrong_length' WHEN doc_id % 7 = 1 THEN 'missing_chunk' WHEN doc_id % 7 = 2 THEN 'wrong_digest' END AS reason,
  CASE WHEN doc_id % 7 > 2 OR (doc_id % 7 = 0 AND pieces = 1) THEN size > 4096 END AS stored_apart FROM f""", log=False)
def judge_binary_files(spark, sf_dir):
    """Binaries some of which have lost their second chunk, have their first twice, or have other bytes in the first."""
    base, docs = scratch(spark), as_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    table, chunks = files.binary_file_table(docs, "doc_id", "data", F.lit("x")), files.chunk_bytes(docs, "doc_id", "data", 1000)
    kind = F.col("files_id") % 7
    kept = chunks.where(~((kind == 0) & (F.col("n") == 1)))
    # the first three bytes of its digest's end are ff00fe
    damaged = F.concat(F.expr("substring(data, 1, 16)"), F.unhex(F.lit("fe00ff")), F.expr("substring(data, 20)"))
    changed = kept.withColumn("data", F.when((kind == 2) & (F.col("n") == 0), damaged).otherwise(F.col("data")))
    found = files.judge_files(changed.unionByName(kept.where((kind == 1) & (F.col("n") == 0))), table, f"{base}/files", 4096)
    return found.select("_id", "reason", F.when(F.col("reason").isNull(), F.col("stored_at").isNotNull()).alias("stored_apart"))


@query(FLAT.replace("SELECT * FROM s", "SELECT ns, _id, value, flag, k, _ts, deleted FROM s"))
def stream_documents(spark, sf_dir):
    """Documents as keyed state; the newest row each key's changes gave, over two runs of one checkpoint."""
    base = scratch(spark)
    own = {PROVIDER: ROCKSDB, PARTITIONS: state_partitions(spark, n_events(spark, sf_dir))}
    before = {name: spark.conf.get(name) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        keyed_run(spark, sf_dir, base)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    rows = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out/batch=*").where("reason is null")
    newest = latest_per_key(rows.drop("batch", "reason"), ["ns", "_id"], "ts")
    return shown(newest.select("ns", "_id", F.parse_json("doc").alias("doc"), F.col("ts").alias("_ts"), "deleted"))


def state_partitions(spark: SparkSession, entries: int) -> int:
    """Partitions of keyed state: one for about ``FILE_ROWS`` entries, at least one a core.  Each costs a task with a Python worker and a store to open in every batch."""
    return max(spark.sparkContext.defaultParallelism, -(-entries // FILE_ROWS))


def keyed_run(spark: SparkSession, sf_dir: str, base: str) -> None:
    """The log's data entries through keyed state, in two runs; a batch's changes go to ``out/batch=<n>``."""
    stream = stored_stream(spark, sf_dir, base, parts=2)
    changed = documents(stream.where(F.substring_index("ns", ".", -1).isin(*DATA_COLLECTIONS)))

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    for _ in range(2):
        writer = changed.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint")
        writer.foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()


@query(""", w AS (SELECT ns, _id, ts FROM data WHERE kind IN ('insert', 'replace')), k AS (SELECT ns || '/' || _id AS _key, max(ts) AS ts FROM w GROUP BY ALL)
SELECT 'keys' AS what, count(*)::BIGINT AS n, sum(ts % 1000003)::DOUBLE AS total FROM k UNION ALL SELECT 'rows', count(*), NULL FROM w
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM w) - (SELECT count(*) FROM k), NULL UNION ALL SELECT 'chunks over 100 rows', 0, NULL UNION ALL SELECT 'short chunks but the last', 0, NULL""")
def chunked_write(spark, sf_dir):
    """All writes of whole documents in ordered chunks of 100; what was written, the duplicates among them, and that chunks are full."""
    base = scratch(spark)
    own = data_entries(change_log(spark, sf_dir)).where(is_whole())
    found = write_chunks(own.select("ns", "_id", F.col("o").alias("doc"), F.col("ts").alias("_ts")), f"{base}/chunks", 100)
    last = found.groupBy("task").agg(F.max("chunk").alias("last"))
    parts = [
        read_chunks(spark, f"{base}/chunks").agg(F.count("*").alias("n"), F.sum(F.col("ts") % 1000003).cast("double").alias("total")).withColumn("what", F.lit("keys")),
        *(found.agg(F.sum(c).cast("long").alias("n")).withColumn("what", F.lit(c)) for c in ("rows", "duplicates")),
        found.where("rows > 100").agg(F.count("*").alias("n")).withColumn("what", F.lit("chunks over 100 rows")),
        found.join(last, "task").where("rows < 100 and chunk < last").agg(F.count("*").alias("n")).withColumn("what", F.lit("short chunks but the last")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select("what", "n", "total")
