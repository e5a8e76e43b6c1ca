"""Reading change logs, and deriving one from the ``events`` table.

A log row: ts, replset, event_id, op (i, u, d, c or n), ns, _id, from_migrate, o (the whole document
of inserts and replacements, VARIANT), set (map of dotted path to VARIANT), unset (paths).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.scalars import pack_ts

LOG_SCHEMA = (
    "ts BIGINT, replset STRING, event_id BIGINT, op STRING, ns STRING, _id BIGINT, from_migrate BOOLEAN, "
    "o VARIANT, `set` MAP<STRING,VARIANT>, unset ARRAY<STRING>"
)


def log_schema(key: str = "BIGINT") -> str:
    """The schema of a log whose documents have keys of another type."""
    return LOG_SCHEMA.replace(", _id BIGINT", f", _id {key}")


# Collections by user_id modulo 7.
COLLECTIONS = ("system.profile", "fs.files", "fs.chunks", "users", "carts", "orders", "orders")
DATA_COLLECTIONS = ("users", "carts", "orders")


def read_log(spark: SparkSession, path: str, fmt: str = "parquet", key: str = "BIGINT") -> DataFrame:
    """A stored log; JSON lines keep documents as objects."""
    return spark.read.schema(log_schema(key)).format(fmt).load(path)


def scan_log(log: DataFrame, since: int | None = None) -> DataFrame:
    """Entries from a timestamp on (inclusive), never no-ops; both conditions reach the scan."""
    log = log.where("op <> 'n'")
    return log if since is None else log.where(F.col("ts") >= since)


def resume_log(log: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Entries strictly after their log's checkpoint; a log without one is read whole."""
    held = checkpoints.select("replset", F.col("ts").alias("_from"))
    return scan_log(log).join(held, "replset", "left").where("_from is null or ts > _from").drop("_from")


def merge_logs(*logs: DataFrame) -> DataFrame:
    """Several logs as one; order holds within a replset only."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out


def entries_of(events: DataFrame, nested: bool = False) -> DataFrame:
    """The change log that ``events`` stands for.

    signup inserts, view replaces, error deletes, purchase sets and click unsets; every 97th event is
    a no-op and every 89th a migration.  ``nested`` uses dotted paths in updates.
    """
    kind, user = F.col("event_type"), F.col("user_id")
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    op = F.when(F.col("event_id") % 97 == 0, "n").when(kind == "signup", "i").when(kind == "error", "d").otherwise("u")
    coll = F.element_at(F.array(*map(F.lit, COLLECTIONS)), (user % 7 + 1).cast("int"))
    k = F.get_json_object("props", "$.k").cast("long")
    whole = F.to_variant_object(F.struct("value", kind.alias("flag"), F.struct(k.alias("k")).alias("p")))
    if nested:
        sets = F.create_map(F.lit("p.k"), k.cast("variant"), F.concat(F.lit("tags."), user % 3), F.col("value").cast("variant"))
        unsets = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("p.k"))).otherwise(F.array(F.lit("flag")))
    else:
        sets = F.create_map(F.lit("value"), F.col("value").cast("variant"))
        unsets = F.array(F.lit("flag"))
    update = op == "u"
    return events.select(
        pack_ts(seconds, F.col("event_id")).alias("ts"),
        F.when(user % 2 == 0, "rs0").otherwise("rs1").alias("replset"),
        "event_id",
        op.alias("op"),
        F.concat(F.lit("shop"), user % 5, F.lit("."), coll).alias("ns"),
        user.alias("_id"),
        (F.col("event_id") % 89 == 0).alias("from_migrate"),
        F.when((op == "i") | (update & (kind == "view")), whole).alias("o"),
        F.when(update & (kind == "purchase"), sets).alias("set"),
        F.when(update & (kind == "click"), unsets).alias("unset"),
    )


def change_log(spark: SparkSession, sf_dir: str, nested: bool = False) -> DataFrame:
    return entries_of(spark.read.parquet(f"{sf_dir}/events.parquet"), nested)


def data_entries(log: DataFrame) -> DataFrame:
    """Entries of the ordinary collections."""
    return log.where(F.substring_index("ns", ".", -1).isin(*DATA_COLLECTIONS) & (F.col("op") != "n"))


def n_events(spark: SparkSession, sf_dir: str) -> int:
    """How many events there are; event_id counts them from 0."""
    return (spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id")).first()[0] or 0) + 1
