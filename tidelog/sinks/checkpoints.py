"""Progress of each log, as a table and as the JSON text that other tools read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def advance(log: DataFrame) -> DataFrame:
    """(replset, ts) after a batch: the newest of all its entries, skipped ones included."""
    return log.groupBy("replset").agg(F.max("ts").alias("ts"))


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """The later checkpoint of each log."""
    return old.unionByName(new).groupBy("replset").agg(F.max("ts").alias("ts"))


def to_json(checkpoints: DataFrame) -> DataFrame:
    """One row, progress: ["name", ts] for one log, [["name", ts], ...] for several, in order of name."""
    pairs = F.array_sort(F.collect_list(F.struct("replset", "ts")))
    texts = F.transform(pairs, lambda p: F.concat(F.lit('["'), p.replset, F.lit('", '), p.ts, F.lit("]")))
    one = F.array_join(texts, ", ")
    return checkpoints.agg(F.when(F.size(pairs) == 1, one).otherwise(F.concat(F.lit("["), one, F.lit("]"))).alias("progress"))


def from_json(lines: DataFrame, column: str = "progress") -> DataFrame:
    """(replset, ts) from either shape; empty or broken text gives no row."""
    one = F.from_json(column, "array<string>")
    many = F.from_json(column, "array<array<string>>")
    rows = F.coalesce(F.when(F.get(F.get(many, F.lit(0)), F.lit(1)).isNotNull(), many), F.when(F.size(one) == 2, F.array(one)))
    pairs = lines.select(F.explode(rows).alias("p"))
    return pairs.select(F.get("p", F.lit(0)).alias("replset"), F.get("p", F.lit(1)).try_cast("long").alias("ts")).where("ts is not null")
