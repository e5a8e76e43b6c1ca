"""Sharding by extendible hashing, with DataFrame functions only.

A row's hash is the first 60 bits of the MD5 of its key as text.  The directory starts with one
bucket of depth 0 that holds all rows; a bucket whose rows exceed the byte limit is split on the
next hash bit, others stay.  So a row's shard is the shallowest prefix of its hash whose rows
together fit the limit.

The bytes of every prefix come from one aggregation of rows by the prefix of ``STEP`` more bits than an even split needs,
rolled up ``LEVELS`` levels at a time to shorter prefixes; only rows of buckets that are still
too large go into the next round of ``STEP`` bits.  To find a row's shard, the directory is expanded to
prefixes of one length (about 2 ** STEP for each shard), so each row makes one lookup: by broadcast if the table's counted size is within
``BROADCAST_BYTES``, else by a shuffle on the prefix.  Rows of shards that are deeper, if there are any, make a second one.

A single row larger than the limit, or rows of one key that are, can't be told apart by bits: their
shard stays whole at depth 60 and has ``oversized`` set.  Null keys hash as empty text; null texts
have no bytes.  Repeated rows share a shard.  Empty tables give no shard.  A shard's name is its depth and its prefix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import columns, cut

LIMIT_BYTES = 64 << 20
#: The limit of the registered query: small, so that the smallest tables are split too.
QUERY_LIMIT_BYTES = 64 << 10
HASH_BITS = 60
STEP = 3
LEVELS = 10
BROADCAST_BYTES = 64 << 20


def hash_of(key: str) -> Column:
    """60 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(hashed: Column, depth: Column | int) -> Column:
    """The first ``depth`` bits."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", hashed, (F.lit(HASH_BITS) - depth).cast("int"))


def even_depth(total_bytes: int | None, limit_bytes: int) -> int:
    """The depth of an even split, and STEP more bits."""
    return min(HASH_BITS, max(0, math.ceil(math.log2(max(1, (total_bytes or 0) / limit_bytes)))) + STEP)


def rolled_up(fine: DataFrame, low: int, high: int) -> DataFrame:
    """(depth, bucket, shard_rows, shard_bytes) of all prefixes of ``low`` to ``high`` bits, from those of ``high`` (bucket, shard_rows, shard_bytes)."""
    levels, part = [fine.select(F.lit(high).alias("depth"), "bucket", "shard_rows", "shard_bytes")], fine
    while high > low:
        depths = list(range(max(low, high - LEVELS), high))
        each = part.withColumn("depth", F.explode(F.array(*map(F.lit, depths))))
        up = F.call_function("shiftright", F.col("bucket"), (F.lit(high) - F.col("depth")).cast("int"))
        sums = each.groupBy("depth", up.alias("bucket")).agg(F.sum("shard_rows").alias("shard_rows"), F.sum("shard_bytes").alias("shard_bytes"))
        sums, high = cut(sums), depths[0]
        levels.append(sums)
        part = sums.where(F.col("depth") == high).drop("depth")
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def sums_of() -> list[Column]:
    """Rows, bytes, and the least and greatest hash of a group of rows (hash, n_bytes)."""
    return [F.count("*").alias("shard_rows"), F.sum("n_bytes").alias("shard_bytes"), F.min("hash").alias("least"), F.max("hash").alias("most")]


def first_shards(sums: DataFrame, low: Column | int, limit_bytes: int) -> DataFrame:
    """Of all prefixes (depth, bucket, ...), those within the limit whose parent isn't; the parents of depth ``low`` aren't."""
    low = F.lit(low) if isinstance(low, int) else low
    large = sums.where(F.col("shard_bytes") > limit_bytes).select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
    fits = sums.where(F.col("shard_bytes") <= limit_bytes).withColumn("parent", F.call_function("shiftright", "bucket", F.lit(1)))
    below = fits.where(F.col("depth") > low).join(large, ["depth", "parent"], "left_semi")
    return fits.where(F.col("depth") == low).unionByName(below).select("depth", "bucket", "shard_rows", "shard_bytes")


def directory(sized: DataFrame, limit_bytes: int = LIMIT_BYTES) -> tuple[DataFrame, int]:
    """(depth, bucket, shard_rows, shard_bytes) of all shards of ``sized`` (hash, n_bytes), and the depth of an even split.

    A bucket of that depth that is still too large is final if all its hashes are one (no bit tells them apart); else it goes on at the first bit in which
    its least and greatest hash differ, STEP bits a round.  Rows of buckets that are final aren't looked at again.
    """
    sized = cut(sized)
    total = sized.agg(F.sum("n_bytes"), F.count("*")).first()
    high = depth = even_depth(total[0], limit_bytes)
    fine = cut(sized.groupBy(prefix(F.col("hash"), high).alias("bucket")).agg(*sums_of()))
    done = [first_shards(rolled_up(fine.drop("least", "most"), 0, high), 0, limit_bytes)]
    left, at = sized, prefix(F.col("hash"), high)
    ends = fine.select(F.lit(high).alias("high"), "bucket", "shard_rows", "shard_bytes", "least", "most")
    while True:
        large = ends.where(F.col("shard_bytes") > limit_bytes)
        one = F.col("least") == F.col("most")
        done.append(large.where(one).select(F.lit(HASH_BITS).alias("depth"), F.col("least").alias("bucket"), "shard_rows", "shard_bytes"))
        # the bit behind the one in which the hashes first differ
        low = F.lit(HASH_BITS + 1) - F.length(F.bin(F.col("least").bitwiseXOR(F.col("most"))))
        open_ = large.where(~one).select("high", "bucket", low.alias("low"))
        if open_.isEmpty():
            break
        inside = left.withColumn("bucket", at) if "high" in left.columns else left.withColumns({"bucket": at, "high": F.lit(high)})
        left = cut(inside.drop("low").join(small(open_), ["high", "bucket"]).select("hash", "n_bytes", "low", F.least(F.col("low") + STEP - 1, F.lit(HASH_BITS)).alias("high")))
        at = prefix(F.col("hash"), F.col("high"))
        ends = cut(left.groupBy("low", "high", at.alias("bucket")).agg(*sums_of()))
        each = ends.withColumn("depth", F.explode(F.sequence("low", "high")))
        up = F.call_function("shiftright", F.col("bucket"), (F.col("high") - F.col("depth")).cast("int"))
        sums = each.groupBy("low", "depth", up.alias("bucket")).agg(F.sum("shard_rows").alias("shard_rows"), F.sum("shard_bytes").alias("shard_bytes"))
        done.append(first_shards(sums, F.col("low"), limit_bytes))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return cut(out), depth


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if its counted size is within BROADCAST_BYTES."""
    return F.broadcast(df) if df.count() * 100 <= BROADCAST_BYTES else df


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """``df`` with n_bytes, shard, shard_depth, shard_rows, shard_bytes and oversized, in place of columns so named."""
    df = df.drop("n_bytes", "shard", "shard_depth", "shard_rows", "shard_bytes", "oversized")
    sized = df.select(hash_of(key).alias("hash"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    shards, depth = directory(sized, limit_bytes)
    found = ["shard_depth", "shard_rows", "shard_bytes", "shard", "oversized"]
    shards = shards.select(
        F.col("depth").alias("shard_depth"), F.col("bucket").alias("__bucket"), "shard_rows", "shard_bytes",
        F.concat_ws("-", F.lpad(F.col("depth").cast("string"), 2, "0"), F.lpad(F.conv(F.col("bucket").cast("string"), 10, 16), 15, "0")).alias("shard"),
        (F.col("shard_bytes") > limit_bytes).alias("oversized"),
    )
    shallow, deep = shards.where(F.col("shard_depth") <= depth), shards.where(F.col("shard_depth") > depth)
    first = F.call_function("shiftleft", F.col("__bucket"), (F.lit(depth) - F.col("shard_depth")).cast("int"))
    last = F.call_function("shiftleft", F.col("__bucket") + 1, (F.lit(depth) - F.col("shard_depth")).cast("int")) - 1
    table = shallow.select(F.explode(F.sequence(first, last)).alias("__prefix"), F.struct(*found).alias("__shard"))
    named = df.withColumns({"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "__hash": hash_of(key)})
    placed = named.withColumn("__prefix", prefix(F.col("__hash"), depth)).join(small(table), "__prefix", "left")
    if depths := sorted(r.shard_depth for r in deep.select("shard_depth").distinct().collect()):
        tried = F.when(F.col("__shard").isNull(), F.array(*map(F.lit, depths))).otherwise(F.array(F.lit(-1)))
        second = deep.select(F.col("shard_depth").alias("__depth"), "__bucket", F.struct(*found).alias("__deep"))
        placed = placed.withColumn("__depth", F.explode(tried)).withColumn("__bucket", F.when(F.col("__depth") >= 0, prefix(F.col("__hash"), F.col("__depth"))))
        placed = placed.join(small(second), ["__depth", "__bucket"], "left").where("__shard is not null or __deep is not null")
        placed = placed.withColumn("__shard", F.coalesce("__shard", "__deep")).drop("__depth", "__bucket", "__deep")
    return placed.select(*columns(df), "n_bytes", "__shard.*")


def shard_report(df: DataFrame) -> DataFrame:
    """doc_id and its shard of QUERY_LIMIT_BYTES."""
    return shard(df.select("doc_id", "text"), limit_bytes=QUERY_LIMIT_BYTES).drop("text")


def oracle(limit_bytes: int = QUERY_LIMIT_BYTES, source: str = "documents") -> str:
    """The same shards for DuckDB."""
    return f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_BITS // 4}))::BIGINT AS hash FROM {source}),
p AS (SELECT depth::INTEGER AS depth, hash >> ({HASH_BITS} - depth)::INTEGER AS bucket, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
      FROM d, range(0, {HASH_BITS} + 1) AS r(depth) GROUP BY ALL),
f AS (SELECT * FROM p WHERE shard_bytes <= {limit_bytes} OR depth = {HASH_BITS}),
s AS (SELECT d.doc_id, d.n_bytes, f.*, row_number() OVER (PARTITION BY d.doc_id, d.n_bytes ORDER BY f.depth) AS k
      FROM d JOIN f ON f.bucket = d.hash >> ({HASH_BITS} - f.depth)::INTEGER)
SELECT doc_id, n_bytes, depth AS shard_depth, shard_rows, shard_bytes,
       lpad(depth::VARCHAR, 2, '0') || '-' || lpad(upper(to_hex(bucket)), 15, '0') AS shard, shard_bytes > {limit_bytes} AS oversized
FROM s WHERE k = 1
"""
