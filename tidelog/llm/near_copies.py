"""Near copies by the Jaccard similarity of word shingles: SimHash links and MinHash bands for candidates, exact sets to verify.

Words are those of ``simhash``; a text's shingle set has its distinct runs of ``SHINGLE`` words (all
its words, if fewer), as XXH64 values.  Two texts are linked if the Jaccard similarity of their sets
is at least ``SIMILAR`` (4/5); groups are the components of links.  Texts of equal sets, among them
those without a word (null and empty ones), are copies.  Of columns only the key and the text are read; rows with a null key
get a component, but don't count as least keys; an empty table gives no row.

Fingerprints of two sets of similarity 0.8 differ in about ten of 64 bits, too many for a search by fingerprints alone.  So
candidates come from three sources, and each is verified on the exact sets:

1. ``simhash.links`` over the fingerprints of the shingles: a set of each fingerprint against one of the least that it is linked to, and sets of one
   fingerprint against one of them.
2. Bands: the least values of ``ROWS`` random permutations of the set.  Of pairs with similarity s a share of
   1 - (1 - s ** ROWS) ** BANDS shares a band: 0.9998 at 0.8.  Members of a band against the band's most central set, the one
   whose bands have the most members.  Most copies of one text are linked to it here, so no list of partners is gathered.
3. The rest, without pairing a band's members: sets of bands that aren't one component yet are joined on their first shingles, in an
   order of their band's center: shingles that are rare around it come first (in groups of up to ``FEW`` sets those that the center lacks, in larger ones those that about ``FEW`` of
   its sets have less than twice; any order finds the same pairs).  Two sets of similarity 0.8 have a common shingle so early that enough is left in
   both for what they must share.  A copy that is too far from its center begins with more shingles of its own than that, so it meets
   nothing but what shares these; and members of the center's component are not joined with each other.

Sets that are equal count once.  Sets are made again, from the texts, only for texts that share a band or a SimHash component;
verification compares the lower 32 bits of their values (by chance, two texts of 20,000 words agree in a tenth of a value).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.folders import removed
from tidelog.llm.common import cut, pieces, scratch, stored
from tidelog.llm.components import connected_components
from tidelog.llm.simhash import BROADCAST_BYTES, fingerprint_of, links, mark, shingle_hashes

SHINGLE = 5
#: The least similarity, as a fraction.
SIMILAR = (4, 5)
ROWS = 4
BANDS = 16
SEED = 42
STRIDE = 1 << 13
FEW = 32

_DRAW = np.random.default_rng(20_250_102)
_MULTIPLY = _DRAW.integers(1, 1 << 62, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _DRAW.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64)
_FOLD = _DRAW.integers(1, 1 << 62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _DRAW.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted values of a text's distinct shingles; empty without a word."""
    return np.unique(shingle_hashes(text, SHINGLE))


def bands_of(own: np.ndarray) -> np.ndarray:
    """The band values of a shingle set."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), STRIDE):
        mixed = own[at : at + STRIDE, None] * _MULTIPLY + _ADD
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MULTIPLY[::-1]
        np.minimum(least, mixed.min(axis=0), out=least)
    least ^= least >> np.uint64(29)
    folded = (least.reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64) ^ _BAND
    return folded ^ (folded >> np.uint64(31))


def _listed(parts: list[np.ndarray], kind: type) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, kind), *parts])))


def _identity(own: list[np.ndarray]) -> pa.Array:
    import xxhash

    return pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in own], dtype=np.uint64).view(np.int64))


def banded(df: DataFrame, key: str, text: str) -> DataFrame:
    """__key, __mark, fp (the SimHash of the shingles), sig (the identity of their set), its size and its bands, of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            every = [shingle_hashes(t.as_py(), SHINGLE) for t in batch.column(1)]
            fps = pa.array(np.array([fingerprint_of(h) for h in every], dtype=np.uint64).view(np.int64))
            own = [np.unique(h) for h in every]
            sizes, bands = pa.array([len(s) for s in own], pa.int32()), _listed([bands_of(s).view(np.int64) for s in own], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), fps, _identity(own), sizes, bands], ["__key", "__mark", "fp", "sig", "size", "bands"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text, mark(text)).mapInArrow(hashed, f"__key {kind}, __mark long, fp long, sig long, size int, bands array<long>")


def shingle_sets(texts: DataFrame, text: str) -> DataFrame:
    """sig and shingles, 32 bits of each, of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            own = [shingle_set(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([_identity(own), _listed([np.unique(s.astype(np.uint32)).view(np.int32) for s in own], np.int32)], ["sig", "shingles"])

    return texts.select(text).mapInArrow(hashed, "sig long, shingles array<int>")


def small(df: DataFrame) -> DataFrame:
    """``df``, materialised, and to be broadcast if its counted size is within BROADCAST_BYTES."""
    df = cut(df)
    return F.broadcast(df) if df.count() * 32 <= BROADCAST_BYTES else df


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of sets whose similarity is at least SIMILAR."""
    up, down = SIMILAR
    one = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("__a"))
    two = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("__b"))
    common = F.size(F.array_intersect("__a", "__b"))
    near = common * (up + down) >= (F.size("__a") + F.size("__b")) * up
    return small(pairs).join(one, "a").join(two, "b").where(near).select("a", "b").distinct()


def fingerprint_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): the least set of each fingerprint, and that of the least fingerprint it is linked to; other sets of a fingerprint, and its least one."""
    sets = cut(rows.where("size > 0").groupBy("sig").agg(F.min("fp").alias("fp")))
    least = cut(sets.groupBy("fp").agg(F.min("sig").alias("b"), F.count("*").alias("n")))
    near = links(least.select("fp")).groupBy("a").agg(F.min("b").alias("to"))
    other = least.select(F.col("fp").alias("to"), "b")
    linked = least.select(F.col("fp").alias("a"), F.col("b").alias("own")).join(small(near), "a").join(other, "to").select(F.col("own").alias("a"), "b")
    equal = sets.join(small(least.where("n > 1").drop("n")), "fp").where("sig <> b").select(F.col("sig").alias("a"), "b")
    return cut(linked.unionByName(equal))


def centers(crowd: DataFrame) -> DataFrame:
    """(band, center): each band's most central set; ``crowd`` has band, sig and n, the members of the band."""
    score = crowd.groupBy("sig").agg(F.sum("n").alias("score"))
    ranked = crowd.select("band", "sig").join(score, "sig")
    return ranked.groupBy("band").agg(F.max_by("sig", F.struct("score", "sig")).alias("center"))


def surroundings(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """(center, own): the shingles that are common around each center, by which the order of remaining_pairs goes."""
    sizes = cut(open_.groupBy("center").agg(F.count("*").alias("n")))
    few = sets.join(small(sizes.where(F.col("n") <= FEW).select(F.col("center").alias("sig"))), "sig", "left_semi").select(F.col("sig").alias("center"), F.col("shingles").alias("own"))
    step = F.ceil(F.col("n") / FEW)
    some = open_.join(small(sizes.where(F.col("n") > FEW)), "center").where(F.pmod(F.xxhash64("sig"), step) == 0).select("center", "sig")
    common = some.join(sets, "sig").select("center", F.explode("shingles").alias("token")).groupBy("center", "token").count().where("count > 1")
    many = common.groupBy("center").agg(F.collect_list("token").alias("own"))
    missing = sizes.where(F.col("n") > FEW).select("center").join(many, "center", "left").select("center", F.coalesce("own", F.array().cast("array<int>")).alias("own"))
    return few.unionByName(missing)


def remaining_pairs(open_: DataFrame, roots: DataFrame, sets: DataFrame, path: str) -> DataFrame:
    """(a, b): sets of different roots that can be similar by the place of their first common shingle; ``open_`` has center and sig.  Stores tables below ``path``."""
    up, down = SIMILAR
    rooted = open_.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    middle = surroundings(open_, sets).join(roots.withColumnRenamed("node", "center").withColumnRenamed("root", "home"), "center", "left")
    middle = middle.withColumn("home", F.coalesce("home", "center"))
    lacking, held = F.array_sort(F.array_except("shingles", "own")), F.array_sort(F.array_intersect("shingles", "own"))
    each = rooted.join(sets, "sig").join(middle, "center").select("center", "sig", "root", "home", F.size("shingles").alias("size"), F.concat(lacking, held).alias("tokens"))
    each = stored(each, f"{path}/each")
    least = each.groupBy("center").agg(F.min("size").alias("least"))
    partner = F.greatest("least", F.ceil(F.col("size") * up / down))
    longest = F.col("size") - F.ceil((F.col("size") + partner) * up / (up + down)) + 1
    first = each.join(least, "center").select(
        "center", "sig", "root", "home", "size", F.posexplode(F.slice("tokens", F.lit(1), F.greatest(longest, F.lit(0)).cast("int"))).alias("at", "token")
    )
    first = stored(first.withColumn("left", F.col("size") - F.col("at")).drop("at"), f"{path}/first")
    removed(first.sparkSession, f"{path}/each")
    outside = first.where("root <> home").select("center", "token", *(F.col(c).alias(f"{c}_b") for c in ("sig", "root", "size", "left")))
    enough = F.least("left", "left_b") * (up + down) >= (F.col("size") + F.col("size_b")) * up
    fits = (F.col("size") * down >= F.col("size_b") * up) & (F.col("size_b") * down >= F.col("size") * up)
    pairs = first.drop("home").join(outside, ["center", "token"]).where((F.col("root") != F.col("root_b")) & fits & enough)
    return pairs.select(F.greatest("sig", "sig_b").alias("a"), F.least("sig", "sig_b").alias("b")).distinct()


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, __mark and component_id: the least key of all rows reachable over links."""
    spark, path, work = df.sparkSession, scratch(df.sparkSession, "shingle-bands"), scratch(df.sparkSession, "near-copies")
    banded(df, key, text).write.parquet(path)
    rows = spark.read.parquet(path)
    members = rows.groupBy("sig").agg(F.min("__key").alias("least"))
    spread = stored(rows.where("size > 0").select("sig", F.explode("bands").alias("band")).distinct(), f"{work}/spread")
    shared = spread.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    crowd = stored(spread.join(shared, "band"), f"{work}/crowd")
    removed(spark, f"{work}/spread")
    near = fingerprint_pairs(rows)
    some = small(crowd.select("sig").unionByName(near.select(F.explode(F.array("a", "b")).alias("sig"))).distinct())
    keys = small(members.join(some, "sig", "left_semi").select(F.col("least").alias(key)).distinct())
    texts = df.select(key, text).join(keys, key, "left_semi").unionByName(df.select(key, text).where(F.col(key).isNull()))
    sets = stored(shingle_sets(texts, text).dropDuplicates(["sig"]), f"{work}/sets")
    center = cut(centers(crowd))
    around = crowd.join(center, "band").where("sig <> center").select(F.col("sig").alias("a"), F.col("center").alias("b"))
    first = cut(verified(near.unionByName(around).distinct(), sets))
    roots = connected_components(first)
    placed = stored(crowd.join(roots, F.col("sig") == F.col("node"), "left").select("band", "sig", F.coalesce("root", "sig").alias("root")), f"{work}/placed")
    mixed = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band").join(center, "band")
    open_ = stored(placed.join(mixed, "band").select("center", "sig").distinct(), f"{work}/open")
    for name in ("crowd", "placed"):
        removed(spark, f"{work}/{name}")
    second = verified(remaining_pairs(open_, roots, sets, work), sets)
    roots = connected_components(first.unionByName(second))
    removed(spark, work)
    rooted = members.select("sig", "least").join(roots, F.col("sig") == F.col("node"), "left").select("sig", "least", F.coalesce("root", "sig").alias("root"))
    rooted = cut(rooted)
    named = rooted.select("sig", "root").join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("sig", "component_id")
    return rows.select("__key", "__mark", "sig").join(named, "sig").select(F.col("__key").alias(key), "__mark", "component_id")
