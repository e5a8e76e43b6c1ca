"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are put into a random but fixed order (by the MD5 of their key) and cut into
blocks of ``BLOCK_ROWS`` rows, at every size of the corpus.  While all sources last, block k (from 1) of a source with weight w
is released at (k - 1) / w and due at k / w, both rounded to whole slots.  One block is placed per slot: the released
block of earliest deadline (earliest-deadline-first, ties to the heavier source, then by name).
At every slot, each source has had within less than one block of its share.

Weights are given in whole parts of about ``PERIOD`` slots (or ``PERIOD_PARTS`` for each source), one at least; after such a period every source has had
exactly its parts, so the order of one period holds for all periods in which no source runs out (a cycle).  The period in
which one does is scheduled by itself (once): the source is left out from there on, and the others share its weight, so releases and deadlines are read off the
virtual time at which every source has had its weighted share.  Then a new cycle begins with the sources that are left.
The driver plans phases only: two for each time a source runs out; tasks schedule them, a period each.

Nothing is dropped or repeated: every row keeps one place, ``mix_position``, from 0 without gaps.  The rank of a row in its
source is found without a sort of the source: rows are counted in hash buckets of about ``BUCKET_ROWS`` rows,
running sums of these counts give each bucket its offset, and rows are ranked in their bucket.

Null sources are a source of their own.  Rows of equal key and source are ordered by their text's size and hash; rows equal in all
that are alike, and any order is right.  Rows without a key are placed by the MD5 of their text's size and hash.  An empty table stays empty.  Sources that have no target weight get weight 1; those of
weight 0 come after all others, in equal parts; weights that are negative or not finite are refused, and so are more than ``MAX_SOURCES`` sources.
Columns named mix_block and mix_position are replaced; other names don't matter, unless they begin with two underscores.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import columns, cut

BLOCK_ROWS = 64
PERIOD = 4096
PERIOD_PARTS = 16
MAX_SOURCES = 1 << 16
BUCKET_ROWS = 2_000
BROADCAST_BYTES = 32 << 20
POSITION_ROWS = 10_000


def served_time(weights: list[float], blocks: list[int]) -> tuple[list[tuple[float, float]], float]:
    """Points (virtual time, slots served) where sources run out; between them service is linear."""
    points, at, served = [(0.0, 0.0)], 0.0, 0.0
    left = sorted(range(len(weights)), key=lambda i: blocks[i] / weights[i])
    rate = sum(weights)
    for i in left:
        end = blocks[i] / weights[i]
        served += rate * (end - at)
        at = end
        points.append((at, served))
        rate -= weights[i]
    return points, served


def schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int]]:
    """(source, block from 0) of each slot, in order."""
    points, _ = served_time(weights, blocks)
    place = [0] * len(weights)

    def slots(i: int, count: int) -> float:
        """Slots served when source i has had ``count`` blocks of its share."""
        v = count / weights[i]
        k = place[i]
        while k + 1 < len(points) - 1 and points[k + 1][0] < v:
            k += 1
        place[i] = k
        (v0, t0), (v1, t1) = points[k], points[min(k + 1, len(points) - 1)]
        return t0 if v1 <= v0 else t0 + (t1 - t0) * (v - v0) / (v1 - v0)

    def window(i: int, k: int) -> tuple[int, int]:
        return math.floor(slots(i, k) + 1e-6), math.ceil(slots(i, k + 1) - 1e-6)

    waiting = [(*window(i, 0), -weights[i], i, 0) for i in range(len(weights)) if blocks[i]]
    heapq.heapify(waiting)
    ready: list[tuple[int, float, int, int]] = []
    slot = 0
    while waiting or ready:
        while waiting and (waiting[0][0] <= slot):
            _, due, w, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due, w, i, k))
        if not ready:  # rounding can leave a slot without a released block: the next release goes early
            _, due, w, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due, w, i, k))
        _, w, i, k = heapq.heappop(ready)
        yield i, k
        slot += 1
        if k + 1 < blocks[i]:
            heapq.heappush(waiting, (*window(i, k + 1), w, i, k + 1))


def default_weight(n: int, total: int) -> float:
    """Target weight of a source with n of all rows where none is given: its share to the power 0.5."""
    return math.sqrt(n / total)


class Phase(NamedTuple):
    """``repeats`` periods of equal order, from row ``row`` on; ``parts`` and ``caps`` are the sources' blocks in a period, ``firsts`` their first blocks."""

    row: int
    repeats: int
    sources: list[int]
    parts: list[int]
    caps: list[int]
    firsts: list[int]


def phases(weights: list[float], rows: list[int], block_rows: int) -> list[Phase]:
    """Cycles, and the periods in which sources run out.  A source's last block, which may be short, is never in a cycle."""
    left, row, out = [-(-n // block_rows) for n in rows], 0, []
    while some := [i for i, n in enumerate(left) if n]:
        weighted = [i for i in some if weights[i]] or some
        total, period = sum(weights[i] for i in weighted), max(PERIOD, PERIOD_PARTS * len(weighted))
        parts = [max(1, round(weights[i] / total * period)) if total else 1 for i in weighted]
        had = [-(-rows[i] // block_rows) - left[i] for i in weighted]
        if repeats := min((left[i] - 1) // p for i, p in zip(weighted, parts)):
            out.append(Phase(row, repeats, weighted, parts, parts, had))
            row += repeats * sum(parts) * block_rows
        caps = [min(p, left[i] - repeats * p) for i, p in zip(weighted, parts)]
        had = [h + repeats * p for h, p in zip(had, parts)]
        out.append(Phase(row, 1, weighted, parts, caps, had))
        for i, p, cap in zip(weighted, parts, caps):
            left[i] -= repeats * p + cap
            row += cap * block_rows - (-rows[i] % block_rows if not left[i] else 0)
    return out


def places(phase: Phase, rows: list[int], block_rows: int) -> Iterator[tuple[int, int, int]]:
    """(source, block within the period, first row within the phase) of each slot of a phase's period."""
    at = 0
    for i, k in schedule([float(p) for p in phase.parts], phase.caps):
        source = phase.sources[i]
        yield source, k, at
        at += min(block_rows, rows[source] - (phase.firsts[i] + k) * block_rows)


def placed_blocks(spark: SparkSession, plan: list[Phase], rows: list[int], block_rows: int) -> DataFrame:
    """(__s, __phase, __nth, __at) of the blocks of one period of every phase; tasks make the schedules."""

    def scheduled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n in part.column(0).to_pylist():
                columns_ = list(zip(*((i, n, k, at) for i, k, at in places(plan[n], rows, block_rows))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns_, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))], ["__s", "__phase", "__nth", "__at"])

    numbers = spark.range(0, len(plan), numPartitions=max(1, min(len(plan), 200)))
    return cut(numbers.mapInArrow(scheduled, "__s int, __phase int, __nth long, __at long"))


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, to be broadcast if its counted size is within BROADCAST_BYTES."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def mix(df: DataFrame, weights: dict[str, float] | None = None, key: str = "doc_id", source: str = "source", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with mix_block (of its source, from 0) and mix_position, in place of columns so named."""
    if bad := [w for w in (weights or {}).values() if not (math.isfinite(w) and w >= 0)]:
        raise ValueError(f"no weights: {bad}")
    df, spark = df.drop("mix_block", "mix_position"), df.sparkSession
    sources = cut(df.groupBy(source).count())
    if sources.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    counts = {r[0]: r[1] for r in sources.collect()}
    total, names = sum(counts.values()), sorted(counts, key=lambda s: (s is None, str(s)))
    rows, given = [counts[s] for s in names], [weights.get(s, 1.0) if weights else default_weight(counts[s], total) for s in names]
    plan = phases(given, rows, block_rows)
    blocks = small(placed_blocks(spark, plan, rows, block_rows), 32)
    own = {i: [] for i in range(len(names))}
    for n, phase in enumerate(plan):
        for i, part, first in zip(phase.sources, phase.parts, phase.firsts):
            own[i].append((first, part, n, phase.row, sum(phase.parts) * block_rows))
    held = "array<struct<first:long,part:long,phase:int,row:long,step:long>>"
    numbered = spark.createDataFrame(list(zip(names, range(len(names)))), f"__name {df.schema[source].dataType.simpleString()}, __s int")
    # joined after the ranking, so that only keys and texts are shuffled by it
    phased = spark.createDataFrame([(i, own[i]) for i in range(len(names))], f"__s int, __own {held}")
    phased = F.broadcast(phased) if sum(map(len, own.values())) * 40 <= BROADCAST_BYTES else phased

    # rows without a key are spread by what else tells them apart
    placed_by = F.coalesce(F.col(key).cast("string"), F.concat_ws(" ", F.octet_length(text), F.xxhash64(text)))
    hashed = F.conv(F.substring(F.md5(placed_by), 1, 15), 16, 10).cast("long")
    bits = max(0, math.ceil(math.log2(max(1, total // BUCKET_ROWS))))
    dealt = df.withColumns({"__hash": hashed, "__size": F.octet_length(text), "__tie": F.xxhash64(text)})
    dealt = dealt.withColumn("__bucket", F.shiftright("__hash", 60 - bits)).join(F.broadcast(numbered), F.col(source).eqNullSafe(F.col("__name")))
    sizes = dealt.groupBy("__s", "__bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small(cut(sizes.select("__s", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))), 40)
    inside = Window.partitionBy("__s", "__bucket").orderBy("__hash", F.col(key), "__size", "__tie")
    ranked = dealt.withColumn("__rank", F.row_number().over(inside) - 1)
    ranked = ranked.join(offsets, ["__s", "__bucket"]).join(phased, "__s").withColumn("__rank", F.col("__rank") + F.col("__offset"))
    ranked = ranked.withColumn("mix_block", F.expr(f"__rank div {block_rows}"))
    ranked = ranked.withColumn("__in", F.element_at(F.filter("__own", lambda p: p.first <= F.col("mix_block")), -1))
    ranked = ranked.withColumns({"__phase": F.col("__in.phase"), "__nth": (F.col("mix_block") - F.col("__in.first")) % F.col("__in.part")})
    here = F.col("__in.row") + F.expr("(mix_block - __in.first) div __in.part") * F.col("__in.step") + F.col("__at") + F.col("__rank") % block_rows
    return ranked.join(blocks, ["__s", "__phase", "__nth"]).withColumn("mix_position", here).select(*columns(df), "mix_block", "mix_position")


def in_order(mixed: DataFrame, rows: int) -> DataFrame:
    """The rows in the order of their position: partition p holds positions from p * POSITION_ROWS on, sorted.

    Rows without a position (null) come first; ``rows`` says how many there are and only sets the number of partitions; an empty table is one empty partition.
    """
    parts = max(1, -(-rows // POSITION_ROWS))
    return mixed.repartitionById(parts, F.floor(F.col("mix_position") / POSITION_ROWS).cast("int")).sortWithinPartitions("mix_position")


def stored_position(docs: DataFrame) -> DataFrame:
    """``docs``, read from files that were written ``in_order``, with each row's mix_position: by part number, then by row.

    Rows that come from no Parquet file have no order; their position is null.  One count for each file reaches the driver.
    """
    own = [name for name in docs.columns if name != "mix_position"]
    try:
        placed = docs.select(*(F.col(f"`{name}`") for name in own), F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        return docs.withColumn("mix_position", F.lit(None).cast("long"))
    sizes = {r[0]: r[1] for r in placed.groupBy("__file").agg(F.max("__row") + 1).collect()}
    firsts, position = [], 0
    for name in sorted(sizes, key=lambda name: [(not piece.isdigit(), int(piece) if piece.isdigit() else 0, piece) for piece in re.split(r"(\d+)", name)]):
        firsts.append((name, position))
        position += sizes[name]
    plan = docs.sparkSession.createDataFrame(firsts, "__file string, __first long")
    found = placed.join(F.broadcast(plan), "__file").withColumn("mix_position", F.col("__first") + F.col("__row"))
    return found.select(*(F.col(f"`{name}`") for name in own), "mix_position")


def mix_report(df: DataFrame) -> DataFrame:
    """doc_id, source, mix_block and mix_position."""
    return mix(df.select("doc_id", "source", "text")).drop("text")
