"""SimHash near-duplicates, searched by the generalised pigeonhole principle.

Fingerprint: words are runs of characters other than space and tab to carriage return, of the
text with A-Z lower-cased; a text's shingles are its runs of three words, repeats included (all
its words, if fewer); a bit is set if it is set in over half the XXH64 values (seed 42) of the
shingles.  Texts without a word, empty and null ones among them, have fingerprint zero.

Search, over distinct fingerprints only: the 64 bits are grouped into m partitions, correlated
bits together.  If two fingerprints differ in at most t bits, then for any thresholds t_1..t_m
that add up to t - m + 1 they differ in at most t_i bits within some partition i (t_i = -1 rules
partition i out).  Every fingerprint gets its own thresholds: dynamic programming minimises the
estimated number of candidates, with counts from histograms of at most 2**16 cells.  It then
probes partition i with all values within t_i of its own, and candidates are verified by the
exact distance, so no link is lost whatever the estimates.

Components of linked fingerprints come from ``connected_components``.  Nothing of the size of the
corpus reaches the driver: it gets a 65 x 65 matrix and at most 64 / 16 * 2**16 cells.

Rows with a null key get a fingerprint and a component; they don't count as least keys, and a
component of such rows alone has a null id.  Repeated rows are copies of each other.  An empty table gives no row;
of other columns none is read, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import columns, cut, pieces
from tidelog.llm.components import connected_components

BITS = 64
WITHIN = 2
SHINGLE = 3
SEED = 42
CELL_BITS = 16
BROADCAST_BYTES = 64 << 20


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The XXH64 values of a text's shingles, in order and with repeats; none without a word."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, xxh = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    last = min(shingle, len(words)) - 1
    n = len(words) - last
    spans = zip((ends - lengths)[:n].tolist(), ends[last:].tolist())
    return np.fromiter((xxh(joined[i:j], SEED) for i, j in spans), np.uint64, n)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of shingles, unsigned; zero without one."""
    counts, n = np.zeros(BITS, np.int64), len(hashes)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None) -> int:
    """The SimHash of one text, unsigned."""
    return fingerprint_of(shingle_hashes(text))


def mark(text: str) -> F.Column:
    """A hash by which rows of one key are told apart by their texts."""
    return F.xxhash64(text).alias("__mark")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, __mark (a hash of the text) and fingerprint (as a signed long) of every row."""

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts, 1):
            found = np.array([fingerprint(t.as_py()) for t in part.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(found)], [key, "__mark", "fp"])

    return df.select(key, text, mark(text)).mapInArrow(hashed, f"`{key}` {df.schema[key].dataType.simpleString()}, __mark long, fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> np.ndarray:
    """Co-occurrence counts of the 64 bits and of a constant, 65 x 65; the last cell is the number of rows."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1))
        for part in parts:
            ones = np.ones((part.num_rows, BITS + 1), np.float32)
            ones[:, :BITS] = _bits(part.column(0).to_numpy(zero_copy_only=False))
            total += ones.T @ ones
        cells = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel().astype(np.int64))], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((BITS + 1) ** 2, np.int64)
    for cell, n in rows:
        out[cell] = n
    return out.reshape(BITS + 1, BITS + 1)


def group_bits(stats: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size; each next bit of a group is the one most correlated with it."""
    n = max(1, stats[-1, -1])
    p = stats[-1, :BITS] / n
    cov = stats[:BITS, :BITS] / n - np.outer(p, p)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    corr = np.abs(cov / spread)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        first = max(left, key=lambda b: (corr[b, list(left)].sum(), -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def number_of_parts(n: int) -> int:
    """64 / log2(n), between 2 and 4: an exact probe then meets about one fingerprint by chance."""
    return int(min(4, max(2, round(BITS / np.log2(max(n, 4))))))


def project(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, packed."""
    unsigned, out = fps.view(np.uint64), np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((unsigned >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out.view(np.int64)


def cells_of(groups: list[list[int]]) -> list[list[list[int]]]:
    """Each group cut into pieces of at most CELL_BITS bits."""
    cut_up = []
    for group in groups:
        pieces = -(-len(group) // CELL_BITS)
        cut_up.append([list(map(int, piece)) for piece in np.array_split(group, pieces)])
    return cut_up


def histograms(fps: DataFrame, cells: list[list[list[int]]]) -> list[list[np.ndarray]]:
    """How many fingerprints have each value of each piece."""
    flat = [piece for pieces in cells for piece in pieces]

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << len(piece), np.int64) for piece in flat]
        for part in parts:
            own = part.column(0).to_numpy(zero_copy_only=False)
            for total, piece in zip(totals, flat):
                total += np.bincount(project(own, piece), minlength=len(total))
        for k, total in enumerate(totals):
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k, np.int32)), pa.array(used), pa.array(total[used])], ["piece", "value", "n"])

    out = [np.zeros(1 << len(piece), np.int64) for piece in flat]
    schema = "piece int, value long, n long"
    for piece, value, n in fps.select("fp").mapInArrow(counted, schema).groupBy("piece", "value").agg(F.sum("n")).toLocalIterator():
        out[piece][value] = n
    took = iter(out)
    return [[next(took) for _ in pieces] for pieces in cells]


def rings(hist: np.ndarray, within: int) -> np.ndarray:
    """[d, v]: how many have a value at distance d of v exactly, d from 0 to ``within``."""
    width, values = int(len(hist)).bit_length() - 1, np.arange(len(hist))
    out = np.zeros((within + 1, len(hist)))
    for d in range(within + 1):
        for flip in combinations(range(width), d):
            out[d] += hist[values ^ sum(1 << b for b in flip)]
    return out


def estimates(values: list[np.ndarray], tables: list[np.ndarray], n: int, within: int) -> np.ndarray:
    """[t, row]: estimated candidates within t, for values given by pieces that count as independent."""
    exact = tables[0][:, values[0]]
    for table, value in zip(tables[1:], values[1:]):
        other = table[:, value] / max(n, 1)
        exact = np.stack([sum(exact[a] * other[d - a] for a in range(d + 1)) for d in range(within + 1)])
    return np.cumsum(exact, axis=0)


def allocate(costs: list[np.ndarray], within: int) -> np.ndarray:
    """[row, partition]: thresholds from -1 that add up to within - m + 1, at the least total cost.

    ``costs[i][t]`` is partition i's cost at threshold t; -1 costs nothing.
    """
    m, rows = len(costs), costs[0].shape[1]
    best, choice = {0: np.zeros(rows)}, []
    for own in costs:
        nxt, picked = {}, {}
        for spent, cost in best.items():
            for t in range(-1, within + 1):
                to = spent + t + 1
                if to > within + 1:
                    continue
                total = cost + (own[t] if t >= 0 else 0.0)
                if to not in nxt:
                    nxt[to], picked[to] = total, np.full(rows, t, np.int8)
                else:
                    picked[to] = np.where(total < nxt[to], t, picked[to]).astype(np.int8)
                    nxt[to] = np.minimum(total, nxt[to])
        best = nxt
        choice.append(picked)
    out, left = np.empty((rows, m), np.int8), np.full(rows, within + 1)
    for i in reversed(range(m)):
        table = np.stack([choice[i].get(s, np.zeros(rows, np.int8)) for s in range(within + 2)])
        out[:, i] = table[left, np.arange(rows)]
        left = left - out[:, i] - 1
    return out


def links(fps: DataFrame, within: int = WITHIN, parts: int | None = None) -> DataFrame:
    """(a, b), a > b: all pairs of the distinct fingerprints ``fps`` (fp) that differ in at most ``within`` bits."""
    stats = bit_statistics(fps)
    n = int(stats[-1, -1])
    groups = group_bits(stats, parts or number_of_parts(n))
    cells = cells_of(groups)
    tables = [[rings(h, within) for h in hists] for hists in histograms(fps, cells)]
    held = fps.sparkSession.sparkContext.broadcast(tables)
    probes_of = [np.cumsum([len(list(combinations(range(len(g)), d))) for d in range(within + 1)]) for g in groups]
    flips = [[np.array([sum(1 << b for b in f) for f in combinations(range(len(g)), d)], np.int64) for d in range(within + 1)] for g in groups]
    names = ["part", "value", "fp"]

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for i, group in enumerate(groups):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), i, np.int32)), pa.array(project(own, group)), pa.array(own)], names)

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            costs = [
                estimates([project(own, piece) for piece in pieces], table, n, within) + probes_of[i][:, None]
                for i, (pieces, table) in enumerate(zip(cells, held.value))
            ]
            chosen = allocate(costs, within)
            for i, group in enumerate(groups):
                values = project(own, group)
                for d in range(within + 1):
                    rows = chosen[:, i] >= d
                    if rows.any():
                        value = (values[rows][:, None] ^ flips[i][d]).ravel()
                        fp = np.repeat(own[rows], len(flips[i][d]))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), i, np.int32)), pa.array(value), pa.array(fp)], names)

    schema = "part int, value long, fp long"
    index = fps.select("fp").mapInArrow(indexed, schema).withColumnRenamed("fp", "b")
    probe = fps.select("fp").mapInArrow(probed, schema).withColumnRenamed("fp", "a")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= within
    return probe.join(index, ["part", "value"]).where((F.col("a") > F.col("b")) & near).select("a", "b").distinct()


def simhash_groups(df: DataFrame, key: str = "doc_id", text: str = "text", within: int = WITHIN) -> DataFrame:
    """key, __mark, fp and component_id: the least key of all rows reachable over links of at most ``within`` bits."""
    hashed = cut(fingerprints(df, key, text))
    distinct = cut(hashed.groupBy("fp").agg(F.min(key).alias("least")))
    roots = connected_components(links(distinct, within))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select(key, "__mark", "fp", "component_id")


def simhash_report(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal, component_id."""
    return simhash_groups(df.select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", groups: Callable[..., DataFrame] = simhash_groups) -> DataFrame:
    """``df`` with one row of each component: that with the least key, of several texts under that key the one of the least hash.

    ``groups`` gives key, __mark and component_id of every row, so that a decision names a key and a text: rows that share a key
    but not a component are judged apart.  Of rows with equal keys and texts one stays, the least of them as JSON.  Rows with a null key
    can't be named by a decision and stay.
    """
    named = [key, "__mark"]
    grouped = cut(groups(df, key, text).where(F.col(key).isNotNull()).select(*named, "component_id"))
    own = grouped.where(F.col(key) == F.col("component_id"))
    several = own.groupBy(key).agg(F.min("__mark").alias("__least"), F.max("__mark").alias("__most")).where("__least <> __most")
    others = own.join(several, key).where("__mark <> __least").select(*named)
    gone = grouped.where(F.col(key) != F.col("component_id")).select(*named).unionByName(others).distinct()
    kept = without(df.withColumn("__mark", mark(text)), gone, named)
    again = cut(grouped.groupBy(*named).count().where("count > 1").select(*named))
    if again.isEmpty():
        return kept.drop("__mark")
    columns_ = columns(df)
    whole = F.struct(*columns_)
    once = kept.join(again, named, "left_semi").groupBy(*named).agg(F.min_by(whole, F.to_json(whole)).alias("__row"))
    return without(kept, again, named).select(*columns_).unionByName(once.select("__row.*"))


def without(df: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    """Anti-join: ``gone`` is broadcast if its counted size is within BROADCAST_BYTES, else shuffled."""
    gone = cut(gone)
    small = gone.count() * 24 <= BROADCAST_BYTES
    return df.join(F.broadcast(gone) if small else gone, key, "left_anti")
