"""Alignment of two tokenizers' tokens over the bytes of a text.

Both give ends of tokens as byte offsets.  Divide and conquer at shared cuts: in an interval of tokens that begins and ends at shared ends, a
shared end near the middle is located (places outward from the middle, each looked up by bisection in the other's ends), and both halves go on by
themselves; an interval without one inside is a leaf, a group.  All intervals of one depth, of all stretches of a batch, are split at once.

Links are all pairs of a token of one and one of the other in a group.  How many documents hold a pair of ids linked is counted over the corpus.  The
pair counts are joined back in two ways: the most frequent pairs (at most ``HOT_PAIRS``, chosen by a histogram of counts with a row for each
power of two) are broadcast, all others joined by their key, of which none has more documents than the least frequent hot one.  So
no key that a large part of the documents share is ever shuffled by.

Texts are cut into stretches (``stretches``), whose tokens and groups don't depend on the others; both tokenizers end a token at every cut, so
cuts are shared ends, and the groups of a distinct stretch are made once.  Null and empty texts, and those whose tokens don't give their bytes
back (U+2581 stands for a space in one vocabulary), have no tokens.  Repeated rows are documents of their own, also with equal or null keys; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import pieces, scratch
from tidelog.llm.stretches import Memo, Pool, begins, flattened

#: So many pairs of ids at most are broadcast, 25 bytes each.
HOT_PAIRS = 1 << 19
#: Ids of the second vocabulary are below this.
SPREAD = 1 << 20
#: Places where neither vocabulary has a token that goes on: none holds a line feed beside other characters, or a space behind one.
STARTS = b" \n"
SPACE_PIECE = "▁"


def split_groups(a_ends: np.ndarray, b_ends: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> np.ndarray:
    """(a_from, a_to, b_from, b_to) of all groups, in order.

    ``a_ends`` and ``b_ends`` are increasing offsets; the intervals to begin with end at the tokens ``a_cuts`` and ``b_cuts`` (exclusive numbers).
    """
    lo = lambda cuts: np.append(0, cuts[:-1])[: len(cuts)]
    spans = np.stack([lo(a_cuts), a_cuts, lo(b_cuts), b_cuts], axis=1).astype(np.int64)
    leaves = []
    while len(spans):
        a_lo, a_hi = spans[:, 0], spans[:, 1]
        middle = (a_lo + a_hi - 1) // 2
        at_a = np.full(len(spans), -1)
        at_b = at_a.copy()
        left, step = np.arange(len(spans)), 0
        while len(left):
            open_ = np.zeros(len(left), dtype=bool)
            for place in (middle[left] + step, middle[left] - step - 1):
                inside = (place >= a_lo[left]) & (place < a_hi[left] - 1)
                open_ |= inside
                tried = np.flatnonzero(inside & (at_a[left] < 0))
                ends = a_ends[place[tried]]
                found = np.searchsorted(b_ends, ends)
                found[found == len(b_ends)] = 0
                hit = b_ends[found] == ends
                at_a[left[tried[hit]]], at_b[left[tried[hit]]] = place[tried[hit]] + 1, found[hit] + 1
            left, step = left[open_ & (at_a[left] < 0)], step + 1
        cut = at_a >= 0
        leaves.append(spans[~cut])
        own, a, b = spans[cut], at_a[cut], at_b[cut]
        halves = np.stack([np.stack([own[:, 0], a, own[:, 2], b], axis=1), np.stack([a, own[:, 1], b, own[:, 3]], axis=1)], axis=1)
        spans = halves.reshape(-1, 4)
    out = np.concatenate(leaves) if leaves else spans
    return out[np.argsort(out[:, 0], kind="stable")]


class Vocabularies:
    """Both tokenizers, loaded once a task, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
        shown = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*plain}))}
        self.a_bytes = [bytes(shown[c] for c in self.a.id_to_token(k)) if self.a.id_to_token(k) != "<|endoftext|>" else b"" for k in range(self.a.get_vocab_size())]
        piece = lambda k: bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace(SPACE_PIECE, " ").encode()
        self.b_bytes = [piece(k) for k in range(self.b.get_piece_size())]
        self.a_shown = [f"{k}{end}" for k in range(len(self.a_bytes)) for end in ",|"]
        self.b_shown = [f"{k}{end}" for k in range(len(self.b_bytes)) for end in ",;"]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))

    def encode(self, stretches: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Both tokenizers' ids of stretches, the second's without the space it puts before a text."""
        texts = [s.decode() for s in stretches]
        a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        # a line feed is always a token of its own: it and the space before it are the first two
        return a, [ids[2:] for ids in self.b.encode(["\n" + t for t in texts], num_threads=1)]


class Aligned:
    """What distinct stretches of a task's texts give: counts, text and linked pairs of their groups."""

    def __init__(self, vocabularies: Vocabularies):
        self.v, self.memo = vocabularies, Memo()
        self.counts = [np.empty((0, 4), dtype=np.int64)]
        self.right = [np.empty(0, dtype=bool)]
        self.texts: list[bytes] = []
        self.pairs, self.links = Pool(), Pool()

    def learn(self, at_once: int = 4096) -> None:
        """Aligns the stretches met since the last time, some thousand at once: the tokenizers' results take far more memory than what is kept."""
        fresh, self.memo.fresh = self.memo.fresh, []
        for k in range(0, len(fresh), at_once):
            self._add(fresh[k : k + at_once])
        self.counts, self.right = [np.concatenate(self.counts)], [np.concatenate(self.right)]
        self.pairs.settle()
        self.links.settle()

    def _add(self, fresh: list[bytes]) -> None:
        a, b = self.v.encode(fresh)
        right = [b"".join(map(self.v.a_bytes.__getitem__, x)) == s == b"".join(map(self.v.b_bytes.__getitem__, y)) for s, x, y in zip(fresh, a, b)]
        a, b = ([x if ok else [] for x, ok in zip(ids, right)] for ids in (a, b))
        (a_ids, a_counts), (b_ids, b_counts) = flattened(a), flattened(b)
        kept = np.flatnonzero(right)
        a_cuts, b_cuts = np.cumsum(a_counts), np.cumsum(b_counts)
        groups = split_groups(np.cumsum(self.v.a_sizes[a_ids]), np.cumsum(self.v.b_sizes[b_ids]), a_cuts[kept], b_cuts[kept])
        owner = np.searchsorted(a_cuts, groups[:, 0], side="right")
        self.texts += self._shown(a_ids, b_ids, groups, np.append(0, np.cumsum(a_counts + b_counts)))
        self._link(a_ids, b_ids, groups, owner, len(fresh))
        sizes = (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2])
        links = np.bincount(owner, sizes, minlength=len(fresh)).astype(np.int64)  # float64 sums, exact below 2^53
        self.counts.append(np.stack([a_counts, b_counts, np.bincount(owner, minlength=len(fresh)), links], axis=1))
        self.right.append(np.array(right, dtype=bool))

    def _shown(self, a_ids: np.ndarray, b_ids: np.ndarray, groups: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The groups of each stretch as text, by the numbers of its first and last token; every token is written with what follows it."""
        tokens = np.empty(len(a_ids) + len(b_ids), dtype=object)
        a_group = np.repeat(np.arange(len(groups)), groups[:, 1] - groups[:, 0])
        b_group = np.repeat(np.arange(len(groups)), groups[:, 3] - groups[:, 2])
        a_last, b_last = np.zeros(len(a_ids), dtype=bool), np.zeros(len(b_ids), dtype=bool)
        a_last[groups[:, 1] - 1], b_last[groups[:, 3] - 1] = True, True
        # the tokens of one vocabulary come behind those of the other in the groups up to theirs
        for at, ids, last, shown in ((np.arange(len(a_ids)) + groups[a_group, 2], a_ids, a_last, self.v.a_shown), (np.arange(len(b_ids)) + groups[b_group, 1], b_ids, b_last, self.v.b_shown)):
            tokens[at] = list(map(shown.__getitem__, (ids * 2 + last).tolist()))
        tokens, ends = tokens.tolist(), ends.tolist()
        return ["".join(tokens[i:j])[:-1].encode() for i, j in zip(ends, ends[1:])]

    def _link(self, a_ids: np.ndarray, b_ids: np.ndarray, groups: np.ndarray, owner: np.ndarray, n: int) -> None:
        """Keeps each stretch's distinct linked pairs and how often they are linked."""
        wide, high = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
        large = wide * high >= 64
        sizes = np.where(large, 0, wide * high)
        group = np.repeat(np.arange(len(groups)), sizes)
        place = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pairs = [a_ids[groups[group, 0] + place // high[group]] * SPREAD + b_ids[groups[group, 2] + place % high[group]]]
        owners, times = [owner[group]], [np.ones(len(group), dtype=np.int64)]
        for k in np.flatnonzero(large).tolist():
            i, j, m, e = groups[k].tolist()
            (x, a), (y, b) = (np.unique(ids, return_counts=True) for ids in (a_ids[i:j], b_ids[m:e]))
            pairs.append((x[:, None] * SPREAD + y).ravel())
            times.append((a[:, None] * b).ravel())
            owners.append(np.full(len(x) * len(y), owner[k]))
        pair, own, often = (np.concatenate(x) for x in (pairs, owners, times))
        pair, own, often = added_up(pair, own, often)
        sizes = np.bincount(own, minlength=n)
        self.pairs.add(pair, sizes)
        self.links.add(often, sizes)


def added_up(pairs: np.ndarray, owners: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each owner's distinct pairs with the sums of their times, by owner and pair."""
    order = np.lexsort((pairs, owners))
    pairs, owners, times = pairs[order], owners[order], times[order]
    first = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (owners[1:] != owners[:-1]))[: len(pairs)])
    return pairs[first], owners[first], np.add.reduceat(times, first) if len(first) else times


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<long>"


def align_texts(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """A row for each document: (key columns of ``df`` without its text) counts, digest of its groups, and its distinct linked pairs with how often they are linked."""
    rest = [c for c in df.columns if c != text]
    names = [*rest, *(f.split()[0] for f in ALIGNED.split(", "))]
    starts = begins(STARTS)

    def aligned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = Vocabularies(a_path, b_path)
        known = Aligned(vocabularies)
        for part in pieces(parts, len(rest)):
            if known.memo.full:
                known = Aligned(vocabularies)
            texts = part.column(len(rest)).cast(pa.large_string()).fill_null("")
            space, none = (pa.scalar(s, pa.large_string()) for s in (" ", ""))
            spaced = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(space, texts, none))
            numbers, lengths = known.memo.numbers(spaced, starts)
            known.learn()
            every, ends = numbers.tolist(), np.append(0, np.cumsum(lengths)).tolist()
            row = np.repeat(np.arange(len(texts)), lengths)
            wrong = np.zeros(len(texts), dtype=bool)
            wrong[row[~known.right[0][numbers]]] = True
            kept = ~wrong[row]
            numbers, row = numbers[kept], row[kept]
            # bincount adds as float64, exact below 2^53
            sums = [np.bincount(row, known.counts[0][numbers, c], minlength=len(texts)).astype(np.int64) for c in range(4)]
            digests = [
                hashlib.sha256(b";".join(map(known.texts.__getitem__, every[i:j]))).hexdigest() if j > i and not bad else "" for i, j, bad in zip(ends, ends[1:], wrong.tolist())
            ]
            cells, times = np.unique(row * len(known.texts) + numbers, return_counts=True) if len(row) else (row, row)
            which, owner = cells % max(1, len(known.texts)), cells // max(1, len(known.texts))
            pairs, sizes = known.pairs.take(which)
            links = known.links.take(which)[0] * np.repeat(times, sizes)
            owner = np.repeat(owner, sizes)
            pairs, owner, links = added_up(pairs, owner, links)
            offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64())) for values in (pairs, links)]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], *map(pa.array, sums), pa.array(digests, pa.string()), *lists], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)
    return df.select(*(F.col(f"`{c}`") for c in rest), text).mapInArrow(aligned, f"{kinds}, {ALIGNED}")


def count_pairs(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents hold each pair of ids linked, and whether no other pair of its first id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    path = scratch(aligned.sparkSession, "align-pairs")
    counts.write.parquet(path)
    counts = aligned.sparkSession.read.parquet(path)
    first = F.floor(F.col("pair") / SPREAD)
    # a row for each id of the first vocabulary, which bounds what is broadcast
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def hot_from(counts: DataFrame, most: int = HOT_PAIRS) -> int:
    """The least power of two such that at most ``most`` pairs are in so many documents or more; 1 if these are all."""
    bits = F.length(F.bin("n")) - 1
    by_bits = sorted(((r.bits, r.pairs) for r in counts.groupBy(bits.alias("bits")).agg(F.count("*").alias("pairs")).collect()), reverse=True)
    least, held = 62, 0
    for k, pairs in by_bits:
        held += pairs
        if held > most:
            return 1 << least
        least = k
    return 1


def weigh_links(aligned: DataFrame, counts: DataFrame, row: str = "_row", most: int = HOT_PAIRS) -> DataFrame:
    """(row, n_best, count_sum): of each row of ``aligned``, links whose pair is its first id's most frequent, and the sum of all links' counts."""
    spark = aligned.sparkSession
    path = scratch(spark, "align-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    limit = hot_from(counts, most)
    links = aligned.select(row, F.explode(F.arrays_zip("pairs", "links")).alias("c")).select(row, F.col("c.pairs").alias("pair"), F.col("c.links").alias("links"))
    hot = links.join(F.broadcast(counts.where(F.col("n") >= limit)), "pair", "left")
    found = _sums(hot.where("n is not null"), row)
    if limit == 1:
        return found
    rare = hot.where("n is null").drop("n", "best").join(counts.where(F.col("n") < limit), "pair")
    both = found.unionByName(_sums(rare, row))
    return both.groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _sums(found: DataFrame, row: str) -> DataFrame:
    best: Column = F.when(F.col("best"), F.col("links")).otherwise(0)
    return found.groupBy(row).agg(F.sum(best).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))


def alignment_report(df: DataFrame, a_path: str, b_path: str, most: int = HOT_PAIRS) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark, path = df.sparkSession, scratch(df.sparkSession, "align")
    made = align_texts(df.select("doc_id", "text"), a_path, b_path)
    made.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    aligned = spark.read.parquet(path)
    found = weigh_links(aligned, count_pairs(aligned), most=most)
    none = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return aligned.drop("pairs", "links").join(found, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256"
    )
