"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Symbols are words (runs of word characters, lower case); in scripts written without spaces (Han,
kana, Thai, Lao, Khmer, Myanmar, Tibetan) each letter or mark is a symbol of its own.  A text holds an item of n words if some
stretch of it is within k = (1 - LEAST) * n edits of the item.

Embedding: a walk reads a window from its first word on; at each step it writes the word it stands
at, and a random bit of (walk, step, word) says whether it moves to the next one.  Two windows a few edits
apart fall out of step at an edit and meet again after it, so edit distance becomes Hamming distance
of what they write.  Sampling: a walk's steps are cut into ``SPAN`` steps, and of each of them ``TAKEN``
random ones are hashed.  A walk that starts with an item, or at a later word of it, gives a sign for each span that ends within the item
and samples enough of its words; a text's window meets the item if it has the same sign in the same span.  Windows start at every
word; those that stand at one word at one step stay together from then on and are followed once, which makes long walks cheap.

Recall: at the largest distance allowed, edited copies of the benchmark's own items (edits at random places, evenly
spaced, in front and at the end; ``TRIALS`` for each range of item lengths) are searched, walk after walk, until a
share of ``MEASURED`` of them is met.  As walks are drawn independently, a multiple of that number of walks misses about the power of what
it misses of the edits it misses most; the number is set so that about 1 - ``RECALL`` is left.  Nothing caps it.

A meeting stays only if the words around it that are the item's are enough of them, which loses
nothing.  Then it is verified exactly: the item's least edit distance (in words) to any stretch of
the text around the window must be at most k.

Items of fewer than ``FEWEST`` words are met by the hash of all their words (or, at a lower LEAST that allows an edit, of each
of them).  A whole copy is always met: its first span is the item's, and ends within it.  Empty and null items match nothing; null and empty texts
contain nothing.  Rows with null or repeated keys each give their own hits; keys may be of any type, and extra columns
with any name are left alone.  Empty tables give no hit.  Items are held in blocks of at most ``BLOCK`` items per
pass, so what is broadcast is bounded.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.llm.common import pieces

LEAST = 0.8
#: Items of fewer words have no word to spare at LEAST.
FEWEST = 5
SPAN, TAKEN, WORDS = 6, 4, 3
RECALL, MEASURED, TRIALS = 0.99999, 0.9, 400
BLOCK = 10_000
SEED = 20_250_101
#: Blocks of scripts without spaces between words.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3100, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF),
)
FLUSH = 1 << 20
STARTS = 1 << 18
CELLS = 1 << 19


def _letters() -> str:
    """The letters and marks of UNSPACED, as ranges of a character class."""
    out = []
    for a, b in UNSPACED:
        if a >= 0x20000:
            out.append(f"{chr(a)}-{chr(b)}")
            continue
        out += [re.escape(chr(c)) for c in range(a, b + 1) if unicodedata.category(chr(c))[0] in "LM" or c == 0x3007]
    return "".join(out)


def _word() -> re.Pattern:
    own = _letters()
    return re.compile(rf"[{own}]|[^\W{own}]+")


WORD = _word()


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if isinstance(text, str) else []


def mixed(values: np.ndarray) -> np.ndarray:
    """Hashes whose high bits depend on all bits."""
    out = values * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(32))


def bit_table(hashes: np.ndarray) -> np.ndarray:
    """A table of 2 ** 12 to 2 ** 26 flags with those of ``hashes`` set, an eighth of it at most if its size allows."""
    table = np.zeros(1 << min(26, max(12, (8 * len(hashes)).bit_length())), bool)
    table[slots(hashes, table)] = True
    return table


def slots(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(65 - len(table).bit_length())).astype(np.int64)


def random_bits(values: np.ndarray, walk: int, block: int) -> np.ndarray:
    """32 bits of each word for the steps from 32 * ``block`` of a walk on."""
    out = values + np.uint32(((2 * walk + 1) * 0x9E3779B9 + block * 0x85EBCA77) & 0xFFFFFFFF)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        out ^= out >> np.uint32(shift)
        out *= np.uint32(factor)
    return out ^ (out >> np.uint32(16))


@functools.cache
def sampled(walk: int, span: int) -> np.ndarray:
    """Which steps of a span are hashed: TAKEN of them; of the first span the first ones, which no item of FEWEST words ends within."""
    if not span:
        return np.arange(SPAN) < TAKEN
    draw = np.random.default_rng([SEED, walk, span])
    return np.isin(np.arange(SPAN), draw.permutation(SPAN)[:TAKEN])


def walks(values: np.ndarray, starts: np.ndarray, walk: int, merge: bool) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each span of a walk over ``values`` from ``starts``: the walks' places at its first step, their signs, and the places sampled.

    With ``merge``, walks that stand at one place go on as one, and those that leave ``values`` end; ``starts`` must be sorted.
    """
    size = len(values)
    values = np.append(values, np.zeros(SPAN, np.uint32))
    at, moves, step, span = starts, values, 0, 0
    while len(at):
        first, seen, held = at, [], np.empty(len(at), np.uint32)
        sign = np.full(len(at), (span + 1) * 0x2545F491 & 0xFFFFFFFF, np.uint32)
        for take in sampled(walk, span):
            if step % 32 == 0:
                moves = random_bits(values, walk, step // 32)
            if take:
                sign *= np.uint32(0x9E3779B1)
                sign += np.take(values, at, out=held, mode="clip")
                seen.append(at)
            np.take(moves, at, out=held, mode="clip")
            held >>= np.uint32(step % 32)
            held &= np.uint32(1)
            at = at + held
            step += 1
        yield first, sign, seen
        at = at[np.append(True, at[1:] != at[:-1]) & (at < size)] if merge else np.minimum(at, size)
        span += 1


class Signs:
    """Signs of items, sorted, with the items and the places in them that the signs belong to."""

    def __init__(self, signs: np.ndarray, items: np.ndarray, places: np.ndarray):
        order = np.argsort(signs, kind="stable")
        self.items, self.places = items[order].astype(np.int32), places[order].astype(np.int32)
        self.keys, first = np.unique(signs[order], return_index=True)
        self.first = np.append(first, len(order)).astype(np.int32)
        self.table = bit_table(mixed(self.keys.astype(np.uint64)))

    def find(self, signs: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place, item, the item's start if it lies there) of each meeting, about CELLS at a time."""
        if not len(self.keys):
            return
        own = np.flatnonzero(self.table[slots(mixed(signs.astype(np.uint64)), self.table)])
        key = np.minimum(np.searchsorted(self.keys, signs[own]), len(self.keys) - 1)
        there = self.keys[key] == signs[own]
        at, key = places[own[there]], key[there]
        first = self.first[key].astype(np.int64)
        count = self.first[key + 1] - first
        ends, begin = np.cumsum(count), 0
        while begin < len(at):
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + CELLS, "right")))
            n = count[begin:end]
            row = np.repeat(first[begin:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            place = np.repeat(at[begin:end], n)
            yield place, self.items[row].astype(np.int64), place - self.places[row]
            begin = end


def index_walk(items: list[np.ndarray], ids: np.ndarray, fewest: np.ndarray, walk: int) -> list[Signs]:
    """The signs of items (as values) for each span of a walk, up to the last that an item holds.

    Walks start at every word of an item, as they do in a text, so both stand at the same words where they agree for a while.
    A span counts if it ends within its item and samples ``fewest`` words of it at least; of those that start with an item, the first always.
    """
    sizes = np.array([len(i) for i in items], np.int64)
    flat, ends, out = np.concatenate(items), np.cumsum(sizes), []
    for first, sign, seen in walks(flat, np.arange(len(flat)), walk, merge=True):
        if SPAN * len(out) > 2 * sizes.max() + 4 * SPAN:
            break
        own = np.searchsorted(ends, first, "right")
        place = first - (ends - sizes)[own]
        words = 1 + sum((b > a).astype(np.int64) for a, b in zip(seen, seen[1:]))
        good = (seen[-1] < ends[own]) & ((words >= fewest[own]) | ((place == 0) & (walk + len(out) == 0)))
        out.append(Signs(sign[good], ids[own[good]], place[good]))
    return out


def window_signs(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of all words of each window of ``size``."""
    n = max(0, len(values) - size + 1)
    out = np.zeros(n, np.uint32)
    for k in range(size):
        out = out * np.uint32(0x9E3779B1) + values[k : k + n]
    return out


def edited(item: np.ndarray, most: int, pattern: int, draw: np.random.Generator, other: np.ndarray) -> np.ndarray:
    """A copy of ``item`` with ``most`` edits: at random places, evenly spaced, in front, at the end (``pattern`` 0 to 3)."""
    n = len(item)
    places = [draw.permutation(n)[:most], np.arange(most) * n // most + draw.integers(0, max(1, n // most)), np.arange(most), n - 1 - np.arange(most)][pattern]
    own = [[v] for v in item.tolist()]
    for place, kind in zip(places.tolist(), draw.integers(0, 3, most).tolist()):
        own[min(place, n - 1)] = [[], [int(draw.choice(other))], [*own[min(place, n - 1)], int(draw.choice(other))]][kind]
    return np.array([v for part in own for v in part], np.uint32)


def least_distance(pattern: list, text: list) -> tuple[int, int]:
    """(distance, end): least edit distance of ``pattern`` to any stretch of ``text``, and the first end that has it."""
    m = len(pattern)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    at: dict = defaultdict(int)
    for i, word in enumerate(pattern):
        at[word] |= 1 << i
    plus, minus, score, best = ones, 0, m, (m, 0)
    for end, word in enumerate(text, 1):
        eq = at.get(word, 0)
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = (minus | ~(across | plus)) & ones, plus & across
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & ones, (down << 1) & ones
        vertical = eq | minus
        plus, minus = (down | ~(vertical | up)) & ones, up & vertical
        if score < best[0]:
            best = (score, end)
    return best


@dataclass
class Finder:
    """A block of items, prepared for the search; sent to the executors once."""

    ids: list
    items: list[list[str]]
    least: float = LEAST

    def __post_init__(self):
        draw = np.random.default_rng(SEED)
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for item in self.items for w in item), 1)}
        self.values = draw.integers(1, 1 << 32, len(self.vocabulary) + 1, dtype=np.uint32)
        self.sizes = np.array([len(item) for item in self.items], np.int64)
        self.mosts = np.array([self.most(k) for k in range(len(self.items))], np.int64)
        coded = [np.array([self.vocabulary[w] for w in item], np.int64) for item in self.items]
        words = [self._own_word(own, np.int64(k)) for k, own in enumerate(coded)]
        self.bag = bit_table(np.concatenate([np.zeros(0, np.uint64), *words]))
        valued = [self.values[own] for own in coded]
        self.whole = self._index_short(valued)
        self.needed = {int(most): self._walks_needed(valued, int(most)) for most in np.unique(self.mosts[self.sizes >= FEWEST])}
        self.index = []
        for walk in range(max(self.needed.values(), default=0)):
            own = np.flatnonzero([size >= FEWEST and walk < self.needed[most] for size, most in zip(self.sizes.tolist(), self.mosts.tolist())])
            self.index.append(index_walk([valued[k] for k in own], own, np.array([self._fewest(m) for m in self.mosts[own].tolist()]), walk))

    def _index_short(self, valued: list[np.ndarray]) -> dict[int, Signs]:
        """Signs of items of fewer than FEWEST words, by the words they hash."""
        rows = defaultdict(list)
        for k, own in enumerate(valued):
            if 0 < len(own) < FEWEST:
                size = 1 if self.mosts[k] else len(own)
                rows[size] += [(sign, k, at) for at, sign in enumerate(window_signs(own, size))]
        return {size: Signs(*(np.array(c, kind) for c, kind in zip(zip(*own), (np.uint32, np.int64, np.int64)))) for size, own in rows.items()}

    def _shortest(self, most: int) -> int:
        """The fewest words (from FEWEST on) of an item that allows ``most`` edits."""
        n = max(FEWEST, int(most / (1 - self.least)) - 1) if most else FEWEST
        while int((1 - self.least) * n + 1e-9) < most:
            n += 1
        return n

    def _fewest(self, most: int) -> int:
        """How many words a span samples at least: as many as are sure to stand together after ``most`` edits, or WORDS."""
        return min(WORDS, self._shortest(most) // (most + 1))

    def _walks_needed(self, valued: list[np.ndarray], most: int) -> int:
        """How many walks meet edited copies of the items that allow ``most`` edits with probability RECALL."""
        if most == 0:
            return 1
        shortest = self._shortest(most)
        own, draw = np.flatnonzero((self.mosts == most) & (self.sizes >= FEWEST)), np.random.default_rng([SEED, most])
        chosen = [valued[k][:shortest] for k in draw.choice(own, TRIALS)]
        texts, owner = [], []
        for k, item in enumerate(chosen):
            copy = edited(item, most, k % 4, draw, self.values)
            texts += [draw.choice(self.values, 4), copy, draw.choice(self.values, 4)]
            owner.append(np.full(8 + len(copy), k))
        flat, owner = np.concatenate(texts), np.concatenate(owner)
        met, walk = np.zeros(TRIALS, bool), 0
        while met.mean() < MEASURED:
            for signs, (first, sign, _) in zip(index_walk(chosen, np.arange(TRIALS), np.full(TRIALS, self._fewest(most)), walk), walks(flat, np.arange(len(flat)), walk, merge=True)):
                for place, item, _ in signs.find(sign, first):
                    met[item[owner[place] == item]] = True
            walk += 1
        missed = max(1 - met[pattern::4].mean() for pattern in range(4))
        return math.ceil(walk * math.log(1 - RECALL) / math.log(max(missed, 1 / TRIALS)))

    @staticmethod
    def _own_word(symbols: np.ndarray, items: np.ndarray) -> np.ndarray:
        """A hash of each (item, symbol)."""
        return mixed((items.astype(np.uint64) << np.uint64(32)) + symbols.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)

    def meetings(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place, item, window start) of all windows that meet an item; symbol 0 stands for every word of no item."""
        values = self.values[symbols]
        for size, signs in self.whole.items():
            own = window_signs(values, size)
            for found in signs.find(own, np.arange(len(own))):
                yield self._kept(symbols, *found)
        for walk, spans in enumerate(self.index):
            reach = SPAN * len(spans)
            for begin in range(0, len(values), STARTS):
                part = values[begin : begin + STARTS + reach]
                for signs, (first, sign, _) in zip(spans, walks(part, np.arange(min(STARTS, len(part))), walk, merge=True)):
                    for place, item, start in signs.find(sign, first):
                        yield self._kept(symbols, place + begin, item, start + begin)

    def _kept(self, symbols: np.ndarray, place: np.ndarray, item: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keep = self._enough(symbols, item, start)
        return place[keep], item[keep], start[keep]

    def _enough(self, symbols: np.ndarray, item: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether the words around each window that are its item's are as many as a hit needs."""
        keep = np.zeros(len(item), bool)
        sizes = self.sizes[item]
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            most = int(self.mosts[item[own[0]]])
            step = max(1, CELLS // (size + 2 * most))
            for k in range(0, len(own), step):
                part = own[k : k + step]
                at = start[part, None] + np.arange(-most, size + most)
                word = np.where((at >= 0) & (at < len(symbols)), symbols[np.clip(at, 0, len(symbols) - 1)], 0)
                good = self.bag[slots(self._own_word(word, item[part, None]), self.bag)] & (word > 0)
                keep[part] = good.sum(axis=1) >= size - most
        return keep

    def verify(self, meetings: set[tuple[int, int]], words: list[str]) -> list[tuple]:
        """(item id, distance, first word, end word) of the best stretch of each item that is near enough.

        Windows of an item that overlap are one stretch, so a text is gone through once for each item at most.
        """
        stretches: dict[int, list[list[int]]] = defaultdict(list)
        for item, start in sorted(meetings):
            size, most = len(self.items[item]), self.most(item)
            lo, hi, own = max(0, start - most), start + size + 2 * most + 1, stretches[item]
            if own and lo <= own[-1][1]:
                own[-1][1] = hi
            else:
                own.append([lo, hi])
        out = []
        for item, own in sorted(stretches.items()):
            pattern = self.items[item]
            found = [(distance, lo, lo + end) for lo, hi in own for distance, end in [least_distance(pattern, words[lo:hi])]]
            distance, lo, end = min(found)
            if distance <= self.most(item):
                back = words[max(lo, end - len(pattern) - distance) : end][::-1]
                out.append((self.ids[item], distance, end - least_distance(pattern[::-1], back)[1], end))
        return out

    def most(self, item: int) -> int:
        """The largest edit distance at which a stretch still holds the item."""
        return int((1 - self.least) * len(self.items[item]) + 1e-9)

    def search(self, texts: list[str | None]) -> list[list[tuple]]:
        """The hits of each text."""
        out: list[list[tuple]] = []
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(words_of(text))
            size += len(held[-1]) + 1
            if size > FLUSH:
                out += self._search(held)
                held, size = [], 0
        return out + self._search(held)

    def _search(self, held: list[list[str]]) -> list[list[tuple]]:
        if not held:
            return []
        get, flat, begins = self.vocabulary.get, [], []
        for words in held:
            begins.append(len(flat))
            flat += [get(w, 0) for w in words]
            flat.append(0)  # no anchor reaches into the next text
        by_text = defaultdict(set)
        starts = np.array(begins, np.int64)
        for place, item, start in self.meetings(np.array(flat, np.int64)):
            k = np.searchsorted(starts, place, "right") - 1
            found = np.unique(np.stack([k, item, start - starts[k]], axis=1), axis=0) if len(k) else np.zeros((0, 3), np.int64)
            for text, own, at in found.tolist():
                by_text[text].add((own, at))
        return [self.verify(by_text[k], words) if k in by_text else [] for k, words in enumerate(held)]


def finders(items: DataFrame, key: str = "item_id", text: str = "text", **options) -> Iterator[Finder]:
    """A Finder for each block of ``items``; blocks are dealt by a hash of the key and the text."""
    blocks = max(1, -(-items.count() // BLOCK))
    dealt = items.select(key, text, F.pmod(F.xxhash64(key, text), F.lit(blocks)).alias("block"))
    for b in range(blocks):
        rows = [(k, words_of(t)) for k, t, _ in sorted(dealt.where(F.col("block") == b).collect(), key=lambda r: (r[0] is None, str(r[0]), r[1] or ""))]
        rows = [(k, w) for k, w in rows if w]
        yield Finder([k for k, _ in rows], [w for _, w in rows], **options)


def find_leaks(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, item_id, distance, first_word, end_word): the best stretch of each text for each item near enough to it."""
    context, out = df.sparkSession.sparkContext, None
    kind, item_kind = df.schema[key].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    for finder in finders(items, **options):
        held = context.broadcast(finder)

        def leaks(parts: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for part in pieces(parts, 1):
                found = held.value.search(part.column(1).to_pylist())
                rows = [(i, *hit) for i, hits in enumerate(found) for hit in hits]
                columns = list(zip(*rows)) or [[]] * 5
                keys = part.column(0).take(pa.array(columns[0], pa.int64()))
                kinds = (item_type, pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, k) for c, k in zip(columns[1:], kinds))], [key, "item_id", "distance", "first_word", "end_word"])

        hits = df.select(key, text).mapInArrow(leaks, f"`{key}` {kind}, item_id {item_kind}, distance int, first_word int, end_word int")
        out = hits if out is None else out.unionByName(hits)
    return out


def drop_leaks(df: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``df`` without the rows whose text holds a benchmark item."""
    for finder in finders(items, **options):
        df = df.where(~_leaky(df, finder)(F.col(text)))
    return df


def _leaky(df: DataFrame, finder: Finder):
    held = df.sparkSession.sparkContext.broadcast(finder)

    @F.pandas_udf("boolean")
    def leaky(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(hits) for hits in held.value.search(texts.tolist())])

    return leaky
