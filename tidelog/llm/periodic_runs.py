"""Periodic runs of words, by a dictionary of basic factors.

A basic factor is a stretch of 2^k words; equal ones have the same name.  Names of level k + 1 come from pairs of names of level k, and
only places whose name is shared are looked at again, so ordinary prose ends after a few levels.  At each level every place looks for its
name's next place (its successor) within twice the factor's length.  Places in a row whose successors lie p further on form an arithmetic
progression and propose the period p:

* p at most the factor's length: the stretch of such places is that of the run itself.  Inside a run whose smallest period is p, a factor of p
  or more words can't come again sooner than p, so no place in it is missing; the place before and the one behind don't match.
  The run extends from the first place to the last one's factor and period.
* p beyond the factor's length: sooner successors may interrupt the stretch, so it waits for the next level, whose factors are longer.

A run of three periods or more is proposed at the level whose factors have p to 2p - 1 words.  Levels overlap: a period found at one comes again at
later ones, so runs are deduplicated by start and period.  Work is n log n for n words, memory a few arrays of n numbers.

Words are what lies between ASCII white space.  Several documents are worked on in one go, each ended by a word of its own, which no factor
shares.  Null and empty texts, and those of white space alone, have no word and no run.  Rows are judged one by one (a projection, no
shuffle): repeated rows give equal rows, an empty table none; a null key is a key like any other.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import pieces

#: A run has this many words at least, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _shared(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the stable order of ``keys``, and where in it a key differs from the one before."""
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    return order, np.append(True, held[1:] != held[:-1])[: len(keys)]


def runs_of(words: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """(start, length, period) of all maximal runs of a sequence of numbers, by start and period; ``least_periods`` is 3 or more."""
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods aren't found by this method")
    n, size, found = len(words), 1, []
    at, keys = np.arange(n), np.asarray(words, dtype=np.int64)
    while len(at):
        order, new = _shared(keys)
        last = np.append(new[1:], True)
        shared = ~(new & last)
        # only names that come twice stay; names count up in the order of their keys
        order, new = order[shared], new[shared]
        if not len(order):
            break
        places, name = at[order], np.cumsum(new) - 1
        step = np.append(places[1:] - places[:-1], 0)
        step[np.append(new[1:], True)] = 0  # the last place of a name has no successor
        near = (step > 0) & (step <= size)  # those up to twice the size wait for the next level
        begun, periods = places[near], step[near]
        if len(begun):
            by_place = np.argsort(begun, kind="stable")
            begun, periods = begun[by_place], periods[by_place]
            first = np.append(True, (begun[1:] != begun[:-1] + 1) | (periods[1:] != periods[:-1]))
            starts, ends = begun[first], begun[np.append(first[1:], True)]
            period = periods[first]
            length = ends - starts + size + period
            kept = (length >= least_periods * period) & (length >= least_words)
            found.append(np.stack([starts, length, period], axis=1)[kept])
        # the next level: pairs of names size places apart
        by_place = np.argsort(places, kind="stable")
        places, name = places[by_place], name[by_place]
        there = np.searchsorted(places, places + size)
        there[there == len(places)] = 0
        paired = places[there] == places + size
        keys = name[paired] * (len(places) + 1) + name[there[paired]]
        at = places[paired]
        size *= 2
    every = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
    return np.unique(every[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def greatest(runs: list[Run]) -> Run | None:
    """The run of most periods, exactly; ties go to the smaller start, then period."""
    best = None
    for run in runs:
        if best is None or run.length * best.period > best.length * run.period:
            best = run  # runs come by start and period, so a tie stays with the earlier
    return best


def collapsed(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay: those that no run contains after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space (bytes are split at exactly these six characters)."""
    return (text or "").encode().split()


def find_all(texts: list[list[bytes]], **bounds: int) -> list[list[Run]]:
    """The runs of each of several sequences of words."""
    numbers: dict[bytes, int] = {}
    number = lambda word: numbers.setdefault(word, len(numbers))
    codes, at = [], [0]
    for k, words in enumerate(texts):
        codes += [*map(number, words), -1 - k]
        at.append(len(codes))
    out: list[list[Run]] = [[] for _ in texts]
    for start, length, period in runs_of(np.array(codes, dtype=np.int64), **bounds).tolist():
        k = int(np.searchsorted(at, start, side="right")) - 1
        out[k].append(Run(start - at[k], length, period))
    return out


def made_periodic(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words of op13's contract: those of a tenth of the keys repeat a stretch of theirs from some word on."""
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n or key is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def run_report(df: DataFrame, key: str = "doc_id", text: str = "text", prepare=made_periodic) -> DataFrame:
    """A row for each document: its key, how many runs it has, the greatest one, and digests of all runs and of the text without repetitions.

    ``prepare(key, words)`` may change the words first.
    """
    kind = df.schema[key].dataType.simpleString()
    names = ["key", *(f.split()[0] for f in FIELDS.split(", "))]

    def report(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts, 1):
            keys = part.column(0).to_pylist()
            texts = [prepare(k, words_of(t)) for k, t in zip(keys, part.column(1).to_pylist())]
            rows = []
            for words, runs in zip(texts, find_all(texts)):
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
                best = greatest(runs)
                stay = words if best is None else [w for w, kept in zip(words, collapsed(len(words), runs).tolist()) if kept]
                shown = (None,) * 4 if best is None else (*best, 1000 * best.length // best.period)
                rows.append((len(runs), *shown, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(stay)).hexdigest()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names)

    return df.select(key, text).mapInArrow(report, f"key {kind}, {FIELDS}").withColumnRenamed("key", key)


def collapse(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its texts reduced to what ``collapsed`` leaves, words joined by one space; null stays null, and other columns stay as they are."""
    @F.pandas_udf("string")
    def reduced(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            split = [words_of(t) for t in texts]
            made = []
            for t, words, runs in zip(texts, split, find_all(split)):
                kept = collapsed(len(words), runs).tolist()
                made.append(None if t is None else b" ".join(w for w, k in zip(words, kept) if k).decode())
            yield pd.Series(made, dtype=object)

    return df.withColumn(text, reduced(F.col(text)))
