"""Language identification: interpolated Kneser-Ney character models in sorted hash arrays.

Symbols: letters in lower case (those beyond the basic plane count as one letter); every run of
other characters is one space.  A symbol's context is the three before it; texts begin with
spaces and end with one.  A 4-gram's hash is its four 16-bit symbols side by side.

Training counts the 4-grams of every training text in Spark (counted within each Arrow batch
before the shuffle, on (language, hash) keys).  Continuation counts of the lower orders, counts of counts (for the discounts) and the totals of
contexts are aggregations over all of them.  The model keeps every n-gram of every language, however many there are, so
what is collected and broadcast grows with the distinct n-grams of the corpus (not with its rows).
``max_ngrams``, where it is given, bounds the n-grams of each order: a language keeps those whose count reaches a power of two, the least
that brings it within its share.  Discounts, continuation counts and totals are still those of all n-grams, and what was left out
goes to the lower order, so probabilities still add up to one.

Scoring looks a text's 4-grams up in one sorted array of the hashes of all languages, with a
column of interpolated log-probabilities for each; a 4-gram that is not there is computed from
the lower orders.  The language of least cross-entropy per symbol wins; of equal ones the first by name.

Rejection: a text is accepted if that cross-entropy, less an allowance for short texts that falls with the root of their length, is at most
the language's limit.  Limits are calibrated on all training rows, each with a model of the half of them that it isn't in (halves by the text's hash, so
copies stay together): half way between what ``QUANTILE`` of them stay below and what ``QUANTILE`` of the same texts with their letters shuffled stay above.
A language that only one half has rows of has no limit.

Null texts, empty ones and those without a letter are ``und``: score 0, not accepted.  With no
training rows at all nothing is learned: every text is ``und`` with score 0, and accepted if it
has a letter, since nothing speaks against it.  Repeated rows count as often as they stand; an empty table gives none; columns keep their
names, but for one of the name of the result, which is replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import cut, pieces

QUANTILE = 0.999
SYMBOL_SPREAD = 2.0
SHARPNESS = 20.0
UNKNOWN = "und"
SPACE = 32
FLUSH = 1 << 20
SCORED = 1 << 18
REMEMBERED = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


def symbols(text: str | None) -> np.ndarray:
    """The symbols of a text, without its first and last spaces; empty if it has no letter."""
    if not isinstance(text, str) or not text:
        return np.zeros(0, np.uint64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if (code >> 16).any():
        far = np.flatnonzero(code >> 16)
        code = code.copy()
        code[far] = [0xFFFF if chr(c).isalpha() else SPACE for c in code[far].tolist()]
    letter = _letters()[code] | (code == 0xFFFF)
    out = np.where(letter, code, SPACE)
    return _single_spaces(out.astype(np.uint64))


def _single_spaces(own: np.ndarray) -> np.ndarray:
    """Symbols as those of a text: runs of spaces are one, none first or last."""
    letter = own != SPACE
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    own = own[keep]
    own = own[1:] if len(own) and own[0] == SPACE else own
    return own[:-1] if len(own) and own[-1] == SPACE else own


def grams(own: list[np.ndarray]) -> np.ndarray:
    """The 4-gram hashes of several symbol arrays, one after the other."""
    size = sum(map(len, own)) + 4 * len(own)
    flat, at = np.full(size, SPACE, np.uint64), 0
    use = np.ones(size, bool)
    for s in own:
        use[at : at + 3] = False
        flat[at + 3 : at + 3 + len(s)] = s
        at += len(s) + 4
    key = flat.copy()
    key[1:] |= flat[:-1] << np.uint64(16)
    key[2:] |= flat[:-2] << np.uint64(32)
    key[3:] |= flat[:-3] << np.uint64(48)
    return key[use]


def count_grams(df: DataFrame, text: str = "text", lang: str = "lang", apart: F.Column | None = None) -> DataFrame:
    """(lang, gram, n, apart) over all rows with a language: n of all, ``apart`` of those for which that condition holds."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bool], list[np.ndarray]] = {}
        sizes: dict[tuple[str, bool], int] = {}

        def flush(kind: tuple[str, bool]) -> pa.RecordBatch:
            found, n = np.unique(grams(held.pop(kind)), return_counts=True)
            sizes.pop(kind)
            name, out = kind
            columns = [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(n.astype(np.int64) * out)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n", "apart"])

        for part in pieces(parts, 0):
            for t, *kind in zip(*(part.column(k).to_pylist() for k in range(3))):
                own, kind = symbols(t), tuple(kind)
                if len(own):
                    held.setdefault(kind, []).append(own)
                    sizes[kind] = sizes.get(kind, 0) + len(own)
                    if sizes[kind] > FLUSH:
                        yield flush(kind)
        for kind in list(held):
            yield flush(kind)

    labelled = df.where(F.col(lang).isNotNull()).select(text, F.col(lang).cast("string"), F.lit(False) if apart is None else apart)
    rows = labelled.mapInArrow(counted, "lang string, gram long, n long, apart long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("apart").alias("apart"))


def _find(keys: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``query`` in the sorted ``keys``, and whether they are there."""
    place = np.minimum(np.searchsorted(keys, query), max(len(keys) - 1, 0))
    return place, (keys[place] == query) if len(keys) else np.zeros(len(query), bool)


class Order(NamedTuple):
    """One order of a model: sorted hashes with their counts, the discount, and the sorted contexts with their totals and what is left to the lower order."""

    keys: np.ndarray
    n: np.ndarray
    discount: float
    context: np.ndarray
    total: np.ndarray
    left: np.ndarray


def discount_of(ones: int, twos: int) -> float:
    return float(np.clip(ones / max(ones + 2 * twos, 1), 0.1, 0.9))


@dataclass
class KneserNey:
    """One language's model.  Orders (4 to 1) that aren't given are those of the 4-grams ``gram`` with their counts."""

    gram: np.ndarray
    count: np.ndarray
    alphabet: int
    orders: list[Order] = field(default_factory=list)

    def __post_init__(self):
        keys, n = self.gram, self.count.astype(np.float64)
        for order in (4, 3, 2, 1) if not self.orders else ():
            discount = discount_of((n == 1).sum(), (n == 2).sum())
            context, start = np.unique(keys >> np.uint64(16), return_index=True)
            total = np.add.reduceat(n, start) if len(n) else n
            self.orders.append(Order(keys, n, discount, context, total, discount * np.diff([*start, len(keys)])))
            keys, n = np.unique(keys & mask(order - 1), return_counts=True)
            n = n.astype(np.float64)

    def probability(self, query: np.ndarray, level: int = 0) -> np.ndarray:
        """P(last symbol | those before it), interpolated down to a uniform floor."""
        keys, n, discount, context, total, left = self.orders[level]
        order = 4 - level
        lower = self.probability(query & mask(order - 1), level + 1) if order > 1 else np.full(len(query), 1.0 / self.alphabet)
        if not len(keys):
            return lower
        c, known = _find(context, query >> np.uint64(16))
        g, there = _find(keys, query)
        top = np.where(there, n[g] - discount, 0)
        return np.where(known, (top + left[c] * lower) / total[c], lower)


def mask(order: int) -> np.uint64:
    """The bits of the last ``order`` symbols."""
    return np.uint64((1 << (16 * order)) - 1)


@dataclass
class LanguageModel:
    """All languages; ``limits`` has each one's largest acceptable cross-entropy."""

    languages: list[str]
    models: list[KneserNey]
    limits: np.ndarray | None = None

    def __post_init__(self):
        self.keys = np.unique(np.concatenate([m.gram for m in self.models])) if self.models else np.zeros(0, np.uint64)
        self.logs = self._logs(self.keys)

    def _logs(self, query: np.ndarray) -> np.ndarray:
        return np.stack([np.log(m.probability(query)) for m in self.models], axis=1).astype(np.float32) if self.models else np.zeros((len(query), 0), np.float32)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, nats per symbol for each language) of each text."""
        sizes, out = np.zeros(len(texts), np.int64), np.full((len(texts), len(self.languages)), np.inf)
        rows: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> None:
            if rows and self.models:
                out[rows] = -self._sums(held) / (sizes[rows] + 1)[:, None]
            rows.clear()
            held.clear()

        for k, text in enumerate(texts):
            own = symbols(text)
            sizes[k] = len(own)
            if len(own):
                rows.append(k)
                held.append(own)
                size += len(own)
            if size > SCORED:
                flush()
                size = 0
        flush()
        return sizes, out

    def _sums(self, own: list[np.ndarray]) -> np.ndarray:
        query = grams(own)
        place, there = _find(self.keys, query)
        logs = self.logs[place]
        if not there.all():
            logs[~there] = self._logs(query[~there])
        starts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in own])[:-1]])
        return np.add.reduceat(logs.astype(np.float64), starts, axis=0)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score and accepted of each text."""
        sizes, cross = self.entropies(texts)
        some = sizes > 0
        if not self.models:
            return pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "accepted": some})
        best = cross.argmin(axis=1)
        least = np.where(some, cross[np.arange(len(best)), best], 0.0)
        with np.errstate(invalid="ignore"):
            away = np.where(some[:, None], cross - least[:, None], 0.0)
        share = 1 / np.exp(-SHARPNESS * away).sum(axis=1)
        over = least - self.limits[best] - SYMBOL_SPREAD / np.sqrt(np.maximum(sizes, 1))
        fit = 1 / (1 + np.exp(np.clip(over / 0.1, -50, 50)))
        names = np.array(self.languages, dtype=object)[best]
        return pd.DataFrame({"lang_pred": np.where(some, names, UNKNOWN), "score": np.where(some, share * fit, 0.0), "accepted": some & (over <= 0)})


def _orders(counts: DataFrame) -> DataFrame:
    """(lang, order, gram, n) of all orders, from 4-grams (lang, gram, n): the lower ones count what stands before them."""
    part = counts.where("n > 0").select("lang", F.lit(4).alias("order"), "gram", "n")
    out = part
    for order in (3, 2, 1):
        below = F.col("gram").bitwiseAND(F.lit(int(mask(order))).cast("long"))
        part = part.groupBy("lang", below.alias("gram")).agg(F.count("*").alias("n")).select("lang", F.lit(order).alias("order"), "gram", "n")
        out = out.unionByName(part)
    return cut(out)


def _least_counts(sizes: list, share: int | None) -> dict[tuple[str, int], int]:
    """Of each (language, order), the least count that is kept: a power of two; ``sizes`` are rows of lang, order, two (the power below a count) and grams."""
    out: dict[tuple[str, int], int] = {}
    held: dict[tuple[str, int], int] = {}
    for r in sorted(sizes, key=lambda r: -r.two):
        kind = r.lang, r.order
        held[kind] = held.get(kind, 0) + r.grams
        if share is None or held[kind] <= share:
            out[kind] = 1 << r.two
        else:
            out.setdefault(kind, 2 << r.two)
            held[kind] = share + 1
    return out


def build(counts: DataFrame, max_ngrams: int | None = None) -> LanguageModel:
    """The models of all languages, from 4-grams (lang, gram, n)."""
    every, spark = _orders(counts), counts.sparkSession
    two = F.floor(F.log2("n")).cast("int")
    sizes = every.groupBy("lang", "order", two.alias("two")).agg(F.count("*").alias("grams"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()
    names = sorted({r.lang for r in sizes})
    if not names:
        return LanguageModel([], [], np.zeros(0))
    ones, twos = ({(r.lang, r.order): 0 for r in sizes} for _ in range(2))
    for r in sizes:
        ones[r.lang, r.order] += r.ones
        twos[r.lang, r.order] += r.twos
    discounts = {kind: discount_of(ones[kind], twos[kind]) for kind in ones}
    least = _least_counts(sizes, None if max_ngrams is None else max_ngrams // len(names))
    settings = spark.createDataFrame([(names.index(k[0]), *k, discounts[k], least[k]) for k in discounts], "k int, lang string, order int, discount double, least long")
    joined = cut(every.join(F.broadcast(settings), ["lang", "order"]))
    kept = joined.where("n >= least").select("k", "order", "gram", "n").toArrow()
    context = F.shiftrightunsigned("gram", 16)
    given = F.sum(F.when(F.col("n") >= F.col("least"), F.col("n") - F.col("discount")))
    contexts = joined.groupBy("k", "order", context.alias("context")).agg(F.sum("n").alias("total"), given.alias("given")).where("given is not null").toArrow()
    grams_, contexts_ = _by_order(kept, "gram", ["n"]), _by_order(contexts, "context", ["total", "given"])
    alphabet = len(np.unique(np.concatenate([grams_[k, 1][0] for k in range(len(names))]))) + 1
    models, none = [], (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    for k, name in enumerate(names):
        orders = []
        for order in (4, 3, 2, 1):
            (keys, n), (own, total, given) = grams_.get((k, order), none[:2]), contexts_.get((k, order), none)
            orders.append(Order(keys, n, discounts[name, order], own, total, total - given))
        models.append(KneserNey(orders[0].keys, orders[0].n, alphabet, orders))
    return LanguageModel(names, models)


def _by_order(table: pa.Table, key: str, values: list[str]) -> dict[tuple[int, int], tuple[np.ndarray, ...]]:
    """The sorted keys and their values of each (language, order)."""
    which = table["k"].to_numpy().astype(np.int64) * 8 + table["order"].to_numpy()
    keys = table[key].to_numpy().view(np.uint64)
    place = np.lexsort((keys, which))
    kinds, starts = np.unique(which[place], return_index=True)
    columns = [keys[place], *(table[v].to_numpy().astype(np.float64)[place] for v in values)]
    return {(int(w) // 8, int(w) % 8): tuple(c[a:b] for c in columns) for w, a, b in zip(kinds, starts, [*starts[1:], len(which)])}


def train(df: DataFrame, text: str = "text", lang: str = "lang", max_ngrams: int | None = None) -> LanguageModel:
    """A model of all rows of ``df`` with a language."""
    second = F.pmod(F.xxhash64(text), 2) == 1
    counts = cut(count_grams(df, text, lang, second))
    model = build(counts.select("lang", "gram", "n"), max_ngrams)
    if model.models:
        halves = [build(counts.select("lang", "gram", n.alias("n")), max_ngrams) for n in (F.col("apart"), F.col("n") - F.col("apart"))]
        model.limits = _limits(df.where(F.col(lang).isNotNull()).select(text, F.col(lang).cast("string"), second.cast("int")), halves, model.languages)
    return model


class Remembered:
    """Log-probabilities of one language's model; those of 4-grams it lacks are kept once they were asked for, up to REMEMBERED of them."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.own = self.keys, self.logs = model.gram, self._logs(model.gram)

    def _logs(self, query: np.ndarray) -> np.ndarray:
        return np.log(self.model.probability(query)).astype(np.float32)

    def __call__(self, query: np.ndarray) -> np.ndarray:
        place, there = _find(self.keys, query)
        out = self.logs[place] if len(self.keys) else np.zeros(len(query), np.float32)
        if not there.all():
            missing = query[~there]
            new = np.unique(missing)
            logs = self._logs(new)
            out[~there] = logs[np.searchsorted(new, missing)]
            if len(self.keys) + len(new) > len(self.model.gram) + REMEMBERED:
                self.keys, self.logs = self.own
            keys, at = np.unique(np.concatenate([self.keys, new]), return_index=True)
            self.keys, self.logs = keys, np.concatenate([self.logs, logs])[at]
        return out


def shuffled_symbols(own: np.ndarray) -> np.ndarray:
    """Letters and spaces in another, fixed order."""
    return np.random.default_rng(len(own)).permutation(own)


def shuffled(text: str | None) -> str | None:
    """The text with its letters and spaces in another, fixed order."""
    own = symbols(text)
    return "".join(map(chr, shuffled_symbols(own).tolist())) if len(own) else text


def _surplus(own: list[np.ndarray], logs: Remembered) -> np.ndarray:
    """Each symbol array's nats per symbol, less the allowance for short texts."""
    sizes = np.array([len(s) for s in own])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    return -np.add.reduceat(logs(grams(own)).astype(np.float64), starts) / (sizes + 1) - SYMBOL_SPREAD / np.sqrt(sizes)


def _limits(rows: DataFrame, halves: list[LanguageModel], languages: list[str]) -> np.ndarray:
    """The limits of ``languages``, from all rows (text, language, half); ``halves`` has the model to judge each half by.  Infinite where there are none."""
    held = rows.sparkSession.sparkContext.broadcast([dict(zip(m.languages, m.models)) for m in halves])

    def measured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {(half, name): Remembered(model) for half, models in enumerate(held.value) for name, model in models.items()}
        waiting: dict[tuple[int, str], list[np.ndarray]] = {}
        sizes: dict[tuple[int, str], int] = {}

        def flush(kind: tuple[int, str]) -> pa.RecordBatch:
            own = waiting.pop(kind)
            sizes.pop(kind)
            both = [_surplus(own, known[kind]), _surplus([_single_spaces(shuffled_symbols(s)) for s in own], known[kind])]
            return pa.RecordBatch.from_arrays([pa.array([kind[1]] * len(own), pa.string()), *map(pa.array, both)], ["lang", "own", "other"])

        for part in pieces(parts, 0):
            for t, name, half in zip(*(part.column(k).to_pylist() for k in range(3))):
                own, kind = symbols(t), (half, name)
                if len(own) and kind in known:
                    waiting.setdefault(kind, []).append(own)
                    sizes[kind] = sizes.get(kind, 0) + len(own)
                    if sizes[kind] > SCORED:
                        yield flush(kind)
        for kind in list(waiting):
            yield flush(kind)

    found = rows.mapInArrow(measured, "lang string, own double, other double")
    each = found.groupBy("lang").agg(F.percentile_approx("own", QUANTILE, 10_000).alias("own"), F.percentile_approx("other", 1 - QUANTILE, 10_000).alias("other"))
    limits = {r.lang: max(r.own, (r.own + r.other) / 2) for r in each.collect()}
    held.unpersist()
    return np.array([limits.get(name, np.inf) for name in languages])


def identify(df: DataFrame, model: LanguageModel, text: str = "text", into: str = "language") -> DataFrame:
    """``df`` with a struct column (lang_pred, score, accepted)."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return held.value.predict(texts.tolist())

    return df.withColumn(into, predicted(F.col(text)))


def held_out(key: str = "doc_id") -> F.Column:
    """Rows kept out of training: crc32 of the key as text is 2 modulo 4; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def train_on(df: DataFrame) -> LanguageModel:
    """A model of the rows of documents that aren't held out."""
    return train(df.where(~held_out()).select("text", "lang"))


def language_report(df: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted, from a model of the rows that aren't held out."""
    found = identify(df.select("doc_id", "text"), train_on(df))
    return found.select("doc_id", held_out().alias("held_out"), "language.*")


def keep_identified(df: DataFrame) -> DataFrame:
    """``df`` without the rows that language identification rejects."""
    return identify(df, train_on(df), into="__language").where("__language.accepted").drop("__language")
