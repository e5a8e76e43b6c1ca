"""URL filter: rules first, then naive Bayes over segmented host words and path tokens.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
``?``, ``#`` or the end.  Both are empty for a null url and for one without ``://``.  A rule has a
host and a path prefix, fits its host and all subdomains, and the longest rule that fits decides.

Where none does, the method decides.  Host labels are cut into runs of letters and runs of digits (one token for all); other characters
only separate.  Runs of letters are split into words by Viterbi over
a unigram model: the counts of all words of all pages' visible text.  A stretch of length L that is
no word costs as much as a word of probability 10 / (N 10**L).  The candidate stretches of each
distinct label are joined to the word counts, so the vocabulary is never gathered.  A multinomial
naive Bayes model over hashed tokens (host words; path parts, with numbers alike) is trained on
the pages that rules judge.  Its size is fixed: ``FEATURES`` log-ratios.  A page is blocked if its log
odds are above zero; with no rule-judged page of either kind there is no evidence, and all are allowed.

Runs of letters longer than ``MAX_LABEL`` (the limit of DNS) stay whole; words are at most ``MAX_WORD`` long.  Counts are gathered per distinct host first, so
a host of very many pages is one row.  Repeated urls are judged alike; an empty table gives no row; null html has no words.  At most
``MAX_RULES`` rules are taken, more are refused.  Columns of the names of the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ascii_lower, cut

MAX_LABEL, MAX_WORD, LEAST_WORD = 63, 24, 2
FEATURES = 1 << 16
MAX_RULES = 1000
SMOOTHING = 1.0


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judged(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """struct(text, verdict) of the longest rule that fits, else null; of rules of one length, the first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules are tried one after the other")
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = (F.concat(F.lit("."), host).endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n): words of the visible text of all pages; a script or a tag that isn't closed hides the rest of its page."""
    whole = F.coalesce(F.col(html), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(whole, r"(?is)<(script|style)\b.*?(?:</\1>|\z)", " "), r"<[^>]*(?:>|\z)", " ")
    words = pages.select(F.explode(F.split(F.lower(bare), r"[^\p{L}]+")).alias("word"))
    return words.where(F.length("word").between(LEAST_WORD, MAX_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def viterbi(label: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The likeliest split of ``label``; ``known`` has log-probabilities by (start, length)."""
    best, back = [0.0] + [-math.inf] * len(label), [0] * (len(label) + 1)
    for end in range(1, len(label) + 1):
        for start in range(max(0, end - MAX_WORD), end):
            size = end - start
            own = known.get((start, size), math.log(10.0 / total) - size * math.log(10.0))
            if best[start] + own > best[end]:
                best[end], back[end] = best[start] + own, start
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def segment_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of distinct ``labels`` (label); only short labels of letters are split within."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    n, size = F.length("label"), F.col("size")
    spots = labels.withColumn("size", F.explode(F.sequence(F.lit(1), F.least(n, F.lit(MAX_WORD)))))
    spots = spots.withColumn("start", F.explode(F.sequence(F.lit(0), n - size))).withColumn("word", F.expr("substr(label, start + 1, size)"))
    found = spots.join(counts, "word", "left").where("n is not null")
    known = found.groupBy("label").agg(F.collect_list(F.struct("start", "size", F.log(F.col("n") / total).alias("p"))).alias("known"))

    @F.pandas_udf("array<string>")
    def split(names: pd.Series, lists: pd.Series) -> pd.Series:
        empty: list = []
        return pd.Series([viterbi(name, {(k["start"], k["size"]): k["p"] for k in (empty if known is None else known)}, total) for name, known in zip(names, lists)])

    return labels.join(known, "label", "left").select("label", split("label", "known").alias("words"))


def bucket(kind: str, token: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(kind), token), F.lit(FEATURES)).cast("int")


def path_features(path: Column) -> Column:
    """The hashed tokens of a path; all numbers are one token."""
    parts = F.filter(F.split(F.lower(path), "[^a-z0-9]+"), lambda t: t != "")
    return F.transform(F.transform(parts, lambda t: F.regexp_replace(t, "^[0-9]+$", "0")), lambda t: bucket("path", t))


def host_features(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, features): hashed words of each distinct host's labels."""
    runs = F.regexp_extract_all("host", F.lit(r"\p{L}+|\p{N}+"), 0)
    labels = hosts.select("host", F.explode(F.transform(runs, lambda r: F.regexp_replace(r, r"^\p{N}+$", "0"))).alias("label"))
    plain = F.col("label").rlike(r"^\p{L}+$") & (F.length("label") <= MAX_LABEL)
    split = segment_labels(labels.where(plain).select("label").distinct(), counts)
    worded = labels.join(split, "label", "left").select("host", F.explode(F.coalesce("words", F.array("label"))).alias("word"))
    return worded.groupBy("host").agg(F.collect_list(bucket("host", F.col("word"))).alias("features"))


def log_ratios(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Each feature's log(P(f | block) / P(f | allow)), and that of the classes; zeros if a class is missing.

    ``rows``: features, blocked and allowed (numbers of pages); counts are summed before the shuffle.
    """
    pages = rows.agg(F.sum("blocked"), F.sum("allowed")).first()
    if not (pages[0] and pages[1]):
        return np.zeros(FEATURES), 0.0
    each = rows.select(F.explode("features").alias("f"), "blocked", "allowed").groupBy("f").agg(F.sum("blocked"), F.sum("allowed"))
    counts = np.zeros((2, FEATURES))
    for f, blocked, allowed in each.collect():
        counts[:, f] = blocked, allowed
    smooth = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTHING * FEATURES)
    return smooth[0] - smooth[1], math.log(pages[0] / pages[1])


def add_ratios(features: list[pd.Series], ratios: np.ndarray) -> pd.Series:
    out = np.zeros(len(features[0]))
    for part in features:
        for i, own in enumerate(part):
            if own is not None and len(own):
                out[i] += ratios[np.asarray(own, np.int64)].sum()
    return pd.Series(out)


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score (log odds), in place of columns so named."""
    pages = pages.drop("host", "path", "rule", "verdict", "block_score")
    context = pages.sparkSession.sparkContext
    rule = judged(host_of(F.col(url)), path_of(F.col(url)), rules)
    parsed = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "__rule": rule})
    slim = cut(parsed.groupBy("host", "path", F.col("__rule.verdict").alias("verdict")).agg(F.count("*").alias("n")))
    blocked, allowed = (F.when(F.col("verdict") == v, F.col("n")).otherwise(0) for v in ("block", "allow"))
    hosts = slim.groupBy("host").agg(F.sum(blocked).alias("blocked"), F.sum(allowed).alias("allowed"))
    hosts = cut(hosts.join(host_features(hosts.select("host"), cut(word_counts(pages, html))), "host", "left"))
    host_rows = hosts.where("blocked + allowed > 0").select("features", "blocked", "allowed")
    path_rows = slim.where("verdict is not null").select(path_features(F.col("path")).alias("features"), blocked.alias("blocked"), allowed.alias("allowed"))
    joined = host_rows.withColumn("classes", F.lit(1)).unionByName(path_rows.withColumn("classes", F.lit(0)))
    ratios, prior = log_ratios(joined.drop("classes"))
    held = context.broadcast(ratios)

    @F.pandas_udf("double")
    def score(features: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in features:
            yield add_ratios([part], held.value)

    scored = hosts.select("host", score("features").alias("__host_score"))
    out = parsed.join(scored, "host", "left").withColumn("block_score", F.col("__host_score") + score(path_features(F.col("path"))) + F.lit(prior))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("block_score") > 0, "block").otherwise("allow"))
    return out.withColumns({"rule": F.col("__rule.text"), "verdict": verdict}).drop("__rule", "__host_score")


def url_report(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    return judge_urls(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict", "block_score")
