"""The method verdict of the URL filter against a plain Python version."""

import math
import re
from collections import Counter

import regex
from pyspark.sql import functions as F

from tests.llm.test_tables import brute_rule
from tidelog.llm import url_filter


def words_of(html):
    html = re.sub(r"(?is)<(script|style)\b.*?(?:</\1>|\Z)", " ", html or "")
    return [w for w in regex.split(r"[^\p{L}]+", re.sub(r"<[^>]*(?:>|\Z)", " ", html).lower()) if url_filter.LEAST_WORD <= len(w) <= url_filter.MAX_WORD]


def brute_scores(rows):
    """Log odds of every page, by counts of word and path tokens."""
    counts = Counter(w for _, html in rows for w in words_of(html))
    total = float(sum(counts.values()) or 1)

    def tokens(url):
        host, path, _, verdict = brute_rule(url)
        own = []
        for run in regex.findall(r"\p{L}+|\p{N}+", host):
            if run[0].isnumeric():
                own.append(("host", "0"))
            elif len(run) > url_filter.MAX_LABEL:
                own.append(("host", run))
            else:
                known = {(s, n): math.log(counts[run[s : s + n]] / total) for s in range(len(run)) for n in range(1, min(len(run) - s, url_filter.MAX_WORD) + 1) if counts[run[s : s + n]]}
                own += [("host", w) for w in url_filter.viterbi(run, known, total)]
        own += [("path", "0" if re.fullmatch("[0-9]+", t) else t) for t in re.split("[^a-z0-9]+", path.lower()) if t]
        return own, verdict

    pages = [tokens(url) for url, _ in rows]
    by = {v: Counter(t for own, verdict in pages if verdict == v for t in own) for v in ("block", "allow")}
    n = {v: sum(verdict == v for _, verdict in pages) for v in by}
    if not (n["block"] and n["allow"]):
        return [0.0] * len(rows)
    size = {v: sum(c.values()) + url_filter.SMOOTHING * url_filter.FEATURES for v, c in by.items()}
    ratio = lambda t: math.log((by["block"][t] + 1) / size["block"]) - math.log((by["allow"][t] + 1) / size["allow"])
    return [sum(map(ratio, own)) + math.log(n["block"] / n["allow"]) for own, _ in pages]


def test_scores(spark, pages):
    """Tokens share a feature by chance only (65,536 of them); all but a few scores are equal, and verdicts follow from them."""
    few = pages.orderBy("page_id").limit(150).select("page_id", "url", "html")
    more = [(9000, "http://casino777-online.example.io/fr/1", "<p>casino online <script>x<y"), (9001, "http://cheap2pills.example.net/it/", "<b>cheap pills"), (9002, None, None)]
    df = few.unionByName(spark.createDataFrame(more, few.schema))
    rows = sorted(df.collect(), key=lambda r: r.page_id)
    found = {r.page_id: r for r in url_filter.judge_urls(df).collect()}
    want = dict(zip([r.page_id for r in rows], brute_scores([(r.url, r.html) for r in rows])))
    same = [abs(found[k].block_score - s) < 1e-6 for k, s in want.items()]
    assert sum(same) >= 0.97 * len(same)
    assert all(r.rule or (r.verdict == "block") == (r.block_score > 0) for r in found.values())


def test_labels_with_digits(spark):
    counts = spark.createDataFrame([("cheap", 50), ("pills", 40), ("casino", 9), ("online", 9)], "word string, n long")
    hosts = spark.createDataFrame([("cheappills24.com",), ("24-cheap.pills7.com",)], "host string")
    word = lambda w: url_filter.bucket("host", F.lit(w))
    want = spark.range(1).select(F.array_sort(F.array(*map(word, ("cheap", "pills", "0", "com")))), F.array_sort(F.array(*map(word, ("0", "cheap", "pills", "0", "com"))))).first()
    found = {r.host: sorted(r.features) for r in url_filter.host_features(hosts, counts).collect()}
    assert [found["cheappills24.com"], found["24-cheap.pills7.com"]] == [sorted(w) for w in want]


def test_unclosed_tags_take_no_time(spark):
    pages = spark.createDataFrame([("<" * 300_000,), ("<script" * 100_000,)], "html string")
    assert url_filter.word_counts(pages).count() == 0
