"""Secret scan: keyword automaton, anchored expressions at its hits, checksum validation.

One pass of an Aho-Corasick automaton over the ASCII-lower-cased text yields every place where
a secret can begin; only there is the kind's expression tried, anchored at that place, on the
original text.  A run of hexadecimal digits has no keyword of its own, so all strings of
``HEX_SEED`` hexadecimal digits are its keywords: a run of 24 or more begins with one.
Kinds whose tokens embed a checksum are kept only if the checksum is right.

Kinds, in the order used for spans that begin together:

* ``assign``, ``access``, ``hex``: leftmost matches that don't overlap within their kind;
  matches whose value is too short are dropped after they have taken up their characters;
* ``github``, ``npm``: 30 random characters and 6 base-62 digits of their CRC-32.

Null text counts as empty and has no span; offsets are code points, the end is exclusive.
The scan is a projection: no shuffle, and a row is never split or cut.  Repeated rows give equal rows, an empty table none; of other
columns none is read, and one of the result's name is replaced.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HEX_SEED = 4
# The expressions and least lengths of the three base kinds.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# Prefixes of tokens with an embedded CRC-32, and the base-62 digits.
CHECKED = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
CHECKED_TOKEN = re.compile(r"[a-z]+_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
SPANS = "array<struct<kind:string,start:int,end:int>>"


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as 6 base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


@functools.cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in KEYWORDS:
        found.add_word(word, ("assign", len(word)))
    found.add_word("akia", ("access", 4))
    for prefix, kind in CHECKED.items():
        found.add_word(prefix, (kind, len(prefix)))
    for digits in itertools.product("0123456789abcdef", repeat=HEX_SEED):
        found.add_word("".join(digits), ("hex", HEX_SEED))
    found.make_automaton()
    return found


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of one text, by start, then by kind."""
    if not isinstance(text, str):
        return []
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    taken = dict.fromkeys(KINDS, 0)
    spans = []
    for last, (kind, length) in _automaton().iter(lowered):
        start = last - length + 1
        if start < taken[kind]:
            continue
        if kind == "hex":
            match = HEX.match(text, start)
            size = match.end() - start if match else 0
        elif kind == "assign":
            match = ASSIGN.match(text, start)
            size = len(match[2]) if match else 0
        elif kind == "access":
            match = ACCESS.match(text, start)
            size = match.end() - start if match else 0
        else:
            match = CHECKED_TOKEN.match(text, start)
            if match and checksum62(match[1]) != match[2]:
                match = None
            size = 0
        if match:
            taken[kind] = match.end()
            if size >= LEAST.get(kind, 0):
                spans.append((kind, start, match.end()))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def scan_secrets(df: DataFrame, text: str = "text", into: str = "secret_spans") -> DataFrame:
    """``df`` with a column of its secret spans."""

    @F.pandas_udf(SPANS)
    def spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t)] for t in texts])

    return df.withColumn(into, spans(F.col(text)))


def redact(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every secret span of its text replaced by ``mark``; of spans that overlap, the first's place is marked and all of them go.
    Null text stays null, an empty one empty; all other columns stay as they are."""

    @F.pandas_udf("string")
    def hidden(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else _redacted(t, mark))

    return df.withColumn(text, hidden(F.col(text)))


def _redacted(text: str, mark: str) -> str:
    out, at = [], 0
    for _, start, end in find_spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def listed(spans) -> F.Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def counted(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")


def secret_digest(df: DataFrame) -> DataFrame:
    """doc_id and the digest columns of its spans."""
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s.kind.isin(*BASE_KINDS))
    counts = [counted(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return scan_secrets(df.select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )
