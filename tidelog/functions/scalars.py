"""Timestamps, namespaces and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pack_ts(seconds: Column, increment: Column) -> Column:
    """64-bit timestamp: seconds in the upper half, increment in the lower."""
    return F.shiftleft(seconds.cast("long"), 32) + increment.cast("long")


def ts_seconds(ts: Column) -> Column:
    return F.shiftrightunsigned(ts, 32)


def ts_increment(ts: Column) -> Column:
    return ts.bitwiseAND(F.lit(0xFFFFFFFF))


def ns_db(ns: Column) -> Column:
    """Before the first dot; a namespace without one is its own database."""
    return F.substring_index(ns, ".", 1)


def ns_coll(ns: Column) -> Column:
    """After the first dot (collections may hold more dots); null without one."""
    dot = F.instr(ns, ".")
    return F.when(dot > 0, F.substr(ns, dot + 1))


def json_path(path: str) -> str:
    """A dotted path as a variant path with quoted names."""
    return "$" + "".join(f'["{name}"]' for name in path.split("."))


def find_field(doc: Column, path: str, kind: str = "variant") -> Column:
    """The value at a dotted path, null where it is absent or of another kind.

    A JSON null is not null here: ``is_variant_null`` tells the two apart.  Arrays aren't entered.
    """
    return F.try_variant_get(doc, json_path(path), kind)


def key_matches(key: Column, fields: list[str]) -> Column:
    """Whether an update key is one of ``fields`` or lies below one."""
    out = F.lit(False)
    for f in fields:
        out = out | (key == f) | key.startswith(f + ".")
    return out
