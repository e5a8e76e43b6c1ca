"""Field projection on whole documents (VARIANT) and on update specs (maps of dotted path to VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import find_field, key_matches

MAP = "map<string,variant>"


def _tree(fields: list[str]) -> dict[str, list[str]]:
    """First name of each path to what follows; an empty list means all of it."""
    tree: dict[str, list[str]] = {}
    for f in sorted(fields):
        name, _, rest = f.partition(".")
        if tree.get(name) != [] or name not in tree:
            tree[name] = [*tree.get(name, []), rest] if rest else []
    return tree


def _variant_map(keys: list[str], values: list[Column]) -> Column:
    whole = F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*values))
    return F.map_filter(whole, lambda _, v: v.isNotNull())


def _included(doc: Column, fields: list[str]) -> Column:
    """A map of what ``fields`` reach, null if that is nothing."""
    values = []
    for name, rest in (tree := _tree(fields)).items():
        own = find_field(doc, name)
        if rest:
            below = _included(own, rest)
            own = F.when(below.isNotNull(), F.to_variant_object(below))
        values.append(own)
    out = _variant_map(list(tree), values)
    return F.when(F.size(out) > 0, out)


def include_fields(doc: Column, fields: list[str]) -> Column:
    """The document with only ``fields``: an absent path adds nothing, not even its parents; arrays aren't entered."""
    found = _included(doc, fields)
    return F.when(doc.isNotNull(), F.to_variant_object(F.coalesce(found, F.create_map().cast(MAP))))


def exclude_fields(doc: Column, fields: list[str]) -> Column:
    """The document without ``fields``; an emptied parent stays as an empty object."""
    tree = _tree(fields)
    whole = [name for name, rest in tree.items() if not rest]
    own = F.map_filter(F.try_variant_get(doc, "$", MAP), lambda k, _: ~k.isin(*whole) if whole else F.lit(True))

    def below(k: Column, v: Column) -> Column:
        for name, rest in tree.items():
            if rest:
                v = F.when(k == name, exclude_fields(v, rest)).otherwise(v)
        return v

    return F.coalesce(F.to_variant_object(F.transform_values(own, below)), doc)


def _ancestors(fields: list[str]) -> dict[str, list[str]]:
    """Each proper dotted prefix of a field to the rests below it."""
    out: dict[str, list[str]] = {}
    for f in fields:
        names = f.split(".")
        for i in range(1, len(names)):
            out.setdefault(".".join(names[:i]), []).append(".".join(names[i:]))
    return out


def include_update(sets: Column, fields: list[str]) -> Column:
    """Of a ``$set``: keys that are a field or below one, and of keys above one, what the field reaches; null if nothing is left."""

    def value(k: Column, v: Column) -> Column:
        out = F.when(key_matches(k, fields), v)
        for above, rests in _ancestors(fields).items():
            found = _included(v, rests)
            out = F.coalesce(out, F.when((k == above) & found.isNotNull(), F.to_variant_object(found)))
        return out

    out = F.map_filter(F.transform_values(sets, value), lambda _, v: v.isNotNull())
    return F.when(F.size(out) > 0, out)


def exclude_update(sets: Column, fields: list[str]) -> Column:
    """Of a ``$set``: all but the keys that are a field or below one; null if nothing is left."""

    def value(k: Column, v: Column) -> Column:
        for above, rests in _ancestors(fields).items():
            v = F.when(k == above, exclude_fields(v, rests)).otherwise(v)
        return v

    out = F.transform_values(F.map_filter(sets, lambda k, _: ~key_matches(k, fields)), value)
    return F.when(F.size(out) > 0, out)


def include_unset(unsets: Column, fields: list[str]) -> Column:
    out = F.filter(unsets, lambda k: key_matches(k, fields))
    return F.when(F.size(out) > 0, out)


def exclude_unset(unsets: Column, fields: list[str]) -> Column:
    out = F.filter(unsets, lambda k: ~key_matches(k, fields))
    return F.when(F.size(out) > 0, out)


def strip_version(sets: Column) -> Column:
    """An update without its ``$v`` marker."""
    return F.map_filter(sets, lambda k, _: k != "$v")


def ruled_doc(doc: Column, rule: Column, rules) -> Column:
    """``doc`` reduced to the fields of the rule whose number ``rule`` is."""
    out = doc
    for k, own in enumerate(rules.included):
        include, exclude = rules.fields(own)
        if include or exclude:
            kept = include_fields(doc, include) if include else doc
            out = F.when(rule == k, exclude_fields(kept, exclude) if exclude else kept).otherwise(out)
    return out


FieldSets = list[tuple[Column, list[str], list[str]]]


def project_log(log: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """A log with its documents and updates reduced to fields; updates that become empty are dropped."""
    return project_each(log, [(F.lit(True), include or [], exclude or [])])


def project_each(log: DataFrame, sets: FieldSets) -> DataFrame:
    """A log whose entries are reduced to the fields of the first of ``sets`` (condition, included, excluded) that they meet: one
    projection, so the log is read once however many sets there are.  Updates that become empty are dropped."""
    own = {"o": F.col("o"), "set": F.when(F.col("op") != "c", strip_version(F.col("set"))), "unset": F.col("unset")}
    out = dict(own)
    for condition, include, exclude in reversed(sets):
        reduced = dict(own)
        if include:
            reduced = {"o": include_fields(reduced["o"], include), "set": include_update(reduced["set"], include), "unset": include_unset(reduced["unset"], include)}
        if exclude:
            reduced = {"o": exclude_fields(reduced["o"], exclude), "set": exclude_update(reduced["set"], exclude), "unset": exclude_unset(reduced["unset"], exclude)}
        out = {name: F.when(condition, reduced[name]).otherwise(out[name]) for name in out}
    delta = F.col("set").isNotNull() | F.col("unset").isNotNull()
    kept = log.withColumn("_delta", delta).withColumns(out)
    return kept.where(~F.col("_delta") | F.col("set").isNotNull() | F.col("unset").isNotNull()).drop("_delta")


def project_columns(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, key: str = "_id") -> DataFrame:
    """A table of known columns with only some, or without some; the key stays.  The scan reads no others."""
    kept = [c for c in df.columns if c == key or ((not include or c in include) and c not in (exclude or ()))]
    return df.select(*(F.col(f"`{c}`") for c in kept))
