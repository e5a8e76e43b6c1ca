"""Namespace rules: include, exclude, rename, wildcards, fields.

A rule's names may hold one ``*`` each: in the database it matches no dot, in the collection
anything.  Exclusions win; plain rules come before wildcards, and wildcards in the order given;
with no rule that includes, everything passes unrenamed.  Rules are configuration, so they become
one CASE expression on the namespace: routing is a projection, with no join and no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.scalars import ns_coll, ns_db

ROUTE = "struct<dest:string,rule:int,gridfs:boolean>"


@dataclass(frozen=True)
class Rule:
    source: str
    dest: str | None = None
    gridfs: bool = False
    excluded: bool = False
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()

    @property
    def target(self) -> str:
        return self.dest or self.source

    @property
    def plain(self) -> bool:
        return "*" not in self.source


def ns_regex(pattern: str) -> str:
    """An anchored expression with a group for each ``*``."""
    db, dot, coll = pattern.partition(".")  # a pattern without a dot is one of a database
    part = lambda text, any_: any_.join(map(re.escape, text.split("*")))
    return r"\A" + part(db, "([^.]*)") + re.escape(dot) + part(coll, "(.*)") + r"\z"


def around_star(pattern: str) -> tuple[str, str] | None:
    """What is before and after the only ``*`` of a pattern that has it in the collection, where it stands for anything; None for other patterns."""
    before, _, after = pattern.partition("*")
    return (before, after) if "." in before and pattern.count("*") == 1 else None


def matches(ns: Column, pattern: str) -> Column:
    """Whether a namespace is one of a pattern's; most patterns need no regular expression, which would be most of what routing costs."""
    if "*" not in pattern:
        return ns == pattern
    if (ends := around_star(pattern)) is None:
        return ns.rlike("(?s)" + ns_regex(pattern))
    before, after = ends
    return ns.startswith(before) & ns.endswith(after) & (F.length(ns) >= len(before + after)) if after else ns.startswith(before)


def renamed(ns: Column, source: str, dest: str) -> Column:
    """``dest`` with its ``*`` replaced by what the source's matched; for namespaces that ``source`` matches."""
    if "*" not in dest:
        return F.lit(dest)
    before, _, after = dest.partition("*")
    if (ends := around_star(source)) is None:
        matched = F.regexp_extract(ns, "(?s)" + ns_regex(source), 1)
    else:
        matched = F.substring(ns, F.lit(len(ends[0]) + 1), F.length(ns) - len(ends[0] + ends[1]))
    return F.concat(F.lit(before), matched, F.lit(after))


@dataclass(frozen=True)
class Rules:
    rules: tuple[Rule, ...] = ()
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()

    @property
    def included(self) -> list[Rule]:
        """In the order they are tried."""
        return sorted((r for r in self.rules if not r.excluded), key=lambda r: not r.plain)

    def is_excluded(self, ns: Column) -> Column:
        out = F.lit(False)
        for rule in self.rules:
            if rule.excluded:
                out = out | matches(ns, rule.source)
        return out

    def route(self, ns: Column) -> Column:
        """struct(dest, rule, gridfs), null for a namespace that isn't replicated."""
        found = F.lit(None).cast(ROUTE) if self.included else F.struct(ns.alias("dest"), F.lit(-1).alias("rule"), F.lit(False).alias("gridfs"))
        for k, rule in reversed(list(enumerate(self.included))):
            own = F.struct(renamed(ns, rule.source, rule.target).alias("dest"), F.lit(k).alias("rule"), F.lit(rule.gridfs).alias("gridfs"))
            found = F.when(matches(ns, rule.source), own).otherwise(found)
        return F.when(self.is_excluded(ns), F.lit(None).cast(ROUTE)).otherwise(found)

    def unmap(self, dest: Column) -> Column:
        """The source namespace of a target's, null if none maps there."""
        found = F.lit(None).cast("string") if self.included else dest
        for rule in reversed(self.included):
            found = F.when(matches(dest, rule.target), renamed(dest, rule.target, rule.source)).otherwise(found)
        return found

    def target_dbs(self, db: Column) -> Column:
        """All target databases of a source database: its collections may go to several."""
        if not self.included:
            return F.array(db)
        found = []
        for rule in self.included:
            source, target = rule.source.partition(".")[0], rule.target.partition(".")[0]
            found.append(F.when(matches(db, source), renamed(db, source, target) if "*" in source else F.lit(target)))
        return F.array_distinct(F.filter(F.array(*found), lambda name: name.isNotNull()))

    def fields(self, rule: Rule) -> tuple[list[str], list[str]]:
        """(included, excluded) fields: the rule's with the global ones; ``_id`` always stays."""
        include = sorted({*self.include, *rule.include})
        return (sorted({*include, "_id"}) if include else [], sorted({*self.exclude, *rule.exclude} - {"_id"}))

    def databases(self) -> list[str]:
        """Databases to scan; empty means all."""
        names = {r.source.partition(".")[0] for r in self.included}
        return [] if any("*" in name for name in names) else sorted(names)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(k, r.source, r.target, ns_regex(r.source), r.plain, r.gridfs, *self.fields(r)) for k, r in enumerate(self.included)]
        schema = "rule int, source string, dest string, regex string, is_plain boolean, gridfs boolean, include_fields array<string>, exclude_fields array<string>"
        return spark.createDataFrame(rows, schema)

    def violations(self) -> list[tuple[str, str]]:
        """(source, reason) of every rule that breaks a condition."""
        out, targets = [], Counter(r.target for r in self.included)
        excluded = {r.source for r in self.rules if r.excluded}
        for r in self.rules:
            for name in {r.source, r.target}:
                db, dot, coll = name.partition(".")
                if not (db and dot and coll):
                    out.append((r.source, "no_dot"))
                if name.count("*") > 1 and not r.excluded:
                    out.append((r.source, "many_wildcards"))
            if r.excluded:
                continue
            if r.source.count("*") != r.target.count("*"):
                out.append((r.source, "wildcard_count"))
            elif "*" in r.source and ("*" in r.source.partition(".")[0]) != ("*" in r.target.partition(".")[0]):
                out.append((r.source, "wildcard_moved"))
            if targets[r.target] > 1:
                out.append((r.source, "target_twice"))
            if r.source in excluded:
                out.append((r.source, "included_and_excluded"))
            if r.include and r.exclude:
                out.append((r.source, "both_field_kinds"))
            if r.gridfs and r.dest and r.dest != r.source:
                out.append((r.source, "file_renamed"))
        return out


def parse_rules(config: dict[str, object], include: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> Rules:
    """Rules from a mapping of namespace to true, false, a new name, or a dict of rename, includeFields, excludeFields, gridfs."""
    out = []
    for source, value in config.items():
        if value is False:
            out.append(Rule(source, excluded=True))
        elif isinstance(value, str):
            out.append(Rule(source, value))
        elif isinstance(value, dict):
            out.append(Rule(source, value.get("rename"), bool(value.get("gridfs")), False, tuple(value.get("includeFields", ())), tuple(value.get("excludeFields", ()))))
        else:
            out.append(Rule(source))
    return Rules(tuple(out), include, exclude)


def rules_of_lists(
    include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), mapping: dict[str, str] | None = None, gridfs: tuple[str, ...] = (), **fields: tuple[str, ...]
) -> Rules:
    """Rules from lists of namespaces and a mapping of old to new names; a mapping's entry wins over the lists' for its namespace."""
    names = dict.fromkeys([*(mapping or {}), *include, *gridfs])
    rules = [Rule(n, (mapping or {}).get(n), n in gridfs) for n in names]
    return Rules((*rules, *(Rule(n, excluded=True) for n in exclude)), fields.get("include_fields", ()), fields.get("exclude_fields", ()))


def namespaces(df: DataFrame) -> DataFrame:
    return df.select("ns").distinct()


def map_namespaces(names: DataFrame, rules: Rules) -> DataFrame:
    """(ns, dest, rule, gridfs) of the namespaces that are replicated."""
    return names.withColumn("r", rules.route(F.col("ns"))).where("r is not null").select("ns", "r.*")


def discover(names: DataFrame, rules: Rules) -> DataFrame:
    """Namespaces to copy: no internal databases, system or chunk collections; ``.files`` only of file namespaces."""
    ns = F.col("ns")
    own = names.where(~ns_db(ns).isin("config", "local") & (F.instr(ns, ".") > 0))
    own = own.where(~ns_coll(ns).startswith("system.") & ~ns.endswith(".chunks"))
    base = F.regexp_replace(ns, r"\.files\z", "")
    own = own.withColumn("r", rules.route(base)).where("r is not null")
    return own.where(~ns.endswith(".files") | F.col("r.gridfs")).select("ns", F.col("r.dest").alias("dest"), ns.endswith(".files").alias("is_file"))


def conflicts(mapped: DataFrame, strict_db: bool = False) -> DataFrame:
    """Targets that several sources resolve to; with ``strict_db``, also target databases of several source databases."""
    out = mapped.groupBy("dest").agg(F.count_distinct("ns").alias("sources")).where("sources > 1")
    if strict_db:
        dbs = mapped.groupBy(ns_db(F.col("dest")).alias("dest")).agg(F.count_distinct(ns_db(F.col("ns"))).alias("sources"))
        out = out.unionByName(dbs.where("sources > 1"))
    return out


def overlaps(names: DataFrame, patterns: list[str]) -> DataFrame:
    """(ns, patterns): namespaces that more than one pattern matches."""
    hits = sum((matches(F.col("ns"), p).cast("int") for p in patterns), F.lit(0))
    return names.withColumn("patterns", hits).where("patterns > 1")


def witness(p: str, q: str) -> str | None:
    """A shortest name that both patterns match, None if there is none: a search over pairs of places in them, breadth first.

    A ``*`` of a database matches no dot, one of a collection anything; each may hold several.
    """
    tokens = []
    for pattern in (p, q):
        db, dot, coll = pattern.partition(".")
        tokens.append([(c, c == "*", False) for c in db] + [(c, c == "*", c == "*") for c in dot + coll])
    first, second = tokens
    reached: dict[tuple[int, int], str] = {(0, 0): ""}
    level = [(0, 0)]
    while level:
        free, further = list(level), []
        for i, j in free:  # a star may end without taking a letter
            name = reached[i, j]
            for own, to in ((i < len(first) and first[i][1], (i + 1, j)), (j < len(second) and second[j][1], (i, j + 1))):
                if own and to not in reached:
                    reached[to] = name
                    free.append(to)
        if (len(first), len(second)) in reached:
            return reached[len(first), len(second)]
        for i, j in free:
            if i == len(first) or j == len(second):
                continue
            (a, a_star, a_dots), (b, b_star, b_dots) = first[i], second[j]
            if a_star and b_star:
                continue  # one of them may as well end
            letter = b if a_star else a
            fits = a == b or (a_star and (a_dots or b != ".")) or (b_star and (b_dots or a != "."))
            to = (i if a_star else i + 1, j if b_star else j + 1)
            if fits and to not in reached:
                reached[to] = reached[i, j] + letter
                further.append(to)
        level = further
    return None


def pattern_overlaps(patterns: DataFrame, column: str = "pattern") -> DataFrame:
    """(pattern, other, name): pairs of patterns that can match one name, whether or not there is a namespace of that name, with such a name.

    Pairs are formed of what is before the first ``*`` where one begins the other; a table of rules has few rows.
    """

    @F.pandas_udf("string")
    def found(p: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([witness(a, b) for a, b in zip(p, q)], dtype=object)

    own = patterns.select(F.col(column).alias("pattern"), F.substring_index(column, "*", 1).alias("head")).distinct()
    other = own.select(F.col("pattern").alias("other"), F.col("head").alias("other_head"))
    pairs = own.join(other, (F.col("pattern") < F.col("other")) & (F.startswith("head", F.col("other_head")) | F.startswith("other_head", F.col("head"))))
    return pairs.select("pattern", "other", found("pattern", "other").alias("name")).where("name is not null")


RULE_SCHEMA = "source string, dest string, gridfs boolean, excluded boolean, include array<string>, exclude array<string>"


def violations(rules: DataFrame) -> DataFrame:
    """(source, reason) of every rule of a table (RULE_SCHEMA) that breaks a condition; one row for each reason.

    Targets are counted, and included sources looked up among the excluded ones, by grouping and joining the table with itself on equal names.
    """
    own = rules.withColumn("target", F.coalesce("dest", "source"))
    included = own.where(~F.col("excluded"))
    twice = included.groupBy("target").agg((F.count("*") > 1).alias("twice"))
    both = own.where("excluded").select("source", F.lit(True).alias("out")).distinct()
    judged = own.join(twice, "target", "left").join(both, "source", "left")
    stars = lambda name: F.regexp_count(name, F.lit("[*]"))
    kept, names = ~F.col("excluded"), F.array("source", "target")
    in_db = lambda name: F.contains(ns_db(F.col(name)), F.lit("*"))
    same = stars("source") == stars("target")
    reasons = {
        "no_dot": F.exists(names, lambda n: ~F.rlike(n, F.lit(r"(?s)\A[^.]+\..+\z"))),
        "many_wildcards": kept & F.exists(names, lambda n: stars(n) > 1),
        "wildcard_count": kept & ~same,
        "wildcard_moved": kept & same & (stars("source") > 0) & (in_db("source") != in_db("target")),
        "target_twice": kept & F.coalesce("twice", F.lit(False)),
        "included_and_excluded": kept & F.coalesce("out", F.lit(False)),
        "both_field_kinds": kept & (F.coalesce(F.size("include"), F.lit(0)) > 0) & (F.coalesce(F.size("exclude"), F.lit(0)) > 0),
        "file_renamed": kept & F.col("gridfs") & (F.col("target") != F.col("source")),
    }
    found = F.array_compact(F.array(*(F.when(broken, name) for name, broken in reasons.items())))
    return judged.select("source", F.explode(found).alias("reason"))
