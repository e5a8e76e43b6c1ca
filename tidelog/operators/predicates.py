"""Which log entries are skipped, in the order the rules are tried."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import ns_coll, ns_db
from tidelog.operators.fields import FieldSets, project_each
from tidelog.operators.replay import command_of
from tidelog.operators.routing import Rule, Rules

CMD = "$cmd"


def is_migration() -> Column:
    return F.coalesce(F.col("from_migrate"), F.lit(False))


def is_noop() -> Column:
    return F.col("op") == "n"


def is_undotted() -> Column:
    return F.instr("ns", ".") == 0


def is_system() -> Column:
    return F.coalesce(ns_coll(F.col("ns")).startswith("system."), F.lit(False))


def is_chunks() -> Column:
    return F.col("ns").endswith(".chunks")


def is_file() -> Column:
    return F.col("ns").endswith(".files")


def is_command() -> Column:
    return F.coalesce(ns_coll(F.col("ns")) == CMD, F.lit(False))


def data_ns() -> Column:
    """The namespace without the suffix of file collections."""
    ns = F.col("ns")
    return F.when(is_file(), F.left(ns, F.length(ns) - len(".files"))).otherwise(ns)


def skip_reason(rules: Rules) -> Column:
    """The first rule that skips an entry, null if it is to be applied."""
    routed = rules.route(data_ns())
    return (
        F.when(is_migration(), "migrate")
        .when(is_noop(), "noop")
        .when(is_undotted(), "undotted")
        .when(is_system(), "system")
        .when(is_chunks(), "chunks")
        .when(is_file() & ~F.coalesce(routed.gridfs, F.lit(False)), "not_file_ns")
        .when(is_command(), F.lit(None))
        .when(routed.isNull(), "not_included")
    )


def applicable(log: DataFrame, rules: Rules) -> DataFrame:
    """Entries to apply, with source_ns, the target's name in ns (commands keep theirs, see ``prepare``) and is_file."""
    kept = log.withColumn("_skip", skip_reason(rules)).where("_skip is null").drop("_skip")
    dest = F.when(is_command(), F.col("ns")).otherwise(rules.route(data_ns()).dest)
    return kept.withColumns({"source_ns": F.col("ns"), "is_file": is_file(), "ns": dest})


def target_commands(log: DataFrame, rules: Rules) -> DataFrame:
    """Entries whose commands name targets: a dropped database is one command for each database its collections go to; a collection
    that isn't replicated gives none, nor does a rename from or to one."""
    routed = lambda name: rules.route(name).dest
    own = log.withColumn("_c", command_of())
    what, name, new = F.col("_c.what"), F.col("_c.name"), F.col("_c.new")
    cmd = lambda target: F.concat(ns_db(target), F.lit("." + CMD))
    entry = lambda ns, doc: F.struct(ns.alias("ns"), doc.alias("o"))
    one = lambda key, value: F.to_variant_object(F.create_map(F.lit(key), value))
    databases = F.transform(rules.target_dbs(name), lambda db: entry(F.concat(db, F.lit("." + CMD)), one("dropDatabase", db)))
    moved = F.to_variant_object(F.create_map(F.lit("renameCollection"), routed(name), F.lit("to"), routed(new)))
    rename = F.when(routed(name).isNotNull() & routed(new).isNotNull(), F.array(entry(cmd(routed(name)), moved)))
    drop = F.when(routed(name).isNotNull(), F.array(entry(cmd(routed(name)), one("drop", ns_coll(routed(name))))))
    each = F.when(what == "dropDatabase", databases).when(what == "rename", rename).when(what == "drop", drop)
    as_is = F.array(entry(F.col("ns"), F.col("o")))
    split = own.withColumn("_e", F.explode(F.when(F.col("op") == "c", each).otherwise(as_is)))
    return split.withColumns({"ns": F.col("_e.ns"), "o": F.col("_e.o")}).drop("_c", "_e")


def field_sets(rules: Rules) -> FieldSets:
    """What each rule keeps of its namespaces' documents, by the number of the rule."""
    claimed = F.col("_rule")
    found: dict[tuple, list[int]] = {}
    for k, rule in enumerate(rules.included):
        include, exclude = rules.fields(rule)
        if include or exclude:
            found.setdefault((tuple(include), tuple(exclude)), []).append(k)
    return [(claimed.isin(*own), list(include), list(exclude)) for (include, exclude), own in found.items()]


def prepare(log: DataFrame, rules: Rules) -> DataFrame:
    """What targets get of a log, in batch and in streams alike: entries of replicated namespaces under their targets' names, reduced to
    each rule's fields, without updates that have none of them; commands that name targets; file entries flagged by is_file."""
    sets = field_sets(rules)
    if not rules.included and (rules.include or rules.exclude):
        include, exclude = rules.fields(Rule(""))
        sets = [(F.lit(True), include, exclude)]
    ruled = log.withColumn("_rule", rules.route(data_ns()).rule)
    kept = applicable(ruled, rules)
    data = F.col("op") != "c"
    own = project_each(kept, [(data & ~F.col("is_file") & condition, include, exclude) for condition, include, exclude in sets]) if sets else kept
    return target_commands(own, rules).drop("_rule")
