"""Documents for targets: typed values to plain ones, and flattening."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.folders import stored

REGEX_FLAGS = "ilmsux"
KEPT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
Formatter = Callable[[T.StructField, Column], "Column | None"]


def binary_text(value: Column) -> Column:
    """Base 64 without line breaks, whatever the session's setting."""
    return F.regexp_replace(F.base64(value), "[\r\n]", "")


def uuid_text(value: Column) -> Column:
    """16 bytes, or a UUID with hyphens, as 32 lower-case hexadecimal digits."""
    return F.lower(F.replace(value, F.lit("-"), F.lit("")))


def regex_text(pattern: Column, flags: Column) -> Column:
    """/pattern/flags, flags in a fixed order, unknown ones left out."""
    own = F.concat(*(F.when(F.contains(flags, F.lit(f)), f).otherwise("") for f in REGEX_FLAGS))
    return F.concat(F.lit("/"), pattern, F.lit("/"), own)


def finite(value: Column) -> Column:
    """Null where a number isn't finite."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def default_format(field: T.StructField, value: Column) -> Column | None:
    """The plain form of a value by its type; null where it can't be kept, which drops the key around it."""
    kind = field.dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite(value)
    if isinstance(kind, KEPT):
        return value
    if isinstance(kind, T.BinaryType):
        return binary_text(value)
    if isinstance(kind, T.ArrayType):
        element = T.StructField("element", kind.elementType)
        bad = F.exists(value, lambda e: e.isNotNull() & default_format(element, e).isNull())
        return F.when(~bad, F.transform(value, lambda e: default_format(element, e)))
    if isinstance(kind, T.StructType):
        if set(kind.names) == {"pattern", "flags"}:
            return regex_text(value["pattern"], value["flags"])
        return F.when(value.isNotNull(), F.struct(*(default_format(f, value[f.name]).alias(f.name) for f in kind)))
    return value.cast("string")


def format_documents(df: DataFrame, formatter: Formatter = default_format) -> DataFrame:
    """All columns formatted; one whose formatter gives None is left out."""
    made = [(f.name, formatter(f, F.col(f"`{f.name}`"))) for f in df.schema]
    return df.select(*(c.alias(name) for name, c in made if c is not None))


def paths_of(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Dotted paths of all leaves of a schema that aren't below an array."""
    out: list[tuple[str, T.DataType]] = []
    for f in schema:
        out += paths_of(f.dataType, f"{prefix}{f.name}.") if isinstance(f.dataType, T.StructType) else [(prefix + f.name, f.dataType)]
    return out


#: Levels that are unwound before it is looked whether containers are left.
LEVELS = 4


def _unwound(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One level further: (keys, path, value, places, dotted, open); rows that were leaves stay, containers give a row for each of theirs, empty ones none."""
    below = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("value").outer()).toDF("_pos", "_key", "_below"))
    step, inner = F.coalesce("_key", F.col("_pos").cast("string")), F.col("_pos").isNotNull()
    container = F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)<")
    return below.where(~container | inner).select(
        *keys,
        F.when(inner, F.concat_ws(".", "path", step)).otherwise(F.col("path")).alias("path"),
        F.when(inner, F.col("_below")).otherwise(F.col("value")).alias("value"),
        F.when(inner, F.concat("places", F.array("_pos"))).otherwise(F.col("places")).alias("places"),
        (F.col("dotted") | F.coalesce(F.contains("_key", F.lit(".")), F.lit(False))).alias("dotted"),
    )


def flatten(df: DataFrame, keys: list[str], doc: str = "doc") -> DataFrame:
    """(keys, path, value as text): every leaf of a VARIANT document, at any depth; array positions are path parts, empty containers vanish.

    ``LEVELS`` levels are unwound at a time.  What is still a container then (in most collections nothing) is stored and goes on by itself.  Where keys
    hold dots, paths may collide; the later in the order of the document's (sorted) keys wins.
    """
    null = F.lit(None).cast("string").alias("path")
    rows = df.select(*keys, null, F.col(doc).alias("value"), F.array().cast("array<int>").alias("places"), F.lit(False).alias("dotted"))
    done, dots = [], False
    while True:
        for _ in range(LEVELS):
            rows = _unwound(rows, keys)
        container = F.coalesce(F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)<"), F.lit(False))
        done.append(rows.where(~container))
        signs = stored(rows.where(container | F.col("dotted")).withColumn("open", container), "flatten")
        found = signs.agg(F.max("open").alias("open"), F.max("dotted").alias("dotted")).first()
        dots = dots or bool(found.dotted)
        if not found.open:
            break
        rows = signs.where("open").drop("open")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = out.where("path is not null")
    if dots:
        out = out.groupBy(*keys, "path").agg(F.max_by("value", "places").alias("value"))
    return out.select(*keys, "path", F.coalesce(F.try_variant_get("value", "$", "string"), F.to_json("value")).alias("value"))


# documents of a collection, whose types are found in them


def schema_of(df: DataFrame, doc: str = "doc") -> T.DataType:
    """The type all documents of a VARIANT column share; where theirs conflict, or all are null, a part stays VARIANT."""
    text = df.agg(F.schema_of_variant_agg(doc)).first()[0] or "VARIANT"
    return T.DataType.fromDDL(re.sub(r"`(?:[^`]|``)*`|\bOBJECT<|\bVOID\b", lambda m: {"OBJECT<": "STRUCT<", "VOID": "VARIANT"}.get(m[0], m[0]), text))


def format_variant(value: Column, kind: T.DataType, formatter: Formatter = default_format, name: str = "") -> Column:
    """A VARIANT of type ``kind`` (of all documents), formatted; null where it can't be kept.  Nulls within documents stay, absent keys stay absent."""
    if isinstance(kind, T.VariantType):
        return value
    if isinstance(kind, T.StructType) and kind.names:
        below = [F.try_variant_get(value, json_path_of(f.name), "variant") for f in kind]
        kept = [F.when(F.is_variant_null(b), b).otherwise(format_variant(b, f.dataType, formatter, f.name)) for b, f in zip(below, kind)]
        whole = F.map_from_arrays(F.array(*map(F.lit, kind.names)), F.array(*kept))
        return F.when(value.isNotNull(), F.to_variant_object(F.map_filter(whole, lambda _, v: v.isNotNull())))
    if isinstance(kind, T.ArrayType):
        own = F.try_variant_get(value, "$", "array<variant>")
        made = F.transform(own, lambda e: F.when(F.is_variant_null(e), e).otherwise(format_variant(e, kind.elementType, formatter, name)))
        return F.when(~F.exists(made, lambda e: e.isNull()), F.to_variant_object(made))
    if isinstance(kind, T.StructType):
        return value
    return formatter(T.StructField(name, kind), F.try_variant_get(value, "$", kind.simpleString())).cast("variant")


def json_path_of(name: str) -> str:
    return f'$["{name}"]' if '"' not in name else f"$['{name}']"


def format_state(df: DataFrame, doc: str = "doc", formatter: Formatter = default_format) -> DataFrame:
    """``df`` with its VARIANT documents formatted value by value, by the schema they share; a bad value drops the nearest key around it."""
    return df.withColumn(doc, format_variant(F.col(doc), schema_of(df, doc), formatter))
