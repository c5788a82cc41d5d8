"""What do the messages of a topic look like? Paths, kinds and counts of payloads without a schema.

Payloads are read as VARIANT, once; the nodes of every document are counted by (topic, path, kind) with a
partial aggregate. The merged schema of a topic (``schema_of_variant_agg``) says only that kinds conflict; the
counts say which kinds, and how often.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import scratch_path

# Decimals of up to so many digits are the same as doubles; a longer one stays text in a typed landing.
EXACT_DIGITS = 15

# kinds that have a column type of their own
TYPES = {"integer": "bigint", "number": "double", "string": "string", "boolean": "boolean"}


def parsed_payload(value: str = "value") -> Column:
    """The payload as VARIANT; null where it is no JSON."""
    return F.try_parse_json(F.col(value).cast("string"))


def topic_schemas(records: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """topic, documents, schema: the merged schema of a topic's documents as Spark writes it (where kinds
    conflict it says VARIANT)."""
    return (records.select(F.col(topic).alias("topic"), parsed_payload(value).alias("v"))
            .groupBy("topic").agg(F.count("v").alias("documents"), F.schema_of_variant_agg("v").alias("schema")))


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _kind(v: Column) -> Column:
    name = F.schema_of_variant(v)
    digits = F.regexp_extract(name, r"^DECIMAL\((\d+)", 1)
    return (F.when(v.isNull(), "invalid").when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
            .when(name == "VOID", "null").when(name == "BIGINT", "integer").when(name == "STRING", "string")
            .when(name == "BOOLEAN", "boolean")
            .when(name.startswith("DECIMAL") & (digits.try_cast("int") > EXACT_DIGITS), "long number")
            .otherwise("number"))


def _children(node: Column) -> Column:
    """(path, v) of what lies one level below a node; array items share one path."""
    path, v = node["path"], node["v"]
    fields = F.transform(F.map_entries(_object(v)), lambda e: F.struct(
        F.concat(path, F.lit("."), e["key"]).alias("path"), e["value"].alias("v")))
    items = F.transform(_array(v), lambda e: F.struct(F.concat(path, F.lit("[*]")).alias("path"), e.alias("v")))
    none = F.array().cast("array<struct<path:string,v:variant>>")
    return F.coalesce(fields, items, none)


def _at_level(i: int) -> Column:
    return F.transform(f"level{i}", lambda e: F.struct(F.lit(i).alias("level"), e["path"].alias("path"), e["v"].alias("v")))


def _nodes(records: DataFrame, topic: str, value: str, levels: int) -> DataFrame:
    """topic, level, path, kind, n of the nodes down to a level: one scan, one parse."""
    nodes = records.select(
        F.col(topic).alias("topic"), F.col(value).isNull().alias("missing"),
        F.array(F.struct(F.lit("$").alias("path"), parsed_payload(value).alias("v"))).alias("level0"))
    for i in range(levels):
        nodes = nodes.withColumn(f"level{i + 1}", F.flatten(F.transform(f"level{i}", _children)))
    each = [_at_level(i) for i in range(levels + 1)]
    kind = F.when(F.col("missing"), "missing").otherwise(_kind(F.col("node.v")))
    found = nodes.select("topic", "missing", F.explode(F.concat(*each)).alias("node"))
    return (found.groupBy("topic", F.col("node.level").alias("level"), F.col("node.path").alias("path"), kind.alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))


def payload_paths(records: DataFrame, topic: str = "topic", value: str = "value", levels: int = 6) -> DataFrame:
    """topic, path, kind, n: how many nodes of that kind stand at a path (``$``, ``$.a``, ``$.a[*].b``) in the
    documents of a topic. Kinds: object, array, string, integer, number, long number, boolean, null; at ``$``
    also invalid (no JSON) and missing (no payload).

    ``levels``: nesting to look into at first; documents that go deeper are read again, twice as deep, so the
    counts are whole. A null topic is one like any other; an empty table gives no rows. A topic or path that
    most rows share is added up before the shuffle. Documents whose keys are data (identifiers) give as many
    paths as keys.
    """
    spark = records.sparkSession
    while True:
        at = scratch_path(spark, "payload_paths")
        _nodes(records, topic, value, levels).write.parquet(at)
        found = spark.read.parquet(at)
        if not found.where((F.col("level") == levels) & F.col("kind").isin("object", "array")).head(1):
            break
        levels *= 2
    return found.groupBy("topic", "path", "kind").agg(F.sum("n").alias("n"))


def typed_fields(paths: Iterable[Row], topic: str | None) -> dict[str, str]:
    """{field: type} of a topic's top-level fields: the type of its only kind besides null; text (JSON) where
    kinds differ, or for objects, arrays and long numbers, so nothing is lost."""
    kinds: dict[str, set[str]] = {}
    for r in paths:
        if r["topic"] == topic and r["path"].count(".") == 1 and "[" not in r["path"]:
            kinds.setdefault(r["path"][2:], set()).add(r["kind"])
    return {f: TYPES.get(next(iter(k - {"null"})), "json") if len(k - {"null"}) == 1 else "json"
            for f, k in sorted(kinds.items())}


def typed_columns(records: DataFrame, fields: dict[str, str], value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """A column per field, read with its type; ``json`` fields as JSON text. Absent fields and JSON nulls: null."""
    v = parsed_payload(value)
    parsed = records.select(*keep, v.alias("_v"))
    columns = []
    for f, kind in fields.items():
        path = f"$['{f}']"
        columns.append((F.to_json(F.try_variant_get("_v", path, "variant")) if kind == "json"
                        else F.try_variant_get("_v", path, kind)).alias(f))
    return parsed.select(*keep, *columns)
