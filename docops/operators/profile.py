"""What an index holds: its newest document, its fields, and how many documents use each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from docops.functions.mapping import typed_paths
from docops.functions.names import utc_millis
from docops.session import scratch_path

# Newest-document answers without a document and without a value.
NO_DOCUMENT = -1
NO_VALUE = 0


def most_recent(docs: DataFrame, timestamp: str, enabled: bool = True) -> DataFrame:
    """The newest time in UTC milliseconds; -1 for no document or a disabled index, 0 for no value."""
    if not enabled:
        return docs.sparkSession.range(1).select(F.lit(NO_DOCUMENT).cast("long").alias("millis"))
    newest = F.max(utc_millis(docs, timestamp))
    return docs.agg(
        F.when(F.count("*") == 0, F.lit(NO_DOCUMENT).cast("long"))
        .otherwise(F.coalesce(newest, F.lit(NO_VALUE).cast("long")))
        .alias("millis")
    )


def most_recent_by_index(docs: DataFrame, timestamp: str) -> DataFrame:
    """The newest time of every index."""
    newest = F.max(utc_millis(docs, timestamp))
    return docs.groupBy("index").agg(F.coalesce(newest, F.lit(NO_VALUE).cast("long")).alias("millis"))


def _has(value: Column, dtype: DataType, parts: list[str]) -> Column | None:
    """Whether ``value`` has a field below it; None when its type has no such field.

    An array has a field if one of its elements has it. Maps hold dotted leaf fields; one
    that is an object is there if any leaf below it is.
    """
    if isinstance(dtype, ArrayType):
        found = _has(F.lit(None), dtype.elementType, parts)
        if found is None:
            return None
        return F.coalesce(F.exists(value, lambda item: _has(item, dtype.elementType, parts)), F.lit(False))
    if not parts:
        return value.isNotNull()
    if isinstance(dtype, StructType):
        if parts[0] not in dtype.names:
            return None
        return _has(value[parts[0]], dtype[parts[0]].dataType, parts[1:])
    if isinstance(dtype, MapType):
        path = ".".join(parts)
        leaf = F.exists(
            F.map_entries(value),
            lambda e: e["value"].isNotNull() & ((e["key"] == path) | e["key"].startswith(f"{path}.")),
        )
        return F.coalesce(leaf, F.lit(False))
    raise ValueError(f"no field {'.'.join(parts)} can be read from a value of type {dtype.simpleString()}")


def field_coverage(docs: DataFrame, mapping: str | dict, within: str | None = None) -> DataFrame:
    """Documents per mapped field: ``path, docs, percent``, least used first.

    Fields are columns of ``docs``, or parts of the column ``within``: a struct, a map of
    dotted leaf fields, or an array of either. A mapped field that the documents do not
    know counts 0; one below a plain value raises, as it could not be counted. All fields
    are counted in one pass. An empty index reports nothing.
    """
    paths = typed_paths(mapping)
    schema = docs.schema if within is None else docs.schema[within].dataType

    def seen_at(path: str) -> Column | None:
        parts = path.split(".")
        if within is not None:
            return _has(F.col(within), schema, parts)
        if parts[0] not in docs.columns:
            return None
        return _has(F.col(parts[0]), schema[parts[0]].dataType, parts[1:])

    present: Mapping[str, Column | None] = {p: seen_at(p) for p in paths}
    counts = [
        (F.count_if(seen) if seen is not None else F.lit(0).cast("long")).alias(f"c{i}")
        for i, seen in enumerate(present.values())
    ]
    totals = docs.agg(F.count("*").alias("total"), *counts)
    entry = [F.struct(F.lit(p).alias("path"), F.col(f"c{i}").alias("docs")) for i, p in enumerate(paths)]
    return (
        totals.where(F.col("total") > 0)
        .select("total", F.inline(F.array(*entry)))
        .select("path", "docs", (F.col("docs") * F.lit(100.0) / F.col("total")).alias("percent"))
        .orderBy("docs", "path")
    )


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """The number of mapped fields and how many no document uses."""
    return coverage.agg(
        F.count("*").alias("fields"), F.count_if(F.col("docs") == 0).alias("unused")
    )


def observed_fields(docs: DataFrame, json_column: str) -> DataFrame:
    """Distinct top-level field names in a JSON column, with the number of documents having each."""
    names = F.map_keys(F.from_json(F.col(json_column), "map<string,string>"))
    return docs.select(F.explode(names).alias("field")).groupBy("field").agg(F.count("*").alias("docs"))


#: Levels of nesting that are walked at first; twice as many each time something lies deeper.
ROUNDS = 4


def observed_paths(docs: DataFrame, json_column: str, rounds: int = ROUNDS) -> DataFrame:
    """Dotted paths of all values in a JSON column at any depth: ``path, docs``.

    Objects add their names to the path, arrays do not: a document counts once for a path
    however often an array holds it. Nulls, empty objects and empty arrays hold no value,
    and text that is no JSON none either; a plain value as a whole has the empty path.
    The walk takes place inside each row; only distinct paths of a row are shuffled, once.
    """
    whole = F.struct(F.lit("").alias("path"), F.try_parse_json(json_column).alias("value"))
    nodes = F.array(whole)
    for _ in range(rounds):
        nodes = F.flatten(F.transform(nodes, _grown))
    values = F.filter(nodes, lambda n: _kind(n) != "VOID")
    # Null where a node still is an object or array: something lies deeper.
    ends = F.transform(values, lambda n: F.when(~_kind(n).rlike("^(OBJECT|ARRAY)"), n["path"]))
    counted = docs.select(F.explode(F.array_distinct(ends)).alias("path")).groupBy("path").agg(F.count("*").alias("docs"))
    path = scratch_path(docs.sparkSession, "paths")
    counted.write.parquet(path)
    found = docs.sparkSession.read.schema("path string, docs long").parquet(path)
    return found if found.where("path IS NULL").isEmpty() else observed_paths(docs, json_column, 2 * rounds)


def _kind(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node["value"]), F.lit("VOID"))


def _grown(node: Column) -> Column:
    """A node's members, one level down; a plain value stays as it is."""
    path, value = node["path"], node["value"]

    def member(entry: Column) -> Column:
        name = F.when(path == "", entry["key"]).otherwise(F.concat(path, F.lit("."), entry["key"]))
        return F.struct(name.alias("path"), entry["value"].alias("value"))

    fields = F.transform(F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")), member)
    items = F.transform(
        F.try_variant_get(value, "$", "array<variant>"), lambda v: F.struct(path.alias("path"), v.alias("value"))
    )
    return F.when(_kind(node).startswith("OBJECT"), fields).when(_kind(node).startswith("ARRAY"), items).otherwise(F.array(node))
