"""Index mappings (nested JSON with ``properties``) and the schemas they stand for."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Field types of a mapping and the Spark types that hold them.
FIELD_TYPES: dict[str, DataType] = {
    "keyword": StringType(),
    "text": StringType(),
    "date": StringType(),
    "integer": IntegerType(),
    "long": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "geo_point": StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())]),
    "standardnumber": StringType(),
    "ref": StringType(),
}
# Field types whose inner definitions are not looked into.
OPAQUE_TYPES = ("standardnumber", "ref")


def load_mapping(mapping: str | dict | None) -> dict:
    """The mapping as a dict; empty for a dynamic index."""
    if not mapping:
        return {}
    return json.loads(mapping) if isinstance(mapping, str) else mapping


def field_names(mapping: str | dict | None) -> list[str]:
    """Top-level field names, sorted."""
    return sorted(load_mapping(mapping).get("properties", {}))


def mapping_schema(mapping: str | dict) -> StructType:
    """The struct type of a document under ``mapping``."""
    fields = []
    for name, spec in load_mapping(mapping).get("properties", {}).items():
        opaque = spec.get("type") in OPAQUE_TYPES
        if "properties" in spec and not opaque:
            dtype: DataType = mapping_schema(spec)
        else:
            dtype = FIELD_TYPES.get(spec.get("type", "text"), StringType())
        fields.append(StructField(name, dtype))
    return StructType(fields)


def _indexed(spec: dict) -> bool:
    return spec.get("index") not in ("no", False)


def typed_paths(mapping: str | dict) -> list[str]:
    """Dotted paths of every searchable field with a type, objects included, sorted."""
    found: list[str] = []

    def visit(prefix: str, spec: dict) -> None:
        for name, child in spec.get("properties", {}).items():
            if not _indexed(child):
                continue
            path = f"{prefix}{name}"
            if isinstance(child.get("type"), str):
                found.append(path)
            if child.get("type") not in OPAQUE_TYPES:
                visit(f"{path}.", child)
                for sub, sub_spec in child.get("fields", {}).items():
                    if _indexed(sub_spec) and isinstance(sub_spec.get("type"), str):
                        found.append(f"{path}.fields.{sub}")

    root = load_mapping(mapping)
    if _indexed(root):
        visit("", root)
    return sorted(found)


def leaf_map(record: Column, schema: StructType) -> Column:
    """A typed record as ``map<string,string>`` of dotted leaf paths; null leaves are left out."""
    entries: list[Column] = []

    def visit(column: Column, fields: StructType, prefix: str) -> None:
        for field in fields.fields:
            value = column[field.name]
            if isinstance(field.dataType, StructType):
                visit(value, field.dataType, f"{prefix}{field.name}.")
            else:
                text = F.to_json(value) if isinstance(field.dataType, ArrayType) else value.cast("string")
                entries.append(F.struct(F.lit(f"{prefix}{field.name}").alias("key"), text.alias("value")))

    visit(record, schema, "")
    kept = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return F.map_from_entries(kept)
