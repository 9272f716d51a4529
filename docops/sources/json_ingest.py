"""JSON documents to typed columns under a mapping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from docops.functions.mapping import FIELD_TYPES, load_mapping, mapping_schema


_BROKEN = "_broken"


def ingest_json(
    df: DataFrame, column: str, mapping: str | dict | None = None, rejected: str | None = None
) -> DataFrame:
    """Adds ``doc``: a struct with the mapped types, or text values by name for a dynamic index.

    A value that does not parse gives null. With ``rejected``, a column of that name tells
    the documents of which some part did not parse from those that lack it; a null
    document is not rejected. Points are read in all three forms: an object, the text
    ``lat,lon``, and the array ``[lon, lat]``.
    """
    text = F.col(column)
    if not load_mapping(mapping):
        doc = F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"})
        rows = df.withColumn("doc", doc)
        return rows if rejected is None else rows.withColumn(rejected, text.isNotNull() & F.col("doc").isNull())
    wanted = mapping_schema(mapping)
    parsed = F.from_json(
        text,
        _as_text(wanted).add(_BROKEN, StringType()),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN},
    )
    rows = df.withColumn(_BROKEN, parsed)
    doc = F.when(F.col(_BROKEN).isNotNull(), _rebuilt(F.col(_BROKEN), wanted))
    rows = rows.withColumn("doc", doc)
    if rejected is not None:
        wrong = F.col(_BROKEN)[_BROKEN].isNotNull() | _bad_point(F.col(_BROKEN), F.col("doc"), wanted)
        rows = rows.withColumn(rejected, text.isNotNull() & F.coalesce(wrong, F.lit(False)))
    return rows.drop(_BROKEN)


def _is_point(dtype: DataType) -> bool:
    return dtype == FIELD_TYPES["geo_point"]


def _as_text(schema: StructType) -> StructType:
    """The schema with points as text, which holds whatever form the document has."""
    fields = []
    for field in schema:
        kind = field.dataType
        if _is_point(kind):
            kind = StringType()
        elif isinstance(kind, StructType):
            kind = _as_text(kind)
        fields.append(StructField(field.name, kind))
    return StructType(fields)


def _point(text: Column) -> Column:
    pair = F.from_json(text, "array<double>")
    named = F.from_json(text, FIELD_TYPES["geo_point"])
    split = F.split(text, ",")
    comma = F.struct(split[0].try_cast("double").alias("lat"), F.get(split, 1).try_cast("double").alias("lon"))
    point = (
        F.when(text.startswith("{"), named)
        .when(text.startswith("["), F.struct(F.get(pair, 1).alias("lat"), F.get(pair, 0).alias("lon")))
        .otherwise(comma)
    )
    return F.when(text.isNotNull() & (point["lat"].isNotNull() | point["lon"].isNotNull()), point)


def _rebuilt(value: Column, schema: StructType) -> Column:
    parts = []
    for field in schema:
        part = value[field.name]
        if _is_point(field.dataType):
            part = _point(part)
        elif isinstance(field.dataType, StructType):
            part = F.when(part.isNotNull(), _rebuilt(part, field.dataType))
        parts.append(part.alias(field.name))
    return F.struct(*parts)


def _bad_point(text: Column, value: Column, schema: StructType) -> Column:
    """Whether some point was given but could not be read."""
    wrong = F.lit(False)
    for field in schema:
        if _is_point(field.dataType):
            wrong = wrong | (text[field.name].isNotNull() & value[field.name].isNull())
        elif isinstance(field.dataType, StructType):
            wrong = wrong | F.coalesce(_bad_point(text[field.name], value[field.name], field.dataType), F.lit(False))
    return wrong


def ingest_json_lists(df: DataFrame, column: str, mapping: str | dict, rejected: str | None = None) -> DataFrame:
    """Adds ``doc``: a struct in which every mapped field is an array of its values, objects included.

    A field may hold one value or an array of them; nulls inside are left out, and a field
    that is missing or null is an empty array. A value is converted where its text fits the
    mapped type (``"5"`` is a long); what does not fit, an object for a plain field among
    them, is a null entry and makes the document ``rejected``. Two numbers in an array are
    one point. Text that is no JSON object gives a null ``doc`` and is rejected.
    """
    wanted = mapping_schema(mapping)
    text, whole = F.col(column), F.col(_BROKEN)
    rows = df.withColumn(_BROKEN, F.try_parse_json(text))
    valid = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
    rows = rows.withColumn("doc", F.when(valid, _listed_struct(whole, wanted)))
    if rejected is not None:
        wrong = ~valid | F.coalesce(_has_null(F.col("doc"), wanted), F.lit(False))
        rows = rows.withColumn(rejected, text.isNotNull() & wrong)
    return rows.drop(_BROKEN)


def _shape(value: Column, *kinds: str) -> Column:
    found = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    return reduce(lambda a, b: a | b, [found.startswith(kind) for kind in kinds])


def _listed_struct(value: Column, schema: StructType) -> Column:
    """The fields of an object, each as the array of its values."""
    fields = [F.try_variant_get(value, f"$['{field.name}']", "variant") for field in schema]
    return F.struct(*[_listed(v, field.dataType).alias(field.name) for v, field in zip(fields, schema)])


def _listed(value: Column, kind: DataType) -> Column:
    several = _shape(value, "ARRAY")
    if _is_point(kind):  # an array that begins with a number is one point
        several = several & ~_shape(F.try_variant_get(value, "$[0]", "variant"), "BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    items = F.when(several, F.try_variant_get(value, "$", "array<variant>")).otherwise(F.array(value))

    def typed(item: Column) -> Column:
        if _is_point(kind):
            return _point(item.cast("string"))
        if isinstance(kind, StructType):
            return F.when(_shape(item, "OBJECT"), _listed_struct(item, kind))
        return F.when(~_shape(item, "OBJECT", "ARRAY"), F.try_variant_get(item, "$", kind.simpleString()))

    return F.transform(F.filter(items, lambda item: ~_shape(item, "VOID")), typed)


def _has_null(doc: Column, schema: StructType) -> Column:
    """Whether some value, at any depth, did not fit."""

    def wrong(item: Column, kind: DataType) -> Column:
        if isinstance(kind, StructType) and not _is_point(kind):
            return item.isNull() | F.coalesce(_has_null(item, kind), F.lit(False))
        return item.isNull()

    def of_kind(kind: DataType):
        return lambda item: wrong(item, kind)

    return reduce(lambda a, b: a | b, [F.exists(doc[f.name], of_kind(f.dataType)) for f in schema], F.lit(False))
