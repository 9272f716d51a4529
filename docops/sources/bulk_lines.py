"""Bulk change logs as newline-delimited JSON: an action line and, but for deletes, a source line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.operators.changelog import CREATE, DELETE, INDEX, UPDATE


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _body(df: DataFrame) -> Column:
    """The document as JSON text: a string column holds it already."""
    kind = df.schema["source"].dataType.typeName()
    return F.col("source") if kind == "string" else F.to_json("source")


def bulk_lines(ops: DataFrame) -> DataFrame:
    """Adds ``body``: the lines of each operation, joined and ended by line breaks.

    Optional columns ``routing``, ``version`` and ``version_type`` appear in the
    action when set; a version only above zero, and never for a delete. An index or
    create without a source is an empty document.
    """
    versioned = (F.col("op") != DELETE) & (_optional(ops, "version").cast("long") > 0)
    action = F.to_json(
        F.struct(
            F.col("index").alias("_index"),
            F.col("id").alias("_id"),
            _optional(ops, "routing").alias("_routing"),
            F.when(versioned, _optional(ops, "version").cast("string")).alias("_version"),
            F.when(versioned, _optional(ops, "version_type")).alias("_version_type"),
        )
    )
    head = F.concat(F.lit('{"'), F.col("op"), F.lit('":'), action, F.lit("}\n"))
    source = _body(ops)
    tail = (
        F.when(F.col("op").isin(INDEX, CREATE), F.concat(F.coalesce(source, F.lit("{}")), F.lit("\n")))
        .when(F.col("op") == UPDATE, F.coalesce(F.concat(F.lit('{"doc":'), source, F.lit("}\n")), F.lit("")))
        .otherwise("")
    )
    return ops.withColumn("body", F.concat(head, tail))


def export_bulk(ops: DataFrame, path: str) -> None:
    """Writes the lines as text files; the two lines of an operation stay together."""
    bulk_lines(ops).select(F.regexp_replace("body", "\n$", "").alias("value")).write.mode("errorifexists").text(path)
