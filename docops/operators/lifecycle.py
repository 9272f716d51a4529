"""Operations on the one index of a definition; a disabled definition does nothing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docops.definitions import IndexDefinition
from docops.functions.names import NAME_PATTERN
from docops.operators import aliases, profile, retention, search
from docops.plans.skew import local_frame
from docops.sources import tables


@dataclass(frozen=True)
class Shift:
    """The planned alias changes, the alias table and the catalogue after them."""

    plan: DataFrame
    aliases: DataFrame
    catalog: DataFrame

    def moved(self) -> DataFrame:
        return self.plan.where(F.col("kind") == aliases.MOVED).select("alias").distinct()

    def new(self) -> DataFrame:
        return self.plan.where(F.col("kind") == aliases.NEW).select("alias").distinct()


def shift_index(
    definition: IndexDefinition,
    table: DataFrame,
    catalog: DataFrame,
    extras: Sequence[str] | None,
    adder: aliases.AliasAdder = aliases.no_filter,
) -> Shift:
    """Moves the aliases behind the definition's base name to its full name."""
    spark = table.sparkSession
    active = definition.enabled and definition.shift and extras is not None
    shifts = local_frame(
        spark, [(definition.index, definition.full_name)] if active else [], "base string, full string"
    )
    named = local_frame(spark, [(definition.index, a) for a in extras or []], "base string, alias string")
    plan = aliases.plan_shift(table, shifts, named, adder)
    if active and definition.close_shifted:
        catalog = aliases.close_shifted(catalog, table, definition.index, definition.full_name)
    return Shift(plan, aliases.apply_shift(table, plan), catalog)


def prune_index(definition: IndexDefinition | None, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The fate of every candidate, and the one-row result of pruning."""
    rules = [definition.retention()] if definition is not None else []
    pattern = (definition.pattern if definition is not None else None) or NAME_PATTERN
    planned = retention.plan_retention(catalog, rules, pattern)
    return planned, retention.retention_result(planned, rules)


def route_rows(definition: IndexDefinition, df: DataFrame, timestamp: str) -> DataFrame:
    """Rows with the dated index of the definition each belongs to; none for a disabled definition."""
    routed = tables.route(df, definition.index or "", timestamp, definition.date_suffix)
    return routed if definition.enabled else routed.where(F.lit(False))


def index_rows(definition: IndexDefinition, docs: DataFrame) -> DataFrame:
    return docs.where(F.col("index") == definition.full_name)


def searchable_docs(definition: IndexDefinition, docs: DataFrame) -> DataFrame:
    return search.searchable_count(docs, definition.full_name, definition.enabled)


def most_recent_document(definition: IndexDefinition, docs: DataFrame, timestamp: str) -> DataFrame:
    return profile.most_recent(index_rows(definition, docs), timestamp, definition.enabled)


def check_mapping(definition: IndexDefinition, docs: DataFrame) -> DataFrame:
    """Field coverage of the index; empty for a disabled definition."""
    rows = index_rows(definition, docs)
    return profile.field_coverage(rows if definition.enabled else rows.limit(0), definition.mapping or {})


def compact_index(definition: IndexDefinition, table: DataFrame, path: str, files: int) -> bool:
    allowed = definition.enabled and definition.compaction
    return tables.compact(table, definition.full_name, path, files, allowed)
