"""Alias tables (``alias, index, filter_field, filter_value``): resolving, shifting, scanning."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.functions.names import NAME_PATTERN, base_of
from docops.operators.catalog import CLOSE, keep_indices, with_state
from docops.plans.skew import checked_broadcast
from docops.sources.versions import VersionedTables

ALIAS_ROW = ["alias", "index", "filter_field", "filter_value"]
MOVED, NEW = "moved", "new"

# Tables of a version of the metadata.
ALIASES, CATALOG, PLAN = "aliases", "catalog", "plan"

AliasAdder = Callable[[Column, Column], tuple[Column, Column]]


def resolve_alias(aliases: DataFrame, alias: str) -> DataFrame:
    """The indices behind ``alias``, ascending; none for an unknown alias."""
    return aliases.where(F.col("alias") == alias).select("index").distinct().orderBy("index")


def aliases_of(aliases: DataFrame, index: str) -> DataFrame:
    """The aliases of ``index``, each with its filter or nulls."""
    return aliases.where(F.col("index") == index).select("alias", "filter_field", "filter_value")


def most_recent_index(aliases: DataFrame, requests: DataFrame, pattern: str = NAME_PATTERN) -> DataFrame:
    """The greatest dated name behind each requested alias; an unknown alias stands for itself."""
    dated = aliases.where(base_of(F.col("index"), pattern) == F.col("alias"))
    latest = dated.groupBy("alias").agg(F.max("index").alias("index"))
    return requests.join(latest, "alias", "left").withColumn("index", F.coalesce("index", "alias"))


def no_filter(index: Column, alias: Column) -> tuple[Column, Column]:
    return F.lit(None).cast("string"), F.lit(None).cast("string")


def plan_shift(
    aliases: DataFrame, shifts: DataFrame, extras: DataFrame | None = None, adder: AliasAdder = no_filter
) -> DataFrame:
    """What shifting does: rows ``base, kind, alias, old_index, index, filter_field, filter_value``.

    ``shifts`` holds ``base, full`` per shift; ``extras`` holds ``base, alias``.
    Every alias of the smallest index behind ``base`` moves to ``full`` with its
    filter. ``base`` itself and extras that are not among those are new; only new
    extras take their filter from ``adder(index, alias)``. A base equal to its full
    name, or none at all, shifts nothing. An old index behind two bases belongs to
    the smaller base.
    """
    wanted = shifts.where(F.col("base").isNotNull() & (F.col("base") != F.col("full"))).select("base", "full")
    few = checked_broadcast(wanted)
    olds = (
        aliases.join(few.withColumnRenamed("base", "alias"), "alias")
        .groupBy("alias", "full")
        .agg(F.min("index").alias("index"))
        .groupBy("index")
        .agg(F.min_by(F.struct(F.col("alias").alias("base"), "full"), "alias").alias("shift"))
        .select("index", "shift.*")
    )
    moved = (
        aliases.join(checked_broadcast(olds), "index")
        .withColumnRenamed("index", "old_index")
        .select("base", F.lit(MOVED).alias("kind"), "alias", "old_index", F.col("full").alias("index"),
                "filter_field", "filter_value")
    )
    candidates = wanted.select("base", "full", F.col("base").alias("alias"), F.lit(False).alias("extra"))
    if extras is not None:
        named = extras.where(F.coalesce(F.col("alias"), F.lit("")) != "").select("base", "alias")
        candidates = candidates.unionByName(
            named.join(few, "base").select("base", "full", "alias", F.lit(True).alias("extra"))
        )
    field, value = adder(F.col("full"), F.col("alias"))
    absent = F.lit(None).cast("string")
    added = (
        candidates.groupBy("base", "full", "alias")
        .agg(F.min("extra").alias("extra"))
        .join(moved.select("base", "alias"), ["base", "alias"], "left_anti")
        .select(
            "base",
            F.lit(NEW).alias("kind"),
            "alias",
            absent.alias("old_index"),
            F.col("full").alias("index"),
            F.when(F.col("extra"), field).otherwise(absent).alias("filter_field"),
            F.when(F.col("extra"), value).otherwise(absent).alias("filter_value"),
        )
    )
    return moved.unionByName(added)


def apply_shift(aliases: DataFrame, plan: DataFrame) -> DataFrame:
    """The alias table after a planned shift, ready to be written as its next version."""
    gone = plan.select("alias", F.explode(F.array("old_index", "index")).alias("index")).where(
        F.col("index").isNotNull()
    )
    kept = aliases.select(*ALIAS_ROW).join(gone.distinct(), ["alias", "index"], "left_anti")
    added = plan.groupBy("alias", "index").agg(
        F.min_by(F.struct("filter_field", "filter_value"), "base").alias("f")
    )
    return kept.unionByName(added.select("alias", "index", "f.*"))


def close_shifted(catalog: DataFrame, aliases: DataFrame, base: str, full: str) -> DataFrame:
    """The catalogue after closing every index behind ``base`` except the new one."""
    behind = aliases.where((F.col("alias") == base) & (F.col("index") != full))
    return with_state(catalog, behind.select("index"), CLOSE)


def close_all_shifted(catalog: DataFrame, aliases: DataFrame, shifts: DataFrame) -> DataFrame:
    """The catalogue after closing, for each shift (``base, full``), all behind the base except the new index.

    An index that another shift has just moved its aliases to stays as it is.
    """
    wanted = shifts.where(F.col("base").isNotNull() & (F.col("base") != F.col("full"))).select("base", "full")
    few = checked_broadcast(wanted)
    behind = aliases.join(few.withColumnRenamed("base", "alias"), "alias").where("index != full").select("index")
    targets = wanted.select(F.col("full").alias("index")).distinct()
    return with_state(catalog, behind.distinct().join(targets, "index", "left_anti"), CLOSE)


def commit_shift(
    metadata: VersionedTables,
    shifts: DataFrame,
    extras: DataFrame | None = None,
    adder: AliasAdder = no_filter,
    close: bool = False,
) -> int:
    """Shifts the aliases of the newest version and returns the number of the version that this makes.

    ``metadata`` holds ``aliases`` and ``catalog``. The new version adds ``plan``, what
    the shift did; it is computed once, and both tables follow from what was written. They
    appear together or, if the shift is interrupted, not at all.
    """
    version = metadata.latest()
    if version is None:
        raise ValueError("there is no alias table to shift")
    table, known = metadata.read(ALIASES, version), metadata.read(CATALOG, version)
    closed = close_all_shifted(known, table, shifts) if close else known
    steps = {
        PLAN: plan_shift(table, shifts, extras, adder),
        ALIASES: lambda written: apply_shift(table, written[PLAN]),
        CATALOG: closed,
    }
    return metadata.commit(steps, version)


def scan_aliases(docs: DataFrame, aliases: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows visible through each alias, with the alias added: one row for each document and alias.

    A filter compares in the type of its field; one on a field not among ``fields`` matches
    nothing. Filtered aliases are found by equality of index and value, one field after
    the other, so an index with very many filtered aliases makes no pairs.
    """
    rows = aliases.select(*ALIAS_ROW).distinct()
    everything = rows.where(F.col("filter_field").isNull()).select("alias", "index").distinct()
    seen = docs.join(checked_broadcast(everything), "index")
    # An alias that shows the whole index needs none of its filters.
    filtered = rows.where(F.col("filter_field").isNotNull()).join(everything, ["alias", "index"], "left_anti")
    sides: list[tuple[str, DataFrame]] = []
    for name in fields:
        wanted = F.col("filter_value").try_cast(docs.schema[name].dataType).alias("_value")
        side = filtered.where(F.col("filter_field") == name).select("alias", "index", wanted).distinct()
        part = docs.withColumn("_value", F.col(name)).join(checked_broadcast(side), ["index", "_value"])
        for earlier, shown in sides:  # rows that another filter of the alias has shown already
            part = part.withColumn("_value", F.col(earlier)).join(shown, ["alias", "index", "_value"], "left_anti")
        sides.append((name, side))
        seen = seen.unionByName(part.drop("_value"))
    return seen


def scan_alias(docs: DataFrame, aliases: DataFrame, alias: str) -> DataFrame:
    """Rows visible through one alias, by the rules of ``scan_aliases``; other indices are pruned."""
    rows = aliases.where(F.col("alias") == alias).select(*ALIAS_ROW)
    named = rows.select("filter_field").distinct()
    fields = [f for f in docs.columns if f not in ("index", "alias")]
    used = {r["filter_field"] for r in named.where(F.col("filter_field").isin(fields)).collect()}
    scoped = keep_indices(docs.drop("alias"), rows)
    seen = scan_aliases(scoped, rows, [f for f in fields if f in used])
    return seen.select(*[c for c in docs.columns if c != "alias"])
