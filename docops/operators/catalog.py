"""The index catalogue: listing, state, open and close, purge and drop.

A catalogue is ``index, doc_count, created, state``. It is metadata: one row per
index, however many documents the index holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.plans.skew import BROADCAST_ROWS, bounded_rows, checked_broadcast

# Index states.
OPEN, CLOSE = "OPEN", "CLOSE"

# Up to this many index names become a literal list, which prunes partitions while planning.
PRUNING_NAMES = 10_000


def build_catalog(docs: DataFrame, created: str, states: DataFrame | None = None) -> DataFrame:
    """One row per index of ``docs``; ``states`` (``index, state``) overrides the state OPEN."""
    counted = docs.groupBy("index").agg(F.count("*").alias("doc_count"), F.min(created).alias("created"))
    if states is None:
        return counted.withColumn("state", F.lit(OPEN))
    return counted.join(states.select("index", "state"), "index", "left").withColumn(
        "state", F.coalesce("state", F.lit(OPEN))
    )


def list_indices(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy("index")


def index_state(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """For each requested name: whether it exists, its state, and the open and closed flags.

    An unknown index has no state and is neither open nor closed.
    """
    known = catalog.select("index", "state")
    return requests.join(known, "index", "left").select(
        *requests.columns,
        F.col("state").isNotNull().alias("exists"),
        "state",
        F.coalesce(F.col("state") == OPEN, F.lit(False)).alias("is_open"),
        F.coalesce(F.col("state") == CLOSE, F.lit(False)).alias("is_closed"),
    )


def closed_indices(catalog: DataFrame, created_before: Column | None = None) -> DataFrame:
    """Names of closed indices; with a time, only those created strictly before it."""
    closed = F.col("state") == CLOSE
    if created_before is not None:
        closed = closed & (F.col("created") < created_before)
    return catalog.where(closed).select("index").distinct()


def with_state(catalog: DataFrame, names: DataFrame, state: str) -> DataFrame:
    """The catalogue after opening or closing the named indices; unknown names are ignored."""
    changed = names.select("index").distinct().withColumn("_new", F.lit(state))
    return (
        catalog.join(checked_broadcast(changed), "index", "left")
        .withColumn("state", F.coalesce("_new", "state"))
        .drop("_new")
    )


def scan_open(docs: DataFrame, catalog: DataFrame, listed: int = PRUNING_NAMES) -> DataFrame:
    """The rows a search can see: those of open indices. Prunes partitions of a routed table."""
    return keep_indices(docs, catalog.where(F.col("state") == OPEN), listed)


def keep_indices(docs: DataFrame, names: DataFrame, listed: int = PRUNING_NAMES) -> DataFrame:
    """Rows whose index is among ``names``; a null name or index matches nothing.

    Up to ``listed`` names are a literal list, by which a routed table is pruned while
    planning; more are joined, and prune it while running if they can be broadcast and
    were themselves filtered.
    """
    known = names.where(F.col("index").isNotNull()).select("index").distinct()
    rows = bounded_rows(known, listed)
    if rows is not None:
        return docs.where(F.col("index").isin([row["index"] for row in rows]))
    few = bounded_rows(known, BROADCAST_ROWS) is not None
    return docs.join(F.broadcast(known) if few else known, "index", "left_semi")


def drop_indices(docs: DataFrame, names: DataFrame | Sequence[str]) -> DataFrame:
    """Rows of all other indices; null names and names that do not exist are skipped."""
    if isinstance(names, DataFrame):
        known = names.where(F.col("index").isNotNull()).select("index").distinct()
        rows = bounded_rows(known, PRUNING_NAMES)
        listed = None if rows is None else [row["index"] for row in rows]
    else:
        listed = [name for name in names if name is not None]
    if listed is not None:
        return docs.where(F.col("index").isNull() | ~F.col("index").isin(listed))
    return docs.join(checked_broadcast(known), "index", "left_anti")


def purge_closed(docs: DataFrame, catalog: DataFrame, created_before: Column | None = None) -> DataFrame:
    """Rows that remain when closed indices older than the given time are removed."""
    return drop_indices(docs, closed_indices(catalog, created_before))
