"""Change logs: index, create, update and delete operations applied to keyed documents.

Operations are rows ``seq, index, id, op, source`` where ``source`` is a
``map<string,string>`` of dotted leaf fields and ``seq`` is unique. The state of a
document follows from two facts about its key, so no sequential replay is needed:

* a document is live before an operation if the last earlier non-update is not a
  delete (a create that failed left a live document behind);
* its final fields come from its *barrier*, the last operation that replaced or
  deleted it, and the updates after that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docops.plans.skew import (
    SEGMENT,
    HotKeys,
    checked_broadcast,
    find_hot_keys,
    join_summary,
    with_segments,
)

# Operation names and outcomes.
INDEX, CREATE, UPDATE, DELETE = "index", "create", "update", "delete"
OK, CONFLICT, MISSING = "ok", "conflict", "missing"
SNAPSHOT_SEQ = -1

KEY = ["index", "id"]
OPERATION = ["seq", "index", "id", "op", "source"]


class BulkFailedError(RuntimeError):
    """Some operations of a bulk request failed."""


def snapshot_operations(documents: DataFrame) -> DataFrame:
    """Existing documents as index operations before every other one."""
    return documents.select(
        F.lit(SNAPSHOT_SEQ).cast("long").alias("seq"), "index", "id", F.lit(INDEX).alias("op"), "source"
    )


def _named(ops: DataFrame, snapshot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents the log names, and the others, however many keys it names."""
    keys = checked_broadcast(ops.select(*KEY).distinct())
    return snapshot.join(keys, KEY, "left_semi"), snapshot.join(keys, KEY, "left_anti")


def index_last_wins(ops: DataFrame) -> DataFrame:
    """Each key's last index operation. Combined before the shuffle, so repeated keys cost nothing."""
    last = F.max_by(F.struct("seq", "source"), "seq").alias("last")
    return ops.where(F.col("op") == INDEX).groupBy(*KEY).agg(last).select(*KEY, "last.*")


def hot_documents(ops: DataFrame, hot_rows: int | None = None) -> HotKeys:
    """The keys with so many operations that ``outcomes`` and ``apply_changes`` should split them."""
    return find_hot_keys(ops, KEY, hot_rows)


def _previous_state(ops: DataFrame, hot: HotKeys) -> DataFrame:
    """Adds ``_previous``: the key's last non-update operation before each row."""
    changing = F.when(F.col("op") != UPDATE, F.col("op"))
    if not hot:
        before = Window.partitionBy(*KEY).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        return ops.withColumn("_previous", F.last(changing, ignorenulls=True).over(before))
    split = with_segments(ops, hot, "seq")
    by_segment = [*KEY, SEGMENT]
    inside = Window.partitionBy(*by_segment).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*KEY).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        split.where(hot.flag())
        .groupBy(*by_segment)
        .agg(F.max_by("op", F.when(F.col("op") != UPDATE, F.col("seq"))).alias("_op"))
        .withColumn("_carried", F.last("_op", ignorenulls=True).over(earlier))
    )
    rows = split.withColumn("_inside", F.last(changing, ignorenulls=True).over(inside))
    return (
        join_summary(rows, carried, by_segment, ["_carried"])
        .withColumn("_previous", F.coalesce("_inside", "_carried"))
        .drop(SEGMENT, "_inside", "_carried")
    )


def outcomes(ops: DataFrame, snapshot: DataFrame | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Every operation with its ``outcome``: ok, conflict (create of a live id) or missing (update of none).

    Deleting a missing id is ok. ``hot`` saves the search for hot keys when it is known.
    """
    live = F.coalesce(F.col("_previous") != DELETE, F.lit(False))
    outcome = (
        F.when((F.col("op") == CREATE) & live, CONFLICT)
        .when((F.col("op") == UPDATE) & ~live, MISSING)
        .otherwise(OK)
    )
    rows = ops
    if snapshot is not None:
        rows = snapshot_operations(_named(ops, snapshot)[0]).unionByName(ops, allowMissingColumns=True)
    states = _previous_state(rows, hot_documents(rows) if hot is None else hot)
    return states.where(F.col("seq") != SNAPSHOT_SEQ).withColumn("outcome", outcome).drop("_previous")


def failure_counts(judged: DataFrame) -> DataFrame:
    """One row: submitted, succeeded, failed, and the failures by kind."""
    return judged.agg(
        F.count("*").alias("submitted"),
        F.count_if(F.col("outcome") == OK).alias("succeeded"),
        F.count_if(F.col("outcome") != OK).alias("failed"),
        F.count_if(F.col("outcome") == CONFLICT).alias("conflicts"),
        F.count_if(F.col("outcome") == MISSING).alias("missing"),
    )


def ensure_no_failures(judged: DataFrame, fail_on_error: bool = True) -> DataFrame:
    """The operations unchanged; raises when any failed, before anything is written."""
    counts = failure_counts(judged).first()
    if fail_on_error and counts["failed"]:
        raise BulkFailedError(
            f"bulk failed: n = {counts['failed']}, conflicts = {counts['conflicts']}, missing = {counts['missing']}"
        )
    return judged


def created(judged: DataFrame) -> DataFrame:
    """The create operations that took effect."""
    return judged.where((F.col("op") == CREATE) & (F.col("outcome") == OK))


def _barrier(seq_op: Column, first_create: Column) -> tuple[Column, Column]:
    """Barrier seq and whether the key is live at the end, from the last index or delete and
    the first create after it (any later create fails)."""
    replaced = F.coalesce(seq_op["op"] == INDEX, F.lit(False))
    bar = F.when(replaced, seq_op["seq"]).otherwise(F.coalesce(first_create, seq_op["seq"]))
    return bar, replaced | first_create.isNotNull()


def _replacing() -> Column:
    return F.when(F.col("op").isin(INDEX, DELETE), F.struct("seq", "op"))


def _create_after(last: Column) -> Column:
    after = last.isNull() | (F.col("seq") > last["seq"])
    return F.when((F.col("op") == CREATE) & after, F.col("seq"))


def _barriers_by_window(ops: DataFrame) -> DataFrame:
    key = Window.partitionBy(*KEY)
    bar, live = _barrier(F.col("_last"), F.col("_create"))
    return (
        ops.withColumn("_last", F.max(_replacing()).over(key))
        .withColumn("_create", F.min(_create_after(F.col("_last"))).over(key))
        .withColumn("last_seq", F.max("seq").over(key))
        .withColumn("_bar", bar)
        .withColumn("_live", live)
        .drop("_last", "_create")
    )


def _barriers_by_aggregate(ops: DataFrame, hot: HotKeys) -> DataFrame:
    """The same columns for hot keys: partial aggregates only, and joins with one row per hot key."""
    rows = ops.where(hot.flag())
    last = rows.groupBy(*KEY).agg(F.max(_replacing()).alias("_last"), F.max("seq").alias("last_seq"))
    creates = join_summary(rows.where(F.col("op") == CREATE).select(*KEY, "seq", "op"), last, KEY, ["_last"])
    first = creates.groupBy(*KEY).agg(F.min(_create_after(F.col("_last"))).alias("_create"))
    bar, live = _barrier(F.col("_last"), F.col("_create"))
    known = (
        join_summary(last, first, KEY, ["_create"])
        .withColumn("_bar", bar)
        .withColumn("_live", live)
    )
    return join_summary(rows, known, KEY, ["last_seq", "_bar", "_live"])


def apply_changes(
    ops: DataFrame,
    snapshot: DataFrame | None = None,
    keep_deleted: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The documents after all operations: ``index, id, last_seq, source``.

    One shuffle on the key serves the barrier, the field merge and the assembly of
    the document. Hot keys skip the window and merge through partial aggregates.
    Documents of the snapshot that the log does not name are passed on as they
    are, with ``last_seq`` -1. With ``keep_deleted`` keys that end without a document
    stay as rows with ``deleted`` true and an empty source.
    """
    ops = ops.select(*OPERATION)
    if snapshot is None:
        return _fold(ops, keep_deleted, hot)
    named, others = _named(ops, snapshot)
    folded = _fold(snapshot_operations(named).unionByName(ops), keep_deleted, hot)
    constants = {"last_seq": F.lit(SNAPSHOT_SEQ).cast("long"), "deleted": F.lit(False)}
    return folded.unionByName(others.withColumns(constants).select(*folded.columns))


def _fold(rows: DataFrame, keep_deleted: bool, hot: HotKeys | None) -> DataFrame:
    hot = hot_documents(rows) if hot is None else hot
    if hot:
        judged = _barriers_by_window(rows.where(~hot.flag())).unionByName(_barriers_by_aggregate(rows, hot))
    else:
        judged = _barriers_by_window(rows)
    kept = (F.col("seq") == F.col("_bar")) | ((F.col("op") == UPDATE) & (F.col("seq") > F.col("_bar")))
    if keep_deleted:
        kept = F.when(F.col("_live"), kept).otherwise(F.col("seq") == F.col("last_seq"))
    else:
        kept = F.col("_live") & kept
    source = F.when(F.col("_live"), F.col("source"))
    merged = merge_fields(
        judged.where(kept).select(*KEY, "seq", source.alias("source"), "last_seq", (~F.col("_live")).alias("deleted")),
        carry=["last_seq", "deleted"],
    )
    return merged if keep_deleted else merged.drop("deleted")


def merge_fields(rows: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Each key's sources merged field by field, the highest seq first.

    A key whose sources are all empty keeps its row. ``carry`` columns are constant per key.
    """
    fields = rows.select(*KEY, "seq", *carry, F.explode_outer("source").alias("field", "value"))
    latest = fields.groupBy(*KEY, "field").agg(
        F.max_by("value", "seq").alias("value"), *[F.first(c).alias(c) for c in carry]
    )
    entry = F.when(F.col("field").isNotNull(), F.struct("field", "value"))
    return latest.groupBy(*KEY).agg(
        *[F.first(c).alias(c) for c in carry],
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("source"),
    ).select(*KEY, *carry, "source")


def delete_by_id(docs: DataFrame, deletes: DataFrame) -> DataFrame:
    """The documents whose key is not among ``deletes``; ids that do not exist are ignored."""
    return docs.join(checked_broadcast(deletes.select(*KEY).distinct()), KEY, "left_anti")


def enabled_only(ops: DataFrame, definitions: DataFrame) -> DataFrame:
    """The operations on enabled definitions; those on disabled or unknown ones do nothing."""
    enabled = definitions.where("enabled").select("index").distinct()
    return ops.join(checked_broadcast(enabled), "index", "left_semi")


def update_with_upsert(docs: DataFrame, updates: DataFrame) -> DataFrame:
    """Partial updates (``seq, index, id, doc, upsert``) that insert when the document is missing.

    On a live document every ``doc`` is merged. On a missing one the first request
    inserts its ``upsert`` and later ones merge their ``doc``. A field's latest
    value counts unless it comes from that first request, so the updates of a key
    are reduced to one row per field before anything is joined.
    """
    fields = updates.select(*KEY, "seq", F.explode("doc").alias("field", "value"))
    latest = fields.groupBy(*KEY, "field").agg(F.max_by(F.struct("value", "seq"), "seq").alias("v"))
    firsts = updates.groupBy(*KEY).agg(F.min_by(F.struct("seq", "upsert"), "seq").alias("first"))
    known = docs.select(*KEY, F.col("source").alias("base"), F.lit(True).alias("live"))
    starts = (
        known.join(firsts, KEY, "full_outer")
        .select(
            *KEY,
            F.coalesce("live", F.lit(False)).alias("live"),
            F.col("first.seq").alias("first_seq"),
            F.coalesce("base", "first.upsert").alias("source"),
        )
    )
    changes = (
        latest.select(*KEY, "field", "v.*")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("field", "value", "seq")).alias("changes"))
    )
    return (
        starts.join(changes, KEY, "left")
        .withColumn(
            "changes",
            F.filter(
                F.coalesce("changes", F.array().cast("array<struct<field:string,value:string,seq:bigint>>")),
                lambda c: F.col("live") | (c["seq"] > F.col("first_seq")),
            ),
        )
        .withColumn(
            "changes", F.map_from_entries(F.transform("changes", lambda c: F.struct(c["field"], c["value"])))
        )
        .withColumn("source", overlay(F.col("source"), F.col("changes")))
        .select(*KEY, "live", "source")
    )


def overlay(base: Column, changes: Column) -> Column:
    """Map ``base`` with the entries of ``changes`` put over it."""
    untouched = F.map_filter(base, lambda k, _: ~F.map_contains_key(changes, k))
    return F.map_concat(untouched, changes)
