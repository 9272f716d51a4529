"""Helpers that keep every task's share bounded when a few keys hold most rows.

A window over ``partitionBy(key)`` puts all rows of one key into one task. The
helpers here find the keys for which that is too much, cut only those keys into
ordered segments, and carry the running state from segment to segment through a
summary that has one row per (hot key, segment).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, TimestampType

BROADCAST_ROWS = 200_000
HOT_ROWS = 1_000_000
# However few partitions there are, a key or a range with more rows than this is cut.
MOST_HOT_ROWS = 16_000_000
RANGE_ROWS = 2_000_000
SEGMENT = "_segment"
MAX_SEGMENTS = 10_000


def bounded_rows(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> list | None:
    """The rows of ``df`` on the driver, or None when there are more than ``max_rows``.

    The limit is taken partition by partition, so a large frame is given up early.
    """
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str | StructType) -> DataFrame:
    """A small frame of driver-side rows as a local relation, planned without a job of its own."""
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if any(isinstance(field.dataType, TimestampType) for field in kinds):
        return spark.createDataFrame(list(rows), kinds)  # keeps the session's time zone
    columns = list(zip(*rows)) or [()] * len(kinds)
    arrow = to_arrow_schema(kinds)
    table = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, kinds)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else ``df`` unchanged.

    The check reads one row more than the bound; a side that passes is kept as a
    local relation, so it is not computed a second time by the join.
    """
    rows = bounded_rows(df, max_rows)
    return df if rows is None else F.broadcast(local_frame(df.sparkSession, rows, df.schema))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the keys that hold more rows than one task should take."""

    keys: tuple[str, ...]
    hashes: tuple[int, ...]

    def __bool__(self) -> bool:
        return bool(self.hashes)

    def flag(self) -> Column:
        return F.xxhash64(*self.keys).isin(list(self.hashes))


def find_hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> HotKeys:
    """Keys with more than ``hot_rows`` rows, from one pass with mergeable sketches.

    The default limit is an average shuffle partition, at least one million rows.
    Keys are spread over several sketches so that no single task merges them all;
    each is wide enough to hold every key that can exceed its share. The sketches
    only choose the plan: results are the same whichever keys they find.
    """
    parts = partitions(df)
    sketches = min(128, max(1, parts // 32))
    kept = max(64, 2 * parts // sketches)
    found = (
        df.select(F.xxhash64(*keys).alias("h"))
        .groupBy(F.pmod("h", F.lit(sketches)).alias("sketch"))
        .agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {kept}, {4 * kept})").alias("top"))
        .collect()
    )
    if hot_rows is None:
        hot_rows = min(max(HOT_ROWS, sum(row["n"] for row in found) // max(parts, 1)), MOST_HOT_ROWS)
    hashes = tuple(item["item"] for row in found for item in row["top"] if item["count"] > hot_rows)
    return HotKeys(tuple(keys), hashes)


def order_columns(order: Sequence[str]) -> list[Column]:
    """Sort columns for names in ``order``; a leading ``-`` means descending, nulls last."""
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def _order_names(order: Sequence[str]) -> list[str]:
    return [o.removeprefix("-") for o in order]


def order_bounds(df: DataFrame, order: Sequence[str], parts: int) -> list[tuple]:
    """Ascending cut points that split ``order`` evenly: ``parts - 1``, or more where a
    range would have more than ``RANGE_ROWS`` rows.

    The cut points are quantiles of a sample by hash, some sixteen values per part
    whatever the size of the frame; a retry or a second pass finds the same sample.
    """
    names = _order_names(order)
    rows = df.count()
    parts = min(max(parts, rows // RANGE_ROWS), MAX_SEGMENTS)
    scale = 1 << 40
    share = min(scale, scale * parts * 16 // max(rows, 1) + 1)
    chosen = F.pmod(F.xxhash64(*names), F.lit(scale)) < share
    sample = df.select(*names).where(chosen).distinct()
    ranked = [tuple(row) for row in sample.orderBy(*order_columns(order)).collect()]
    picks = {len(ranked) * i // parts for i in range(1, parts)}
    bounds = [ranked[i] for i in sorted(picks) if 0 < i < len(ranked)]
    # Later columns only matter where the leading ones repeat.
    for width in range(1, len(names)):
        if len({bound[:width] for bound in bounds}) == len(bounds):
            return [bound[:width] for bound in bounds]
    return bounds


def _constant(schema: StructType, name: str, value) -> Column:
    text = str(value) if isinstance(value, (date, datetime)) else value
    return F.lit(text).cast(schema[name].dataType)


def segment_of(schema: StructType, order: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """How many of ``bounds`` are at or before the row, by binary search in a constant array."""
    if not bounds:
        return F.lit(0)
    names = _order_names(order)[: len(bounds[0])]

    def earlier(spec: str, mark: Column, value: Column) -> Column:
        if spec.startswith("-"):
            return F.coalesce(mark > value, mark.isNotNull() & value.isNull())
        return F.coalesce(mark < value, mark.isNull() & value.isNotNull())

    if len(names) == 1 and all(bound[0] is not None for bound in bounds):
        array = F.array(*[_constant(schema, names[0], bound[0]) for bound in bounds])
        value = F.col(names[0])

        def at_or_before(mark: Column) -> Column:
            return (value <= mark) | value.isNull() if order[0].startswith("-") else value >= mark

    else:
        array = F.array(
            *[F.struct(*[_constant(schema, n, v).alias(n) for n, v in zip(names, bound)]) for bound in bounds]
        )

        def at_or_before(bound: Column) -> Column:
            result = F.lit(True)
            for spec, name in reversed(list(zip(order, names))):
                mark, value = bound[name], F.col(name)
                result = earlier(spec, mark, value) | (mark.eqNullSafe(value) & result)
            return result

    count = len(bounds)
    steps = [1 << i for i in range(count.bit_length() - 1, -1, -1)]

    def step_right(at: Column, step: Column) -> Column:
        inside = at + step <= count
        return F.when(inside & at_or_before(F.try_element_at(array, at + step)), at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step_right)


def segments_between(
    schema: StructType, order: Sequence[str], bounds: Sequence[tuple], first: int, last: int
) -> Column | None:
    """A plain comparison that holds for the rows of segments ``first`` to ``last``.

    None unless the bounds are on one column; such a comparison can be pushed into the scan.
    """
    if bounds and (len(bounds[0]) > 1 or any(bound[0] is None for bound in bounds)):
        return None
    name, descending = _order_names(order)[0], order[0].startswith("-")
    value = F.col(name)
    low = _constant(schema, name, bounds[first - 1][0]) if first > 0 else None
    high = _constant(schema, name, bounds[last][0]) if last < len(bounds) else None
    kept = F.lit(True)
    if low is not None:
        kept = kept & (value <= low if descending else value >= low)
    if high is not None:
        kept = kept & (value > high if descending else value < high)
    # Nulls are at the end in descending order, else at the beginning.
    open_end = high if descending else low
    return kept | value.isNull() if open_end is None else kept


def with_segments(df: DataFrame, hot: HotKeys, order: str, parts: int | None = None) -> DataFrame:
    """Adds the segment column: an order range for rows of hot keys, 0 for all others."""
    bounds = order_bounds(df.where(hot.flag()), [order], parts or partitions(df))
    segment = segment_of(df.schema, [order], bounds)
    return df.withColumn(SEGMENT, F.when(hot.flag(), segment).otherwise(F.lit(0)))


def join_summary(df: DataFrame, summary: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join of per-segment ``values``, null-safe on ``keys``; broadcast if it is small."""
    side = checked_broadcast(summary.select(*keys, *values)).alias("s")
    rows = df.alias("r")
    on = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    return rows.join(side, on, "left").select("r.*", *[F.col(f"s.{v}") for v in values])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str, name: str, hot_rows: int | None = None
) -> DataFrame:
    """Row numbers from 1 within each key by ``order``; hot keys are numbered in segments."""
    hot = find_hot_keys(df, keys, hot_rows)
    if not hot:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("long"))
    split = with_segments(df, hot, order)
    by_segment = [*keys, SEGMENT]
    sizes = split.where(hot.flag()).groupBy(*by_segment).agg(F.count("*").alias("_size"))
    # One row per (hot key, segment), however many rows the key has.
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.sum("_size").over(earlier))
    inside = F.row_number().over(Window.partitionBy(*by_segment).orderBy(order))
    return (
        join_summary(split.withColumn("_inside", inside), offsets, by_segment, ["_before"])
        .withColumn(name, F.col("_inside") + F.coalesce("_before", F.lit(0).cast("long")))
        .drop(SEGMENT, "_inside", "_before")
    )


class OrderedRanges:
    """A frame cut into ordered ranges of about equal size, with the number of rows before each.

    Only the cut points and one count per range come to the driver; both are
    bounded by ``parts``. ``order`` must identify a row for positions to be stable.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], parts: int | None = None):
        self.order = list(order)
        self.frame = df
        self.bounds = bounds = order_bounds(df, order, parts or partitions(df))
        self.rows = df.withColumn(SEGMENT, segment_of(df.schema, order, bounds))
        counted = self.rows.groupBy(SEGMENT).agg(F.count("*").alias("n")).collect()
        sizes = {row[SEGMENT]: row["n"] for row in counted}
        self.before = [0]
        for segment in range(len(bounds) + 1):
            self.before.append(self.before[-1] + sizes.get(segment, 0))

    @property
    def total(self) -> int:
        return self.before[-1]

    def numbered(self, name: str, rows: DataFrame | None = None) -> DataFrame:
        """Row numbers from 1 in ``order``; each range is sorted on its own."""
        inside = F.row_number().over(Window.partitionBy(SEGMENT).orderBy(*order_columns(self.order)))
        offsets = F.array(*[F.lit(b).cast("long") for b in self.before])
        position = inside + F.element_at(offsets, F.col(SEGMENT) + 1)
        return (self.rows if rows is None else rows).withColumn(name, position).drop(SEGMENT)

    def _overlapping(self, start: int, end: int) -> list[int]:
        """The ranges that hold positions start + 1 to end."""
        return [s for s in range(len(self.before) - 1) if self.before[s] < end and self.before[s + 1] > start]

    def rows_between(self, start: int, end: int, name: str) -> DataFrame:
        """Numbered rows at positions start + 1 to end; only the ranges they lie in are sorted."""
        overlapping = self._overlapping(start, end)
        if not overlapping:
            return self.numbered(name, self.rows.limit(0))
        frame = self.frame
        kept = segments_between(frame.schema, self.order, self.bounds, overlapping[0], overlapping[-1])
        if kept is not None and len(overlapping) == 1:
            rows = frame.where(kept).withColumn(SEGMENT, F.lit(overlapping[0]))
        else:
            rows = (self.rows if kept is None else self.rows.where(kept)).where(F.col(SEGMENT).isin(overlapping))
        return self.numbered(name, rows).where((F.col(name) > start) & (F.col(name) <= end))

    def holding(self, frame: DataFrame, start: int, end: int) -> tuple[DataFrame, int, int]:
        """Rows of ``frame`` in the ranges that hold positions start + 1 to end, how many lie before, and how many they are.

        ``frame`` has the rows that were cut, with more columns than were needed for it.
        """
        overlapping = self._overlapping(start, end)
        if not overlapping:
            return frame.limit(0), self.total, 0
        first, last = overlapping[0], overlapping[-1]
        kept = segments_between(frame.schema, self.order, self.bounds, first, last)
        if kept is None:
            kept = segment_of(frame.schema, self.order, self.bounds).between(first, last)
        return frame.where(kept), self.before[first], self.before[last + 1] - self.before[first]
