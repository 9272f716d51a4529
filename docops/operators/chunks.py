"""Splitting a writer's operations into bulk requests, by count or by volume."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docops.plans.skew import SEGMENT, find_hot_keys, join_summary, number_rows, with_segments
from docops.session import scratch_path

# Tasks receive this module's functions by value: workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Default limits of one request (-1 means no limit), volume in bytes.
MAX_ACTIONS = -1
MIN_VOLUME = 1024
MAX_VOLUME = 1024 * 1024


def chunk_by_count(
    df: DataFrame, writer: str, seq: str, max_actions: int = MAX_ACTIONS, hot_rows: int | None = None
) -> DataFrame:
    """Adds ``batch``: requests of ``max_actions`` operations, numbered from 0 per writer."""
    if max_actions == -1:
        return df.withColumn("batch", F.lit(0).cast("long"))
    numbered = number_rows(df, [writer], seq, "_position", hot_rows)
    batch = F.call_function("div", F.col("_position") - 1, F.lit(max_actions).cast("long"))
    return numbered.withColumn("batch", batch).drop("_position")


def chunk_by_volume(
    df: DataFrame, writer: str, seq: str, size: str, limit: int = MAX_VOLUME, hot_rows: int | None = None
) -> DataFrame:
    """Adds ``batch``: a request closes after the operation that brings it to ``limit`` bytes."""
    return chunk(df, writer, seq, size, -1, limit, hot_rows)


def chunk(
    df: DataFrame,
    writer: str,
    seq: str,
    size: str,
    max_actions: int = MAX_ACTIONS,
    max_volume: int = MAX_VOLUME,
    hot_rows: int | None = None,
) -> DataFrame:
    """Adds ``batch``: a request closes at ``max_actions`` operations or ``max_volume`` bytes, whichever is first.

    Each writer is a running sum that starts over, streamed through sorted
    partitions. A writer with too many operations for one task is cut into
    segments: every segment first lists how it ends for each way it may start,
    these lists are composed in a tree of pairs, and then all segments are
    numbered at once from their known start.
    """
    if max_volume == -1:
        return chunk_by_count(df, writer, seq, max_actions, hot_rows)
    limits = Limits(max_actions if max_actions != -1 else NO_LIMIT, max_volume)
    hot = find_hot_keys(df, [writer], hot_rows)
    if hot:
        rows = with_segments(df, hot, seq)
        starts = _segment_starts(rows.where(hot.flag()), writer, seq, size, limits)
        rows = join_summary(rows, starts, [writer, SEGMENT], _STATE)
    else:
        rows = df.select("*", F.lit(0).alias(SEGMENT), *[F.lit(0).alias(c) for c in _STATE])
    numbered = StructType([*df.schema.fields, StructField("batch", LongType())])
    names = df.columns
    return (
        rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in _STATE})
        .repartition(writer, SEGMENT)
        .sortWithinPartitions(writer, SEGMENT, seq)
        .mapInArrow(lambda batches: _number(batches, names, writer, size, limits), numbered)
    )


NO_LIMIT = 1 << 62


class Limits(NamedTuple):
    actions: int
    volume: int


# Where a segment starts: bytes and operations in the open request, requests closed before.
_STATE = ["_fill", "_held", "_closed"]


def _closing_positions(sizes: np.ndarray, fill: int, held: int, limits: Limits) -> tuple[list[int], int, int]:
    """Positions after which a request closes, and the bytes and operations left open at the end."""
    total = np.cumsum(sizes)
    count = len(sizes)
    closed: list[int] = []
    spent, begin = -fill, -held
    while True:
        at = min(int(np.searchsorted(total, spent + limits.volume)), begin + limits.actions - 1)
        if at >= count:
            return closed, int((total[-1] if count else 0) - spent), count - begin
        closed.append(at)
        spent, begin = int(total[at]), at + 1


def _run_starts(columns: list[pa.Array]) -> np.ndarray:
    """Positions at which the values of ``columns`` differ from the row before; the first row counts."""
    rows = len(columns[0])
    changed = np.zeros(rows, dtype=bool)
    changed[:1] = True
    for column in columns:
        before, after = column.slice(0, rows - 1), column.slice(1)
        differs = pc.fill_null(pc.not_equal(before, after), False)
        null_flip = pc.not_equal(pc.is_null(before), pc.is_null(after))
        changed[1:] |= pc.or_(differs, null_flip).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def _number(
    batches: Iterator[pa.RecordBatch], names: list[str], writer: str, size: str, limits: Limits
) -> Iterator[pa.RecordBatch]:
    current, fill, held, done = None, 0, 0, 0
    for rows in batches:
        if not rows.num_rows:
            continue
        writers, segments = rows.column(writer), rows.column(SEGMENT)
        sizes = pc.fill_null(rows.column(size).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        numbers = np.empty(rows.num_rows, dtype="int64")
        starts = _run_starts([writers, segments])
        for begin, end in zip(starts, [*starts[1:], rows.num_rows]):
            key = (writers[int(begin)].as_py(), segments[int(begin)].as_py())
            if key != current:
                current = key
                fill, held, done = (rows.column(c)[int(begin)].as_py() for c in _STATE)
            closed, fill, held = _closing_positions(sizes[begin:end], fill, held, limits)
            numbers[begin:end] = done + np.searchsorted(closed, np.arange(end - begin))
            done += len(closed)
        yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), pa.array(numbers)], [*names, "batch"])


_ENDINGS = ["_position", "_least", "_closes", "_left", "_kept"]


def _segment_endings(sizes: np.ndarray, limits: Limits) -> pd.DataFrame:
    """How a segment ends: one row per position that may be the first to close a request.

    ``least`` is the smallest fill with which the position closes by volume. What
    follows it (requests closed, bytes and operations left open) no longer depends
    on the start. Neighbours with the same ending are one row, at the last of them.
    A final row at the length of the segment stands for starts that close nothing.
    """
    count = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])
    # From an empty request at position i, the next request starts at follow[i].
    by_volume = np.searchsorted(total[1:], total[:-1] + limits.volume) + 1
    follow = np.minimum(by_volume, np.arange(count) + limits.actions)
    closes, left, kept = (np.zeros(count + 1, dtype="int64") for _ in range(3))
    for i in range(count - 1, -1, -1):
        if follow[i] > count:
            left[i], kept[i] = total[count] - total[i], count - i
        else:
            closes[i], left[i], kept[i] = closes[follow[i]] + 1, left[follow[i]], kept[follow[i]]
    rows: list[tuple] = []
    for p in range(min(int(follow[0]) if count else 0, count)):
        ending = (int(closes[p + 1]) + 1, int(left[p + 1]), int(kept[p + 1]))
        if rows and rows[-1][2:] == ending:
            rows.pop()
        rows.append((p, int(limits.volume - total[p + 1]), *ending))
    rows.append((count, 0, 0, int(total[count]), count))
    return pd.DataFrame(rows, columns=_ENDINGS)


class Endings(NamedTuple):
    """How a run of operations ends for every start: the closing positions of ``_segment_endings``, and its size."""

    position: np.ndarray
    least: np.ndarray
    closes: np.ndarray
    left: np.ndarray
    kept: np.ndarray
    count: int
    total: int

    def first(self, fill, held, limits: Limits):
        """The closing position for each start; the number of positions, where none closes."""
        # Both conditions hold from some position on: fills needed fall, operations rise.
        by_volume = np.searchsorted(-self.least, -np.asarray(fill), side="left")
        by_count = np.searchsorted(self.position, limits.actions - np.asarray(held) - 1, side="left")
        return np.minimum(by_volume, by_count)

    def after(self, state: tuple[int, int, int], limits: Limits) -> tuple[int, int, int]:
        """The state (fill, held, closed) behind the run."""
        fill, held, closed = state
        at = int(self.first(fill, held, limits))
        if at == len(self.position):
            return fill + self.total, held + self.count, closed
        return int(self.left[at]), int(self.kept[at]), closed + int(self.closes[at])

    def then(self, other: Endings, limits: Limits) -> Endings:
        """This run followed by ``other``, no larger than the operations of one request."""
        at = other.first(self.left, self.kept, limits)
        none = at == len(other.position)
        closes, left, kept = self.closes.copy(), self.left + other.total, self.kept + other.count
        closes[~none] += other.closes[at[~none]]
        left[~none], kept[~none] = other.left[at[~none]], other.kept[at[~none]]
        columns = [self.position, self.least, closes, left, kept]
        if int(self.first(0, 0, limits)) == len(self.position):  # some starts close nothing here
            shifted = (other.position + self.count, other.least - self.total, other.closes, other.left, other.kept)
            columns = [np.concatenate(pair) for pair in zip(columns, shifted)]
        # Neighbours with the same ending are one, at the last of them.
        ending = np.stack(columns[2:])
        last = np.append((ending[:, 1:] != ending[:, :-1]).any(axis=0), True)[: len(columns[0])]
        return Endings(*[c[last] for c in columns], self.count + other.count, self.total + other.total)


_LISTS = ["position", "least", "closes", "left", "kept"]
_NODE = f"{SEGMENT} int, {', '.join(f'_{c} array<long>' for c in _LISTS)}, _count long, _total long"


def _endings_of(row) -> Endings:
    lists = [np.asarray(row[f"_{c}"], dtype="int64") for c in _LISTS]
    return Endings(*lists, int(row["_count"]), int(row["_total"]))


def _node(writer: str, name, segment: int, endings: Endings) -> pd.DataFrame:
    values = {f"_{c}": [v.tolist()] for c, v in zip(_LISTS, endings)}
    return pd.DataFrame({writer: [name], SEGMENT: [segment], **values, "_count": endings.count, "_total": endings.total})


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _segment_starts(rows: DataFrame, writer: str, seq: str, size: str, limits: Limits) -> DataFrame:
    """For every segment of a hot writer, the state it starts in.

    The endings of neighbouring segments are composed pairwise until each writer has one;
    then the states are read back down, a pair at a time. A task has one pair, and a list
    of endings is no longer than one request, so no task sees a writer.
    """
    key = f"`{writer}` {rows.schema[writer].dataType.simpleString()}"

    def segment(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame.sort_values(seq)[size].fillna(0).to_numpy(dtype="int64")
        table = _segment_endings(sizes, limits).iloc[:-1]
        lists = [table[c].to_numpy(dtype="int64") for c in _ENDINGS]
        return _node(writer, key[0], key[1], Endings(*lists, len(sizes), int(sizes.sum())))

    def pair(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        halves = [_endings_of(row) for _, row in frame.sort_values(SEGMENT).iterrows()]
        return _node(writer, key[0], key[1], halves[0] if len(halves) == 1 else halves[0].then(halves[1], limits))

    def halves(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        found, state = [], None
        for _, row in frame.sort_values("_half").iterrows():
            state = tuple(int(row[c]) for c in _STATE) if state is None else _endings_of(before).after(state, limits)
            found.append((key[0], row["_half"], *state))
            before = row
        return pd.DataFrame(found, columns=[writer, SEGMENT, *_STATE])

    sized = rows.select(writer, SEGMENT, seq, size).groupBy(writer, SEGMENT).applyInPandas(segment, f"{key}, {_NODE}")
    levels = [_written(sized, "segments")]
    for _ in range((levels[0].agg(F.max(SEGMENT)).first()[0] or 0).bit_length()):
        parents = levels[-1].groupBy(writer, (F.col(SEGMENT) / 2).cast("int").alias("_parent"))
        levels.append(_written(parents.applyInPandas(pair, f"{key}, {_NODE}"), "segments"))
    starts = levels.pop().select(writer, SEGMENT, *[F.lit(0).cast("long").alias(c) for c in _STATE])
    for level in reversed(levels):
        below = level.withColumn("_half", F.col(SEGMENT)).withColumn(SEGMENT, (F.col(SEGMENT) / 2).cast("int"))
        placed = join_summary(below, starts, [writer, SEGMENT], _STATE).groupBy(writer, SEGMENT)
        schema = f"{key}, {SEGMENT} int, {', '.join(f'{c} long' for c in _STATE)}"
        starts = _written(placed.applyInPandas(halves, schema), "segments")
    return starts
