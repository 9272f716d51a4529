"""Exact top-k inner products from an impact-ordered index, one quantised level at a time.

Vectors are cut into blocks. The index of a block holds, for each dimension and sign,
the postings of one impact level after the other: the vectors whose component has that
many quanta. Queries go through the segments by descending impact and add level times
query weight to accumulators. What is left of a vector after a level has a known norm,
so its score lies within that norm times the query's of the accumulator. A block stops
early only when these bounds leave few possible members for every query; in any case
exactly the vectors that the bounds cannot exclude are scored again with full integers.
What a query has found in one block of a task is a bound for the next block.

Blocks are dealt to groups and query chunks to slices; each group meets each slice in one
partition. Chunks are copied to the groups by a shuffle, never by way of the driver. A task
holds one group, of bounded bytes, and reads one chunk after the other.

* Vectors that are null or hold a null or non-finite component take no part, nor do rows
  without id. Components of any finite size are exact: where 64 bits could overflow, a block
  is scored against a query chunk with integers of any size and without an index. A score
  beyond a long is given as the largest or smallest long.
* Only vectors of equal length are compared; two empty vectors score 0.
* Of rows that repeat a query's id, the smallest vector is the query, and none is a candidate.
* Every other row is a candidate of its own, repeated ones too; ties go to the smaller id.
* Tables with no vector or no query give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docops.llm.common import stored, table, whole_quanta
from docops.plans.skew import local_frame, partitions

BLOCK = 4096
QUERIES_AT_ONCE = 256
#: Quanta of a level, as a power of two.
SHIFT = 3
#: A block stops before its last level when no query has more possible members than this.
FEW = 64
#: A task holds the blocks of a group of about this size.
GROUP_BYTES = 1 << 25
K = 5
SCALE = 256
_LONG = (1 << 63) - 1
#: Larger components are Python's integers.
_SMALL = 1 << 62
_BLOB = "part int, start long, size long, length int, ids binary, kind string, vectors binary"


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with components as doubles; rows that take no part are left out."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )


def _blobs(size: int):
    """Arrow batches of (vec_id, v) to rows that each hold up to ``size`` vectors of one length.

    ``start`` counts the bytes of the task's rows before.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start, waiting = TaskContext.get().partitionId(), 0, {}

        def blob(length, ids, rows):
            nonlocal start
            values = whole_quanta(np.array(rows, dtype=np.float64).reshape(len(ids), length), SCALE, _SMALL)
            if values.dtype != object and np.abs(values).max(initial=0) < 1 << 15:
                values = values.astype(np.int16)
            kind = "text" if values.dtype == object else values.dtype.name
            data = json.dumps(values.tolist()).encode() if kind == "text" else values.tobytes()
            names = np.array(ids, dtype=np.int64).tobytes()
            columns = [[part], [start], [len(names) + len(data)], [length], [names], [kind], [data]]
            start += len(names) + len(data)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "start", "size", "length", "ids", "kind", "vectors"])

        for batch in batches:
            for vec, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, rows = waiting.setdefault(len(v), ([], []))
                ids.append(vec)
                rows.append(v)
                if len(ids) == size:
                    yield blob(len(v), *waiting.pop(len(v)))
        for length in sorted(waiting):
            yield blob(length, *waiting[length])

    return pack


class ImpactIndex:
    """Posting segments of a block by level, and the norms that stay after each level."""

    def __init__(self, vectors: np.ndarray):
        self.count = len(vectors)
        place = np.min_scalar_type(len(vectors))
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        levels = np.abs(vectors) >> SHIFT
        # Rare large impacts share one top level, whose quanta are those of its smallest member.
        top = int(min(levels.max(initial=0), 64))
        levels = np.minimum(levels, top)
        whole = np.sign(vectors) * (levels << SHIFT)
        self.segments: list[list[tuple[int, int, np.ndarray]]] = []
        self.left: list[np.ndarray | None] = []  # where bounds are looked at: after every fourth level and the last
        done = np.zeros_like(vectors)
        for level in range(top, 0, -1):
            at = []
            for dim in range(vectors.shape[1]):
                hit = levels[:, dim] == level
                for sign in (1, -1):
                    members = np.flatnonzero(hit & (np.sign(vectors[:, dim]) == sign))
                    if len(members):
                        at.append((dim, sign * (level << SHIFT), members.astype(place)))
            mask = levels == level
            done[mask] = whole[mask]
            looked = level == 1 or len(self.segments) % 4 == 3
            self.segments.append(at)
            self.left.append(np.sqrt(((vectors - done).astype(np.float64) ** 2).sum(axis=1)) if looked else None)
        if not self.segments:
            self.segments, self.left = [[]], [np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))]

    def possible(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> list[np.ndarray]:
        """For each query, the positions that the bounds cannot exclude from its ``k`` best.

        ``floor``: for each query, a score that ``k`` candidates of other blocks have at least.
        """
        weights = queries.T.astype(np.float64)
        norms = np.sqrt((weights**2).sum(axis=0))
        scores = np.zeros((self.count, len(queries)))
        for i, (segments, left) in enumerate(zip(self.segments, self.left)):
            for dim, impact, members in segments:
                scores[members] += impact * weights[dim]
            if left is None:
                continue
            # What is left of a vector, and the error of adding up floats of this size.
            slack = left[:, None] * norms * (1 + 1e-9) + self.norms[:, None] * norms * 1e-9 + 1
            low = np.where(own, -np.inf, scores - slack)
            few = floor
            if len(low) > k:
                few = np.maximum(floor, np.partition(low, len(low) - k, axis=0)[len(low) - k])
            members = (scores + slack >= few) & ~own
            if members.sum(axis=0).max() <= FEW:
                break
        return [np.flatnonzero(members[:, q]) for q in range(len(queries))]


def _matrix(blob: bytes, kind: str, rows: int, length: int) -> np.ndarray:
    if kind == "text":
        return np.array(json.loads(blob), dtype=object).reshape(rows, length)
    return np.frombuffer(blob, kind).reshape(rows, length)


def _whole(numbers: np.ndarray) -> np.ndarray:
    """As 64-bit numbers, where they are not Python's integers."""
    return numbers if numbers.dtype == object else numbers.astype(np.int64, copy=False)


def _largest(numbers: np.ndarray) -> int:
    return int(np.abs(numbers).max()) if numbers.size else 0


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products, the ones beyond a long as the last long."""
    if _largest(vectors) * _largest(query) * len(query) <= _LONG:
        return _whole(vectors) @ _whole(query)
    exact = vectors.astype(object) @ query.astype(object)
    return np.array([max(-_LONG, min(_LONG, int(x))) for x in exact], dtype=np.int64)


class _Block:
    """Vectors of one length and, from the first query chunk that it can serve, their index."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.largest, self.index = _largest(vectors), None

    def possible(self, asked: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> list[np.ndarray]:
        own = self.ids[:, None] == asked[None, :]
        if self.largest * _largest(queries) * queries.shape[1] > _LONG:  # a score might not fit 64 bits
            return [np.flatnonzero(~own[:, q]) for q in range(len(asked))]
        if self.index is None:
            self.index = ImpactIndex(_whole(self.vectors))
        return self.index.possible(_whole(queries), own, k, floor)


def _best(blocks: list[_Block], asked: np.ndarray, queries: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` best of all blocks for each query of a chunk."""
    nothing = np.zeros(0, dtype=np.int64)
    found = [(nothing, nothing)] * len(asked)
    floor = np.full(len(asked), -np.inf)
    for block in blocks:
        for q, members in enumerate(block.possible(asked, queries, k, floor)):
            if not len(members):
                continue
            ids = np.concatenate([found[q][0], block.ids[members]])
            exact = np.concatenate([found[q][1], _scores(block.vectors[members], queries[q])])
            best = np.lexsort((ids, -exact))[:k]
            found[q] = ids[best], exact[best]
            if len(best) == k:
                floor[q] = exact[best[-1]]
    columns = [np.repeat(asked, [len(ids) for ids, _ in found])]
    columns += [np.concatenate([f[i] for f in found]) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def _search(k: int):
    """Rows of a cell, its blocks before its query chunks, to each query's ``k`` best of the cell."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if cell != row["cell"]:
                    cell, blocks = row["cell"], {}
                ids = np.frombuffer(row["ids"], np.int64)
                vectors = _matrix(row["vectors"], row["kind"], len(ids), row["length"])
                if not row["asks"]:
                    blocks.setdefault(row["length"], []).append(_Block(ids, vectors))
                elif row["length"] in blocks:
                    yield _best(blocks[row["length"]], ids, vectors, k)

    return search


def _grid(vector_bytes: int, query_bytes: int, blocks: int, chunks: int, tasks: int) -> tuple[int, int]:
    """Numbers of groups of blocks and of slices of query chunks.

    There are about ``tasks`` cells, fewer if copies would be many times the vectors, and as many
    groups as ``GROUP_BYTES`` asks for. Vectors are copied to the slices and queries to the groups.
    """
    ratio = vector_bytes / max(query_bytes, 1)
    tasks = max(1, min(tasks, max(64, int(4 * ratio))))
    wanted = max(math.ceil(vector_bytes / GROUP_BYTES), round(math.sqrt(tasks * ratio)), 1)
    groups = max(1, min(wanted, blocks))
    return groups, max(1, min(math.ceil(tasks / groups), chunks))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """The ``k`` best candidates of every query: query_id, rank, vec_id, score.

    Blocks and query chunks have bounded sizes; each chunk is sent to every group of blocks,
    which returns at most ``k`` rows for each query, and these are ranked by query.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors)
    # The reader's splits are the blocks' borders: no shuffle before the index is cut.
    blocks = stored(rows.mapInArrow(_blobs(BLOCK), _BLOB), "topk-index")
    sizes = blocks.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    starts, total, count = [], 0, 0
    for part, size, n in sorted(sizes.collect()):  # one row for each split
        starts.append((part, total))
        total, count = total + size, count + n
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    chunks = stored(queries.mapInArrow(_blobs(QUERIES_AT_ONCE), _BLOB), "topk-queries")
    asked = chunks.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("n")).collect()[0]
    groups, slices = _grid(total, asked["size"], count, asked["n"], partitions(vectors))
    packed = ["length", "ids", "kind", "vectors"]
    blocks = blocks.join(F.broadcast(local_frame(spark, starts, "part int, before long")), "part")
    group = F.floor((F.col("before") + F.col("start")) / max(1, -(-total // groups))).cast("int")
    first, step = group * slices, F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int")
    held = F.explode(F.sequence(first, first + slices - 1)).alias("cell")
    asks = F.explode(F.sequence(step, step + (groups - 1) * slices, F.lit(slices))).alias("cell")
    cells = blocks.select(held, F.lit(False).alias("asks"), *packed)
    cells = cells.unionByName(chunks.select(asks, F.lit(True).alias("asks"), *packed))
    cells = cells.repartitionById(groups * slices, "cell").sortWithinPartitions("cell", "asks")
    found = cells.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op10_topk(spark, directory: str) -> DataFrame:
    return exact_top_k(table(spark, directory, "embeddings"), F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

QUERIES = {"op10_topk": op10_topk}
SQL = {"op10_topk": OP10_SQL}
