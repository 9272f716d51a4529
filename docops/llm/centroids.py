"""Exact integer k-means whose distance computations are pruned by a LAESA pivot table.

Vectors are cut into blocks that are written once, each with the distances of its vectors
to a few fixed pivots. In every round the centroids' distances to the pivots are computed;
by the triangle inequality the largest difference to a vector's stored ones bounds its
distance to a centroid from below. The centroid of the least bound gets an exact distance
first, and only centroids whose bound does not exceed it get theirs. Bounds are widened by
the error of their floats, so a pruned centroid is truly farther away, and the result is
that of comparing all centroids.

A round reads the blocks and returns sums of one task's vectors by centroid; these are
added in a tree, so the driver receives at most ``FAN`` rows for each centroid however
large the table is. Centroids are plain integers on the driver, the blocks files in the
shared folder: a lost executor costs only its tasks.

* Vectors take part that have exactly ``DIMENSIONS`` components, none of them null or
  non-finite. Components of any finite size are exact: where 64 bits could overflow, blocks
  are computed with integers of any size.
* A distance or inertia that does not fit a long is null.
* A null id is hashed as if it were empty. Equal ids start in the order of their components.
  Repeated rows are rows of their own.
* With fewer vectors than centroids there are fewer centroids; an empty table gives an empty
  result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docops.llm.common import stored, table, whole_quanta

CLUSTERS = 8
PIVOTS = 16
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
BLOCK = 4096
#: Sums of tasks that meet in one group of the tree, and rows of a centroid that reach the driver.
FAN = 64
#: Larger components are integers of any size.
_SMALL = 1 << 27
_LONG = (1 << 63) - 1
_BLOB = "ids binary, missing binary, vectors binary, wide binary, pivots binary"
_SUMS = "part int, cluster int, n long, sums string, distance string"


def _wide(vectors: np.ndarray, points: np.ndarray) -> bool:
    """True if a squared distance might not fit 64 bits."""
    largest = max((int(abs(a).max()) for a in (vectors, points) if a.size), default=0)
    return 4 * largest**2 * points.shape[-1] > _LONG


def _squares(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of all ``vectors`` to ``point``."""
    if _wide(vectors, point):
        vectors, point = vectors.astype(object), point.astype(object)
    return ((vectors - point) ** 2).sum(axis=1)


def _roots(squares: np.ndarray) -> np.ndarray:
    """Square roots as floats; beyond the largest float, a bound too small to prune by."""
    if squares.dtype == object:
        return np.array([float(min(math.isqrt(x), 1 << 1022)) for x in squares], dtype=np.float64)
    return np.sqrt(squares.astype(np.float64))


def _array(rows: Sequence[Sequence[int]]) -> np.ndarray:
    """Integers as 64-bit numbers if they are small, else as Python's."""
    largest = max((abs(x) for row in rows for x in row), default=0)
    return np.array(rows, dtype=np.int64 if largest < _SMALL else object).reshape(len(rows), -1)


def _encoded(vectors: np.ndarray) -> tuple[bytes | None, bytes | None]:
    """(vectors, wide): the components as 32-bit numbers, or as text if they are too large."""
    if vectors.dtype == object:
        return None, json.dumps(vectors.tolist()).encode()
    return vectors.astype(np.int32).tobytes(), None


class Block:
    """Vectors of a stored block with their table of distances to the pivots."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.missing = np.frombuffer(row["missing"], np.bool_)
        n = len(self.ids)
        if row["vectors"] is not None:
            self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(n, -1).astype(np.int64)
        else:
            self.vectors = np.array(json.loads(row["wide"]), dtype=object).reshape(n, -1)
        self.table = np.frombuffer(row["pivots"], np.float64).reshape(n, -1)

    def nearest(self, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of every vector; ties go to the smaller cluster."""
        n, k = len(self.vectors), len(centroids)
        to_pivots = np.stack([_roots(_squares(pivots, c)) for c in centroids])
        bounds = np.zeros((n, k))
        for p in range(len(pivots)):
            mine, theirs = self.table[:, p, None], to_pivots[None, :, p]
            apart = np.abs(mine - theirs) - 1e-9 * (mine + theirs) - 1e-6
            np.maximum(bounds, apart, out=bounds)
        first = bounds.argmin(axis=1)
        wide = _wide(self.vectors, centroids)
        squares = np.full((n, k), None, dtype=object) if wide else np.full((n, k), _LONG)
        for c in range(k):
            at = np.flatnonzero(first == c)
            squares[at, c] = _squares(self.vectors[at], centroids[c])
        reach = _roots(squares[np.arange(n), first]) * (1 + 1e-9) + 1e-6
        for c in range(k):
            at = np.flatnonzero((bounds[:, c] <= reach) & (first != c))
            squares[at, c] = _squares(self.vectors[at], centroids[c])
        if wide:
            rows = [min((x, c) for c, x in enumerate(row) if x is not None) for row in squares]
            return np.array([c for _, c in rows], dtype=np.int64), np.array([x for x, _ in rows], dtype=object)
        cluster = squares.argmin(axis=1)
        return cluster, squares[np.arange(n), cluster]


def _blocks(pivots: np.ndarray | None, scale: int, size: int):
    """Arrow batches of (vec_id, embedding) to blocks of up to ``size`` vectors."""

    def block(ids: list, embeddings: np.ndarray) -> pa.RecordBatch:
        vectors = whole_quanta(embeddings, scale, _SMALL)
        table = np.stack([_roots(_squares(vectors, p)) for p in pivots], axis=1)
        values = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        missing = np.array([i is None for i in ids], dtype=np.bool_)
        columns = [values.tobytes(), missing.tobytes(), *_encoded(vectors), table.tobytes()]
        names = ["ids", "missing", "vectors", "wide", "pivots"]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield block(part.column(0).to_pylist(), values.reshape(part.num_rows, -1))

    return pack


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    """Blocks to one row for each centroid that a task's vectors are nearest to."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                cluster, squares = block.nearest(centroids, pivots)
                for c in np.unique(cluster).tolist():
                    at = cluster == c
                    # Up to 4,096 small numbers; sums of sums are Python's integers.
                    total = [int(x) for x in block.vectors[at].sum(axis=0)]
                    distance = sum(squares[at].tolist())
                    n, sums, far = found.get(c, (0, [0] * len(total), 0))
                    found[c] = (n + int(at.sum()), [a + b for a, b in zip(sums, total)], far + distance)
        yield _sum_rows(TaskContext.get().partitionId(), found)

    return add


def _sum_rows(part: int, found: dict) -> pa.RecordBatch:
    keys = sorted(found)
    columns = [
        pa.array([part] * len(keys), pa.int32()),
        pa.array(keys, pa.int32()),
        pa.array([found[c][0] for c in keys], pa.int64()),
        pa.array([json.dumps(found[c][1]) for c in keys], pa.string()),
        pa.array([str(found[c][2]) for c in keys], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "cluster", "n", "sums", "distance"])


def _added(rows) -> tuple[int, list[int], int]:
    """Rows of (n, sums, distance) added up."""
    n, total, far = 0, None, 0
    for count, sums, distance in rows:
        values = json.loads(sums)
        n, far = n + int(count), far + int(distance)
        total = values if total is None else [a + b for a, b in zip(total, values)]
    return n, total, far


def _merge(batch):
    """One group of a centroid's sums as one row."""
    n, sums, far = _added(zip(batch["n"], batch["sums"], batch["distance"]))
    return batch.iloc[:1][["part", "cluster"]].assign(n=n, sums=json.dumps(sums), distance=str(far))


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    """Blocks to (vec_id, cluster, distance) of every vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                cluster, squares = block.nearest(centroids, pivots)
                distance = [x if x <= _LONG else None for x in squares.tolist()]
                columns = [
                    pa.array(block.ids, pa.int64(), mask=block.missing),
                    pa.array(cluster, pa.int32()),
                    pa.array(distance, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return assign


class PivotTable:
    """The kept vectors in stored blocks, with their distances to the pivots."""

    def __init__(self, vectors: DataFrame, pivots: np.ndarray, scale: int):
        self.pivots = pivots
        self.blocks = stored(vectors.mapInArrow(_blocks(pivots, scale, BLOCK), _BLOB), "centroids-blocks")

    def totals(self, centroids: np.ndarray) -> dict[int, tuple[int, list[int], int]]:
        """(vectors, sums of components, sum of squared distances) by centroid."""
        sums = self.blocks.mapInArrow(_sums(centroids, self.pivots), _SUMS)
        merged = sums.withColumn("part", F.col("part") % FAN).groupBy("cluster", "part").applyInPandas(_merge, _SUMS)
        by_cluster: dict[int, list] = {}
        for row in merged.collect():  # at most FAN rows for each centroid
            by_cluster.setdefault(row.cluster, []).append((row.n, row.sums, row.distance))
        return {c: _added(rows) for c, rows in by_cluster.items()}

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        return self.blocks.mapInArrow(_assigned(centroids, self.pivots), "vec_id long, cluster int, distance long")


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, components as doubles."""
    double = F.col("embedding").cast("array<double>")
    # Null for a null vector, and for one with a null component.
    usable = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where((F.size("embedding") == dimensions) & usable)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), double.alias("embedding"))


def first_vectors(kept: DataFrame, count: int, seed: int, scale: int) -> np.ndarray:
    """The quanta of the ``count`` vectors with the smallest hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.withColumn("h", F.sha2(name.cast("binary"), 256)).orderBy("h", "embedding").limit(count).collect()
    if not rows:
        return np.zeros((0, 0), dtype=np.int64)
    return whole_quanta(np.array([r.embedding for r in rows], dtype=np.float64), scale, _SMALL)


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = 3,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, list[tuple]]:
    """(vec_id, cluster, distance) of every kept vector, and (components, vectors, inertia) by centroid."""
    kept = kept_vectors(vectors, dimensions)
    chosen = first_vectors(kept, max(clusters, pivots), seed, scale)
    if not len(chosen):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    index = PivotTable(kept, chosen[:pivots], scale)
    centroids = chosen[:clusters]
    for _ in range(rounds):
        means = [[int(x) for x in c] for c in centroids]
        for c, (n, sums, _) in index.totals(centroids).items():
            means[c] = [total // n for total in sums]
        centroids = _array(means)
    totals = index.totals(centroids)
    found = [
        ([int(x) for x in point], *(totals[c][::2] if c in totals else (0, 0))) for c, point in enumerate(centroids)
    ]
    return index.assigned(centroids), found


def op12_centroids(spark, directory: str) -> DataFrame:
    rows, found = cluster_vectors(table(spark, directory, "embeddings"))

    def long(value: int):
        return F.lit(value if value <= _LONG else None).cast("long")

    digests = [hashlib.sha256(",".join(map(str, point)).encode()).hexdigest() for point, _, _ in found]
    by_cluster = F.array(*[long(inertia) for _, _, inertia in found]).cast("array<long>")
    return rows.select(
        "*",
        F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        long(sum(inertia for _, _, inertia in found)).alias("inertia"),
        F.get(F.array(*map(F.lit, digests)).cast("array<string>"), F.col("cluster")).alias("centroid_sha256"),
    )


def centroids_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> str:
    """DuckDB SQL: every vector against every centroid, one pair of tables for each round."""
    nearest = """near{r} AS MATERIALIZED (SELECT n, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT v.n, k.c,
    list_sum(list_transform(list_zip(v.e, k.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d
    FROM v, c{r} k) GROUP BY n)"""
    moved = """sum{r} AS MATERIALIZED (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT m.c, unnest(v.e) AS x,
    unnest(range(1, 65)) AS i FROM near{r} m JOIN v USING (n)) GROUP BY c, i),
c{next} AS MATERIALIZED (SELECT k.c, coalesce(any_value(m.e), any_value(k.e)) AS e FROM c{r} k LEFT JOIN
    (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM sum{r} GROUP BY c) m
    USING (c) GROUP BY k.c)"""
    steps = ",\n".join(
        nearest.format(r=r) + ",\n" + moved.format(r=r, next=r + 1) for r in range(rounds)
    )
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM
    (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, e FROM v ORDER BY h, e LIMIT {clusters})),
{steps},
{nearest.format(r=rounds)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
    CAST(sum(d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(k.e, ',')) AS centroid_sha256
FROM near{rounds} m JOIN v USING (n) JOIN c{rounds} k ON k.c = m.c"""


QUERIES = {"op12_centroids": op12_centroids}
SQL = {"op12_centroids": centroids_sql()}
