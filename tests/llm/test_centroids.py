"""Exact k-means: every vector against every centroid in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docops.llm import centroids
from docops.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, h string, part int"


def plain(rows, clusters=8, rounds=10, dimensions=64):
    """(vec_id, cluster, distance) and inertia without bounds, blocks or floats."""
    kept = [
        (i, [(n * 1024) // d for n, d in (x.as_integer_ratio() for x in e)], e)
        for i, e, *_ in rows
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)
    ]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2])
    points = [q for _, q, _ in sorted(kept, key=key)[:clusters]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        members = [[] for _ in points]
        for _, q, _ in kept:
            members[nearest(q)[1]].append(q)
        points = [[sum(x) // len(m) for x in zip(*m)] if m else p for m, p in zip(members, points)]
    found = [(i, *nearest(q)) for i, q, _ in kept]
    return [(i, c, d if d < 1 << 63 else None) for i, d, c in found], points


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA)


def vector(rng, scale=1.0, n=64):
    return [rng.gauss(0, 1) * scale for _ in range(n)]


def check(spark, rows):
    out, found = centroids.cluster_vectors(frame(spark, rows).repartition(3))
    want, points = plain(rows)
    got = [tuple(r) for r in out.select("vec_id", "cluster", "distance").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert [p for p, _, _ in found] == points
    assert sum(n for _, n, _ in found) == len(want)


def awkward(rng):
    rows = [(i, vector(rng)) for i in range(60)]
    rows += [(None, vector(rng)), (None, rows[0][1]), rows[3], rows[3], (4, vector(rng)), (99, [0.0] * 64)]
    rows += [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [0.5] * 63)]
    rows += [(105, [math.nan] + [0.5] * 63), (106, [math.inf] + [0.5] * 63), (107, [-0.0009765625 / 2] * 64)]
    return rows


def test_equals_plain_on_awkward_rows(spark):
    check(spark, awkward(random.Random(1)))


@pytest.mark.parametrize("scale", [1e5, 3e6, 1e12, 1e30])
def test_large_components_are_exact(spark, scale):
    rng = random.Random(2)
    check(spark, [(i, vector(rng, scale if i % 7 == 0 else 1.0)) for i in range(40)])


def test_ties_and_copies(spark):
    rng = random.Random(3)
    few = [vector(rng) for _ in range(4)]
    check(spark, [(i, few[i % 4]) for i in range(50)])  # empty centroids stay where they are
    check(spark, [(i, [float(i % 3)] * 64) for i in range(3)])  # fewer vectors than centroids


def test_empty_tables(spark):
    for rows in ([], [(1, None)]):
        out, found = centroids.cluster_vectors(frame(spark, rows))
        assert out.columns == ["vec_id", "cluster", "distance"] and out.count() == 0 and found == []


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = awkward(random.Random(4))
    monkeypatch.setattr(centroids, "BLOCK", 7)
    monkeypatch.setattr(centroids, "FAN", 2)
    check(spark, rows)


def test_query_over_the_table(spark):
    directory = "/root/testdata/sf0.001"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table(spark, directory, "embeddings").collect()]
    want, points = plain(rows)
    out = centroids.op12_centroids(spark, directory)
    assert sorted(tuple(r) for r in out.select("vec_id", "cluster", "distance").collect()) == sorted(want)
    one = out.agg(F.sum("distance").alias("d"), F.max("inertia").alias("i")).first()
    assert one.d == one.i
    digests = {hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points}
    assert {r.centroid_sha256 for r in out.collect()} <= digests


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.sampled_from([1, 1000, 1 << 26, 1 << 40, 1 << 600]))
def test_pruning_loses_nothing(seed, n, size):
    rng = random.Random(seed)
    make = lambda k: np.array([[rng.randrange(-size, size + 1) for _ in range(3)] for _ in range(k)], dtype=object)
    vectors, points, pivots = make(n), make(5), make(2)
    block = centroids.Block.__new__(centroids.Block)
    block.vectors = centroids._array(vectors.tolist())
    block.table = np.stack([centroids._roots(centroids._squares(block.vectors, centroids._array([p.tolist()])[0])) for p in pivots], axis=1)
    cluster, squares = block.nearest(centroids._array(points.tolist()), centroids._array(pivots.tolist()))
    want = [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for v in vectors]
    assert [(int(d), int(c)) for d, c in zip(squares, cluster)] == want
