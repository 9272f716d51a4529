"""Hot keys: every operator gives the same rows whether or not keys are split."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docops.operators import changelog, chunks, reports, search
from docops.plans.skew import OrderedRanges, checked_broadcast, find_hot_keys, local_frame, number_rows

ENVIRONMENT = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
OPS = "seq long, index string, id string, op string, source map<string,string>"


def replay(ops):
    """The change log applied one operation at a time."""
    docs, outcome = {}, {}
    for seq, index, key, op, source in sorted(ops):
        doc = docs.get((index, key))
        outcome[seq] = "ok"
        if op == "index":
            docs[index, key] = dict(source or {})
        elif op == "create":
            if doc is None:
                docs[index, key] = dict(source or {})
            else:
                outcome[seq] = "conflict"
        elif op == "update":
            if doc is None:
                outcome[seq] = "missing"
            else:
                doc.update(source or {})
        else:
            docs.pop((index, key), None)
    return docs, outcome


def random_ops(seed, count, keys):
    rng = random.Random(seed)
    ops = []
    for seq in range(count):
        # A third of all rows are on one key.
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        op = rng.choice(["index", "create", "create", "update", "update", "update", "delete"])
        source = None
        if op != "delete":
            source = {f: rng.choice(["a", "b", None]) for f in rng.sample("xyz", rng.randrange(4))}
        ops.append((seq, "i", key, op, source))
    return ops


@pytest.mark.parametrize("hot_rows", [None, 20])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_change_log_equals_replay(spark, seed, hot_rows):
    ops = random_ops(seed, 900, 40)
    docs, outcome = replay(ops)
    df = spark.createDataFrame(ops, OPS).repartition(3)
    hot = changelog.hot_documents(df, hot_rows)
    assert bool(hot) == (hot_rows is not None)
    judged = changelog.outcomes(df, hot=hot)
    assert {r["seq"]: r["outcome"] for r in judged.collect()} == outcome
    applied = changelog.apply_changes(df, hot=hot).collect()
    assert {(r["index"], r["id"]): r["source"] for r in applied} == docs
    last = {}
    for seq, index, key, *_ in ops:
        last[index, key] = seq
    assert all(r["last_seq"] == last[r["index"], r["id"]] for r in applied)


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_deleted_keys_are_kept_on_request(spark, hot_rows):
    ops = random_ops(9, 600, 60)
    docs, _ = replay(ops)
    df = spark.createDataFrame(ops, OPS)
    hot = changelog.hot_documents(df, hot_rows)
    rows = changelog.apply_changes(df, keep_deleted=True, hot=hot).collect()
    assert len(rows) == len({(o[1], o[2]) for o in ops})
    assert {(r["index"], r["id"]) for r in rows if not r["deleted"]} == set(docs)
    assert all(r["source"] == {} for r in rows if r["deleted"])


def test_snapshot_precedes_the_log(spark):
    snapshot = spark.createDataFrame(
        [("i", "a", {"x": "1", "y": "1"}), ("i", "b", {"x": "2"})], "index string, id string, source map<string,string>"
    )
    ops = spark.createDataFrame(
        [(0, "i", "a", "update", {"y": "9"}), (1, "i", "b", "create", {"x": "8"}), (2, "i", "c", "update", {"x": "7"})],
        OPS,
    )
    assert {r["seq"]: r["outcome"] for r in changelog.outcomes(ops, snapshot).collect()} == {
        0: "ok", 1: "conflict", 2: "missing"}
    applied = {r["id"]: r["source"] for r in changelog.apply_changes(ops, snapshot).collect()}
    assert applied == {"a": {"x": "1", "y": "9"}, "b": {"x": "2"}}


@pytest.mark.parametrize("bound", [1, 1_000])
def test_snapshot_merge_with_short_and_long_logs(spark, monkeypatch, bound):
    ops = random_ops(21, 400, 30)
    docs, _ = replay(ops[:200])
    snapshot = spark.createDataFrame(
        [(*key, source) for key, source in docs.items()], "index string, id string, source map<string,string>"
    )
    # Only what the later half names is merged, whether its keys are broadcast or joined by shuffle.
    later = [o for o in ops[200:] if o[2] in ("hot", "k1", "k2", "k3", "k99")]
    monkeypatch.setattr(checked_broadcast, "__defaults__", (bound,))
    applied = changelog.apply_changes(spark.createDataFrame(later, OPS), snapshot).collect()
    want, outcome = replay(ops[:200] + later)
    assert {(r["index"], r["id"]): r["source"] for r in applied} == want
    judged = changelog.outcomes(spark.createDataFrame(later, OPS), snapshot).collect()
    assert {r["seq"]: r["outcome"] for r in judged} == {o[0]: outcome[o[0]] for o in later}


def requests(spark, seed=5, count=1500, biggest=40):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["hot", "hot", "w1", "w2", "w3", None]), seq, rng.randrange(0, biggest), rng.randrange(1, 9))
        for seq in range(count)
    ]
    return rows, spark.createDataFrame(rows, "writer string, seq long, bytes long, took long").repartition(3)


def greedy(rows, actions, volume):
    batch, held, out = {}, {}, {}
    for writer, seq, size, _ in sorted(rows, key=lambda r: r[1]):
        out[seq] = batch.setdefault(writer, 0)
        count, filled = held.get(writer, (0, 0))
        count, filled = count + 1, filled + size
        if (actions != -1 and count >= actions) or filled >= volume:
            batch[writer] += 1
            count, filled = 0, 0
        held[writer] = (count, filled)
    return out


@pytest.mark.parametrize("hot_rows", [None, 30])
@pytest.mark.parametrize(
    "actions, volume",
    [(-1, 1), (-1, 25), (-1, 130), (-1, 3_000), (-1, 1_000_000), (1, 50), (5, 100), (7, 130), (100, 2_500), (9, 10**7)],
)
def test_chunks_equal_greedy(spark, actions, volume, hot_rows):
    rows, df = requests(spark)
    got = chunks.chunk(df, "writer", "seq", "bytes", actions, volume, hot_rows).collect()
    assert {r["seq"]: r["batch"] for r in got} == greedy(rows, actions, volume)
    assert sorted((r["writer"] or "", r["seq"], r["bytes"], r["took"]) for r in got) == sorted(
        (w or "", *rest) for w, *rest in rows
    )


def test_task_functions_load_without_the_package(tmp_path):
    function = tmp_path / "function.pickle"
    function.write_bytes(cloudpickle.dumps((chunks._number, chunks._segment_endings, chunks.Limits(3, 6))))
    code = f"""
import pickle, sys
assert "docops" not in sys.modules
number, endings, limits = pickle.load(open({str(function)!r}, "rb"))
import numpy
print(len(endings(numpy.array([4, 4, 4]), limits)), limits.actions)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=ENVIRONMENT, capture_output=True, text=True)
    assert done.stdout.split() == ["3", "3"], done.stderr


def test_segment_endings_by_hand():
    # Sizes 4 4 4 with a limit of 6: the start fill decides which operation closes first.
    rows = chunks._segment_endings(np.array([4, 4, 4]), chunks.Limits(chunks.NO_LIMIT, 6)).to_numpy().tolist()
    assert rows == [[0, 2, 2, 0, 0], [1, -2, 1, 4, 1], [3, 0, 0, 12, 3]]


@pytest.mark.parametrize("seed", range(8))
def test_composed_endings_equal_one_long_run(seed):
    rng = random.Random(seed)
    limits = chunks.Limits(rng.choice([chunks.NO_LIMIT, 1, 3, 17]), rng.choice([1, 40, 300, 10**6]))

    def endings(sizes):
        table = chunks._segment_endings(np.array(sizes, dtype="int64"), limits).iloc[:-1]
        lists = [table[c].to_numpy(dtype="int64") for c in chunks._ENDINGS]
        return chunks.Endings(*lists, len(sizes), sum(sizes))

    parts = [[rng.choice([0, 1, 5, 60]) for _ in range(rng.randrange(0, 25))] for _ in range(9)]
    nodes = [endings(part) for part in parts]
    while len(nodes) > 1:  # a tree of pairs, as the segments take
        nodes = [nodes[i].then(nodes[i + 1], limits) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    sizes = [n for part in parts for n in part]
    for fill, held in ((0, 0), (1, 1), (39, 2), (limits.volume - 1, 1)):
        held = min(held, limits.actions - 1)
        closed, left, kept = chunks._closing_positions(np.array(sizes, dtype="int64"), fill, held, limits)
        assert nodes[0].after((fill, held, 0), limits) == (left, kept, len(closed))
    assert len(nodes[0].position) <= len(sizes)


def test_requests_longer_than_segments(spark):
    """Every request spans many segments: the endings of a segment are as many as its operations."""
    rng = random.Random(4)
    rows = [("hot" if n % 9 else "w", n, rng.randrange(0, 50), 1) for n in range(3000)]
    df = spark.createDataFrame(rows, "writer string, seq long, bytes long, took long")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for actions, volume in ((-1, 20_000), (1500, 10**9), (-1, 10**9)):
            got = chunks.chunk(df, "writer", "seq", "bytes", actions, volume, 50).collect()
            assert {r["seq"]: r["batch"] for r in got} == greedy(rows, actions, volume)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_chunk_by_count(spark, hot_rows):
    rows, df = requests(spark)
    seen, want = {}, {}
    for writer, seq, *_ in sorted(rows, key=lambda r: r[1]):
        want[seq] = seen.get(writer, 0) // 7
        seen[writer] = seen.get(writer, 0) + 1
    got = chunks.chunk_by_count(df, "writer", "seq", 7, hot_rows).collect()
    assert {r["seq"]: r["batch"] for r in got} == want


@pytest.mark.parametrize("limit", [chunks.MAX_ACTIONS])
def test_no_limit_is_one_chunk(spark, limit):
    _, df = requests(spark, count=20)
    assert {r["batch"] for r in chunks.chunk_by_count(df, "writer", "seq", limit).collect()} == {0}
    assert {r["batch"] for r in chunks.chunk_by_volume(df, "writer", "seq", "bytes", limit).collect()} == {0}


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_throughput_blocks_equal_a_ring(spark, hot_rows):
    rows, df = requests(spark)
    size, want, held, last = 8, {}, {}, {}
    for writer, seq, nbytes, took in sorted(rows, key=lambda r: r[1]):
        held.setdefault(writer, []).append((took, nbytes))
        if len(held[writer]) == size:
            times, sizes = zip(*held.pop(writer))
            rate = (sum(sizes) / size) / (sum(times) / size)
            block = sum(1 for w, _ in want if w == writer)
            delta = rate - last[writer] if writer in last else 0.0
            want[writer, block] = (min(times), max(sizes), round(rate, 9), round(delta, 9))
            last[writer] = rate
    got = reports.throughput_blocks(df, "writer", "seq", "took", "bytes", size, hot_rows).collect()
    assert {
        (r["writer"], r["block"]): (r["min_took"], r["max_size"], round(r["throughput"], 9), round(r["delta"], 9))
        for r in got
    } == want


def test_hot_keys_are_found_by_row_count(spark):
    _, df = requests(spark)
    assert len(find_hot_keys(df, ["writer"], 400).hashes) == 1
    assert not find_hot_keys(df, ["writer"])


def test_segmented_numbers_equal_plain_numbers(spark):
    _, df = requests(spark)
    plain = number_rows(df, ["writer"], "seq", "n").collect()
    split = number_rows(df, ["writer"], "seq", "n", hot_rows=10).collect()
    assert sorted(map(str, plain)) == sorted(map(str, split))


@pytest.mark.parametrize("order", [["a", "b"], ["-a", "b"], ["-s", "a", "-b"], ["s", "-b"], ["b"], ["-c", "b"], ["c", "b"]])
def test_ordered_ranges_follow_the_sort(spark, order):
    rng = random.Random(3)
    rows = [
        (rng.choice([1.5, 2.5, 7.0, None]), n, rng.choice(["x", "y", None]), rng.choice([rng.random(), rng.random(), None]))
        for n in range(400)
    ]
    df = spark.createDataFrame(rows, "a double, b long, s string, c double").repartition(3)
    ranges = OrderedRanges(df, order, parts=16)
    assert ranges.total == 400 and len(ranges.before) > 10
    numbered = {r["b"]: r["n"] for r in ranges.numbered("n").collect()}
    columns = [F.col(o[1:]).desc() if o[0] == "-" else F.col(o).asc() for o in order]
    assert [numbered[r["b"]] for r in df.orderBy(*columns).collect()] == list(range(1, 401))
    for start, end in ((0, 5), (123, 130), (390, 410)):
        between = ranges.rows_between(start, end, "n").collect()
        assert {r["b"]: r["n"] for r in between} == {b: n for b, n in numbered.items() if start < n <= end}
    assert ranges.rows_between(400, 410, "n").count() == 0


def test_deep_page_equals_front_page(spark, monkeypatch):
    df = spark.range(500).withColumn("v", F.col("id") % 7)
    front = [tuple(r) for r in search.page(df, ["-v", "id"], 100, 20).collect()]
    monkeypatch.setattr(search, "TOP_ROWS", 10)
    assert [tuple(r) for r in search.page(df, ["-v", "id"], 100, 20).collect()] == front
    assert search.page(df, ["-v", "id"], 600, 20).count() == 0


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(50)
    big = spark.range(1000).join(checked_broadcast(df, 10), "id")
    small = spark.range(1000).join(checked_broadcast(df, 100), "id")
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString()
    assert big.count() == small.count() == 50


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_local_frames_keep_values(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            """select timestamp'2024-01-01 10:00:00' z, timestamp_ntz'2024-01-01 10:00:00' n, 1 i union all
               select null, null, null"""
        )
        same = local_frame(spark, df.collect(), df.schema)
        assert same.schema == df.schema and same.exceptAll(df).count() == 0 == df.exceptAll(same).count()
        nested = spark.sql("select named_struct('a', 1L, 'b', 'x') s, map('k', 'v') m, array(1, null) l, date'2024-02-03' d")
        same = local_frame(spark, nested.collect(), nested.schema)
        assert [tuple(r) for r in same.collect()] == [tuple(r) for r in nested.collect()]
        assert local_frame(spark, [], "a int, b string").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
