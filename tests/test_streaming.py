"""Streaming ingest: equal to the batch result, safe to repeat, late operations counted."""

import pytest
from pyspark.sql import functions as F

from docops.operators import changelog
from docops.streaming.changes import BASE
from docops.streaming.ingest import BulkIngest, flush_trigger, operation_stream
from tests.test_skew import OPS, random_ops, replay


def documents(ingest):
    return {(r["index"], r["id"]): r["source"] for r in ingest.documents().collect()}


def metrics(ingest):
    return [tuple(r) for r in ingest.metrics().orderBy("batch").collect()]


def test_stream_equals_batch(spark, tmp_path):
    ops = random_ops(11, 300, 15)
    want, outcome = replay(ops)
    files = tmp_path / "ops"
    for n in range(3):
        part = spark.createDataFrame(ops[n * 100:(n + 1) * 100], OPS)
        part.coalesce(1).write.mode("append").parquet(str(files))
    stream = spark.readStream.schema(OPS).option("maxFilesPerTrigger", 1).parquet(str(files))
    ingest = BulkIngest(spark, str(tmp_path / "table"), fail_on_error=False)
    ingest.start(stream, drain=True).awaitTermination()
    assert documents(ingest) == want
    rows = metrics(ingest)
    assert len(rows) == 3 and all(r[1] == 100 and r[4] == 0 for r in rows)
    assert sum(r[2] for r in rows) == sum(v == "ok" for v in outcome.values())
    # A restart from the same root finds nothing new; later files go on top.
    ingest.start(stream, drain=True).awaitTermination()
    assert documents(ingest) == want and len(metrics(ingest)) == 3
    more = [(1000, "i", "hot", "index", {"x": "last"})]
    spark.createDataFrame(more, OPS).coalesce(1).write.mode("append").parquet(str(files))
    ingest.start(stream, drain=True).awaitTermination()
    assert documents(ingest) == replay(ops + more)[0]


def test_repeated_flush_changes_nothing(spark, tmp_path):
    ops = random_ops(12, 200, 10)
    first, second = (spark.createDataFrame(part, OPS) for part in (ops[:120], ops[120:]))
    ingest = BulkIngest(spark, str(tmp_path), fail_on_error=False)
    ingest.flush(first, 0)
    ingest.flush(second, 1)
    before, counted = documents(ingest), metrics(ingest)
    ingest.flush(second, 1)
    assert documents(ingest) == before == replay(ops)[0] and metrics(ingest) == counted


def test_late_operations_are_dropped_and_counted(spark, tmp_path):
    ingest = BulkIngest(spark, str(tmp_path), fail_on_error=False)
    ingest.flush(spark.createDataFrame([(5, "i", "a", "index", {"x": "1"}), (6, "i", "b", "delete", None)], OPS), 0)
    late = [(4, "i", "a", "delete", None), (5, "i", "a", "index", {"x": "2"}), (3, "i", "b", "create", {"x": "3"}),
            (7, "i", "b", "create", {"x": "4"}), (1, "i", "c", "create", {"x": "5"})]
    ingest.flush(spark.createDataFrame(late, OPS), 1)
    assert documents(ingest) == {("i", "a"): {"x": "1"}, ("i", "b"): {"x": "4"}, ("i", "c"): {"x": "5"}}
    assert metrics(ingest)[1] == (1, 5, 2, 0, 3)


def test_flush_writes_only_the_keys_it_names(spark, tmp_path):
    ingest = BulkIngest(spark, str(tmp_path))
    ingest.flush(spark.createDataFrame([(n, "i", str(n), "index", {}) for n in range(200)], OPS), 0)
    ingest.flush(spark.createDataFrame([(999, "i", "7", "update", {"x": "1"})], OPS), 1)
    written = {r["flush"]: r["count"] for r in ingest.table.changes().groupBy("flush").count().collect()}
    assert written == {0: 200, 1: 1} and len(documents(ingest)) == 200


def test_failures_stop_the_flush_before_it_is_written(spark, tmp_path):
    ingest = BulkIngest(spark, str(tmp_path))
    with pytest.raises(changelog.BulkFailedError):
        ingest.flush(spark.createDataFrame([(1, "i", "a", "update", {}), (2, "i", "b", "index", {})], OPS), 0)
    assert ingest.table.changes().count() == 0 and documents(ingest) == {} and ingest.metrics().count() == 0
    failed = ingest.judged().where("outcome <> 'ok'").collect()
    assert [(r["seq"], r["id"], r["outcome"], r["flush"]) for r in failed] == [(1, "a", "missing", 0)]


def test_an_interrupted_flush_is_not_seen(spark, tmp_path):
    """The changes of a flush are there, its metrics are not: readers stay at the flush before."""
    ingest = BulkIngest(spark, str(tmp_path))
    ingest.flush(spark.createDataFrame([(1, "i", "a", "index", {"x": "1"})], OPS), 0)
    before = documents(ingest)
    ingest.table.append(ingest.table.state(1).withColumn("deleted", F.lit(True)), 1)
    assert documents(ingest) == before
    ingest.flush(spark.createDataFrame([(2, "i", "a", "update", {"x": "2"})], OPS), 1)
    assert documents(ingest) == {("i", "a"): {"x": "2"}}


def test_empty_flushes_and_nulls(spark, tmp_path):
    ingest = BulkIngest(spark, str(tmp_path), fail_on_error=False)
    assert documents(ingest) == {} and ingest.flushed() == 0 and ingest.judged().count() == 0
    ingest.flush(spark.createDataFrame([], OPS), 0)
    assert metrics(ingest) == [(0, 0, 0, 0, 0)] and documents(ingest) == {}
    ingest.flush(spark.createDataFrame([(1, None, "a", "index", {"x": None}), (2, "i", "", "index", None)], OPS), 1)
    ingest.flush(spark.createDataFrame([(1, None, "a", "delete", None)], OPS), 2)
    assert documents(ingest) == {(None, "a"): {"x": None}, ("i", ""): {}}
    assert [m[1:] for m in metrics(ingest)[1:]] == [(2, 2, 0, 0), (1, 0, 0, 1)]


def test_folding_goes_on_from_the_same_place(spark, tmp_path):
    ops = random_ops(13, 240, 12)
    files = tmp_path / "ops"

    def write(part):
        spark.createDataFrame(part, OPS).coalesce(1).write.mode("append").parquet(str(files))

    write(ops[:80])
    write(ops[80:160])
    stream = operation_stream(spark, str(files), spark.createDataFrame([], OPS).schema, files=1)
    ingest = BulkIngest(spark, str(tmp_path / "table"), fail_on_error=False)
    ingest.start(stream, drain=True).awaitTermination()
    folded = ingest.folded(str(tmp_path / "folded"))
    base = folded.table.changes()
    assert {r["flush"] for r in base.collect()} == {BASE}
    assert base.count() == base.select("index", "id").distinct().count()
    assert documents(folded) == documents(ingest) == replay(ops[:160])[0]
    write(ops[160:])
    folded.start(stream, drain=True).awaitTermination()
    assert documents(folded) == replay(ops)[0] and len(metrics(folded)) == 1
    assert documents(ingest) == replay(ops[:160])[0]  # the old table stays as it was


def test_flushes_follow_bytes(spark, tmp_path):
    ops = random_ops(14, 400, 30)
    files = tmp_path / "ops"
    for n in range(8):
        spark.createDataFrame(ops[n * 50:(n + 1) * 50], OPS).coalesce(1).write.mode("append").parquet(str(files))
    sizes = [f.stat().st_size for f in files.glob("*.parquet")]
    flushes = {}
    for volume in (min(sizes) - 1, 2 * max(sizes) + 1, 9 * max(sizes)):
        stream = operation_stream(spark, str(files), spark.createDataFrame([], OPS).schema, volume=volume)
        ingest = BulkIngest(spark, str(tmp_path / f"table{volume}"), fail_on_error=False)
        ingest.start(stream, drain=True).awaitTermination()
        assert documents(ingest) == replay(ops)[0]
        flushes[volume] = len(metrics(ingest))
    assert list(flushes.values()) == [8, 4, 1]
    with pytest.raises(ValueError):
        operation_stream(spark, str(files), spark.createDataFrame([], OPS).schema, files=1, volume=1)


def test_flushes_follow_the_timer(spark, tmp_path):
    files = tmp_path / "ops"
    spark.createDataFrame([(1, "i", "a", "index", {"x": "1"})], OPS).coalesce(1).write.parquet(str(files))
    stream = operation_stream(spark, str(files), spark.createDataFrame([], OPS).schema)
    ingest = BulkIngest(spark, str(tmp_path / "table"))
    query = ingest.start(stream, interval="1 second")
    try:
        query.processAllAvailable()
        assert documents(ingest) == {("i", "a"): {"x": "1"}}
        spark.createDataFrame([(2, "i", "a", "delete", None)], OPS).coalesce(1).write.mode("append").parquet(str(files))
        query.processAllAvailable()  # the timer picks it up, nobody starts a flush
        assert documents(ingest) == {} and len(metrics(ingest)) == 2
    finally:
        query.stop()


def test_flush_policy():
    assert flush_trigger() == {"processingTime": "30 seconds"}
    assert flush_trigger("5 seconds") == {"processingTime": "5 seconds"}
    assert flush_trigger(drain=True) == {"availableNow": True}
