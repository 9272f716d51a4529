"""Cases on both sides of a size bound, ties, and tables stored as directories."""

import pytest

from docops.operators import changelog, profile, search
from docops.plans import registry, skew
from docops.sources.json_ingest import ingest_json
from docops.streaming.ingest import BulkIngest
from tests.compare import spark_rows
from tests.test_skew import OPS

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("top", [1_000, 0])
def test_pages_of_ties_cover_every_row_once(spark, monkeypatch, top):
    monkeypatch.setattr(search, "TOP_ROWS", top)
    df = spark.range(400).selectExpr("id", "id % 2 AS few", "map('k', id) AS m", "if(id % 3 = 0, null, id) AS n")
    seen = [r["id"] for at in range(0, 400, 80) for r in search.page(df, ["few"], at, 80).collect()]
    assert sorted(seen) == list(range(400))


def test_an_order_with_few_values_is_cut_into_ranges(spark):
    tied = spark.range(4000).selectExpr("id", "id % 2 AS few")
    tied = tied.withColumn("_tie", search.row_hash(tied))
    ranges = skew.OrderedRanges(tied, ["few", "_tie"], 16)
    assert len(ranges.before) > 8 and max(b - a for a, b in zip(ranges.before, ranges.before[1:])) < 1000


@pytest.mark.parametrize("bound", [200_000, 0])
def test_documents_the_log_does_not_name_stay_as_they_are(spark, monkeypatch, bound):
    monkeypatch.setattr(skew.checked_broadcast, "__defaults__", (bound,))
    kinds = "index string, id string, source map<string,string>"
    rows = [("i", "a", {"x": "1"}), ("i", "b", None), ("i", "c", {"y": "2"}), ("i", "c", {"y": "2"})]
    ops = spark.createDataFrame([(1, "i", "a", "update", {"z": "3"}), (2, "i", "d", "index", {})], OPS)
    out = changelog.apply_changes(ops, spark.createDataFrame(rows, kinds)).collect()
    assert sorted((r["id"], str(r["source"])) for r in out) == [
        ("a", "{'x': '1', 'z': '3'}"), ("b", "None"), ("c", "{'y': '2'}"), ("c", "{'y': '2'}"), ("d", "{}")]


def test_more_keys_than_the_bound_in_a_flush(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(skew.checked_broadcast, "__defaults__", (1,))
    ingest = BulkIngest(spark, str(tmp_path))
    ingest.flush(spark.createDataFrame([(n, "i", str(n), "index", {}) for n in range(5)], OPS), 0)
    ingest.flush(spark.createDataFrame([(9, "i", "7", "index", {})], OPS), 1)
    ingest.flush(spark.createDataFrame([(8, "i", "7", "delete", None), (1, "i", "2", "delete", None)], OPS), 2)
    assert ingest.documents().count() == 6 and [r["late"] for r in ingest.metrics().orderBy("batch").collect()] == [0, 0, 2]


def test_streams_read_tables_stored_as_directories(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    applied = spark_rows(registry.bulk_apply(spark, SMALL))
    assert spark_rows(registry.stream_bulk_apply(spark, str(tmp_path))) == applied
    assert spark_rows(registry.stream_ingest_metrics(spark, str(tmp_path))) == spark_rows(
        registry.stream_ingest_metrics(spark, SMALL))


def test_a_broken_file_is_not_an_empty_table(spark, tmp_path):
    (tmp_path / "changes" / "flush=0").mkdir(parents=True)
    (tmp_path / "changes" / "flush=0" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        BulkIngest(spark, str(tmp_path)).table.changes().collect()


def test_coverage_of_maps_and_arrays(spark):
    docs = spark.sql(
        """select map('a.b', '1', 'c', cast(null as string)) source, array(named_struct('x', 1, 'y', cast(null as int))) items, 's' flat
           union all select map('a.d', '2', 'c', '3'), array(named_struct('x', null, 'y', 2), named_struct('x', 1, 'y', 2)), null
           union all select null, null, null""")
    leaf = {"type": "keyword"}
    mapped = {"properties": {"a": {"type": "object", "properties": {"b": leaf, "d": leaf}}, "c": leaf, "z": leaf}}
    inside = {r["path"]: r["docs"] for r in profile.field_coverage(docs, mapped, within="source").collect()}
    assert inside == {"a": 2, "a.b": 1, "a.d": 1, "c": 1, "z": 0}
    listed = {"properties": {"items": {"properties": {"x": leaf, "y": leaf, "w": leaf}}}}
    assert {r["path"]: r["docs"] for r in profile.field_coverage(docs, listed).collect()} == {
        "items.w": 0, "items.x": 2, "items.y": 1}
    with pytest.raises(ValueError):
        profile.field_coverage(docs, {"properties": {"flat": {"properties": {"x": leaf}}}})


def test_points_in_three_forms_and_rejected_documents(spark):
    texts = ['{"p":{"lat":1.5,"lon":2},"n":1}', '{"p":"1.5,2","n":1}', '{"p":[2,1.5],"n":1}', '{"p":"north","n":1}',
             '{"n":1}', '{"n":"x"}', '{"n":1', None]
    mapping = {"properties": {"p": {"type": "geo_point"}, "n": {"type": "integer"}}}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = ingest_json(df, "t", mapping, rejected="bad").collect()
    assert [r["bad"] for r in rows] == [False, False, False, True, False, True, True, False]
    assert [tuple(r["doc"]["p"]) for r in rows[:3]] == [(1.5, 2.0)] * 3 and rows[4]["doc"]["n"] == 1
    assert [r["bad"] for r in ingest_json(df, "t", rejected="bad").collect()][-2:] == [True, False]


def test_one_key_is_pushed_to_the_scan(spark, capsys):
    registry.doc_get(spark, SMALL).explain()
    assert "EqualTo(doc_id,1)" in capsys.readouterr().out


def test_lists_are_parsed_in_one_pass(spark):
    df = registry.registered()["ingest_json_lists"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
