"""Keyed reads, search pages, sinks and upserts on small frames."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docops.operators import changelog, keyed, reports, search
from docops.sources import bulk_lines, json_ingest, tables
from docops.definitions import IndexDefinition
from docops.operators.lifecycle import compact_index

DOCS = "index string, id string, source map<string,string>"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([("i", str(n), {"n": str(n)}) for n in range(20)], DOCS)


def test_get(docs):
    assert keyed.get(docs, "i", "3").select("id", "score").collect() == [("3", -1.0)]
    assert keyed.get(docs, "j", "3").count() == 0


def test_multi_get_keeps_duplicates_and_missing(spark, docs):
    wanted = spark.createDataFrame([(0, "i", "3"), (1, "i", "x"), (2, "i", "3")], "position int, index string, id string")
    rows = keyed.multi_get(docs, wanted, ["source"]).orderBy("position").collect()
    assert [(r["position"], r["found"], r["source"]) for r in rows] == [
        (0, True, {"n": "3"}), (1, False, None), (2, True, {"n": "3"})]
    assert [r["exists"] for r in keyed.exists(docs, wanted).orderBy("position").collect()] == [True, False, True]


@pytest.mark.parametrize("size, pages", [(579, 173), (79, 1266), (1000, 100)])
def test_scroll_pages_and_summary(spark, size, pages):
    numbered = search.scroll(spark.range(100_000), ["id"], size)
    row = search.scroll_summary(numbered).first()
    assert (row["hits"], row["pages"], row["least"], row["most"]) == (100_000, pages, 100_000 % size or size, size)
    assert numbered.where(F.col("page") != F.floor(F.col("id") / size)).count() == 0


def test_empty_scroll(spark):
    empty = search.scroll(spark.range(0), ["id"], 10)
    assert empty.count() == 0 and tuple(search.scroll_summary(empty).first()) == (0, 0, 0, 0)


def test_page_and_total(spark):
    df = spark.createDataFrame([(f"u{n}", n) for n in range(9)], "user string, rowcount int")
    hits = search.page_with_total(df.where(search.field_query(df, "rowcount:0")), ["-rowcount"], 0, 15).collect()
    assert [(r["user"], r["total"]) for r in hits] == [("u0", 1)]
    rows = search.page_with_total(df, ["-rowcount"], 2, 3).collect()
    assert [(r["rowcount"], r["total"]) for r in rows] == [(6, 9), (5, 9), (4, 9)]
    for start, size, hits in ((0, 3, 3), (8, 3, 1), (9, 3, 0), (0, 0, 0)):
        assert tuple(search.page_summary(df, start, size).first()) == (hits, 9, hits > 0)
        assert search.page(df, ["rowcount"], start, size).count() == hits


def test_sequence_on_one_id(spark):
    first = [("create", 1), ("update", 2), ("delete", 3), ("create", 4), ("delete", 5)]
    rows = [(seq, "test_smoke", "1", op, {"name": "Hello"} if op != "delete" else None) for op, seq in first]
    schema = "seq long, index string, id string, op string, source map<string,string>"
    judged = changelog.outcomes(spark.createDataFrame(rows, schema))
    again = changelog.outcomes(spark.createDataFrame([(6, "test_smoke", "1", "create", {"name": "Hello"})], schema))
    counts = [changelog.failure_counts(j).first() for j in (judged, again)]
    assert (sum(c["succeeded"] for c in counts), sum(c["failed"] for c in counts)) == (6, 0)
    assert changelog.ensure_no_failures(judged) is judged


def test_failures_raise_with_their_count(spark):
    rows = [(1, "i", "a", "create", {}), (2, "i", "a", "create", {}), (3, "i", "b", "update", {})]
    judged = changelog.outcomes(
        spark.createDataFrame(rows, "seq long, index string, id string, op string, source map<string,string>"))
    with pytest.raises(changelog.BulkFailedError, match="n = 2, conflicts = 1, missing = 1"):
        changelog.ensure_no_failures(judged)
    assert changelog.ensure_no_failures(judged, fail_on_error=False) is judged


def test_duplicate_ids_leave_one_document_each(spark):
    rows = [(n, "i", chr(97 + n * 7 % 26), "index", {"name": str(n)}) for n in range(10_000)]
    ops = spark.createDataFrame(rows, "seq long, index string, id string, op string, source map<string,string>")
    counts = changelog.failure_counts(changelog.outcomes(ops)).first()
    assert (counts["succeeded"], counts["failed"]) == (10_000, 0)
    assert changelog.index_last_wins(ops).count() == changelog.apply_changes(ops).count() == 26


def test_update_with_upsert(spark, docs):
    base = docs.where("id in ('1', '2')")
    updates = spark.createDataFrame(
        [(1, "i", "1", {"a": "1"}, {"u": "1"}), (2, "i", "1", {"a": "2"}, {"u": "2"}),
         (3, "i", "9", {"a": "3"}, {"u": "3"}), (4, "i", "9", {"a": "4"}, {"u": "4"}), (5, "i", "8", {"a": "5"}, {"u": "5"})],
        "seq long, index string, id string, doc map<string,string>, upsert map<string,string>")
    got = {r["id"]: (r["live"], r["source"]) for r in changelog.update_with_upsert(base, updates).collect()}
    assert got == {"1": (True, {"n": "1", "a": "2"}), "2": (True, {"n": "2"}),
                   "9": (False, {"u": "3", "a": "4"}), "8": (False, {"u": "5"})}


def test_delete_and_disabled(spark, docs):
    gone = spark.createDataFrame([("i", "1"), ("i", "nope")], "index string, id string")
    assert changelog.delete_by_id(docs, gone).count() == 19
    definitions = spark.createDataFrame([("i", False), ("j", True)], "index string, enabled boolean")
    assert changelog.enabled_only(docs, definitions).count() == 0


def test_bulk_lines(spark):
    ops = spark.createDataFrame(
        [("index", "i", "1", {"a": "x"}, "r", 3, "EXTERNAL"), ("create", "i", None, {"a": "y"}, None, 0, None),
         ("update", "i", 'q"', {"a": "z"}, None, -1, None), ("delete", "i", "2", None, None, 9, "EXTERNAL"),
         ("update", "i", "3", None, None, None, None), ("index", "i", "4", None, None, None, None),
         ("create", "i", "5", None, None, None, None)],
        "op string, index string, id string, source map<string,string>, routing string, version long, version_type string")
    got = [r["body"] for r in bulk_lines.bulk_lines(ops).collect()]
    assert got == [
        '{"index":{"_index":"i","_id":"1","_routing":"r","_version":"3","_version_type":"EXTERNAL"}}\n{"a":"x"}\n',
        '{"create":{"_index":"i"}}\n{"a":"y"}\n',
        '{"update":{"_index":"i","_id":"q\\""}}\n{"doc":{"a":"z"}}\n',
        '{"delete":{"_index":"i","_id":"2"}}\n',
        '{"update":{"_index":"i","_id":"3"}}\n',
        '{"index":{"_index":"i","_id":"4"}}\n{}\n',
        '{"create":{"_index":"i","_id":"5"}}\n{}\n',
    ]


def test_export_and_id_dump(spark, docs, tmp_path):
    ops = docs.withColumn("op", F.lit("index"))
    bulk_lines.export_bulk(ops, str(tmp_path / "bulk"))
    lines = [line for f in (tmp_path / "bulk").glob("part-*") for line in f.read_text().splitlines()]
    assert len(lines) == 40
    pairs = zip(lines[::2], lines[1::2])
    assert all(json.loads(a)["index"]["_id"] == json.loads(b)["n"] for a, b in pairs)
    tables.dump_ids(docs, str(tmp_path / "ids"), F.col("id") < "2")
    ids = [line for f in (tmp_path / "ids").glob("part-*") for line in f.read_text().splitlines()]
    assert sorted(ids) == sorted(str(n) for n in range(20) if str(n) < "2")


def test_auto_id_is_stable(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "given")], "seq long, source string, id string")
    first, second = (tables.with_auto_id(df.repartition(n), "seq", "source").orderBy("seq").collect() for n in (1, 3))
    assert first == second and first[1]["id"] == "given" and len(first[0]["id"]) == 64


def test_ingest_json(spark):
    df = spark.createDataFrame([('{"name":"x","point":{"x":1,"y":"bad"},"more":2}',), ("not json",)], "s string")
    mapping = {"properties": {"name": {"type": "keyword"}, "point": {"properties": {"x": {"type": "integer"}}}}}
    typed = [r["doc"] for r in json_ingest.ingest_json(df, "s", mapping).collect()]
    assert typed[0].name == "x" and typed[0].point.x == 1 and (typed[1] is None or typed[1].name is None)
    dynamic = json_ingest.ingest_json(df, "s").first()["doc"]
    assert dynamic == {"name": "x", "point": '{"x":1,"y":"bad"}', "more": "2"}


def test_routed_table_prunes_and_compacts(spark, tmp_path):
    df = spark.sql("select id, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 5 as int)) ts from range(1000)")
    path, target = str(tmp_path / "routed"), str(tmp_path / "compact")
    tables.write_routed(tables.route(df.repartition(4), "log", "ts"), path)
    tables.write_routed(tables.route(df.repartition(4), "log", "ts"), path)
    table = tables.read_routed(spark, path)
    plan = table.where(search.in_indices(["log20240102"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index" in plan or "PartitionFilters: [(index" in plan
    before = {r["index"]: r["files"] for r in tables.file_counts(table).collect()}
    assert set(before) == {f"log2024010{d}" for d in range(1, 6)} and before["log20240102"] >= 2
    definition = IndexDefinition("log", "log20240102", compaction=True)
    assert not compact_index(IndexDefinition("log", "log20240102"), table, target, 1)
    assert not Path(target).exists()
    assert compact_index(definition, table, target, 1)
    after = tables.read_routed(spark, target)
    assert [tuple(r) for r in tables.file_counts(after).collect()] == [("log20240102", 400, 1)]
    assert sorted(after.collect()) == sorted(table.where("index = 'log20240102'").select(*after.columns).collect())


def test_reports(spark):
    rows = [("w", "ok", 10, 0), ("w", "missing", 20, 500), ("w", "ok", 30, 2000), ("v", "ok", 5, 7)]
    judged = spark.createDataFrame(rows, "writer string, outcome string, bytes long, millis long")
    report = {r["writer"]: r for r in reports.describe_bulk_report(
        reports.bulk_report(judged, "writer", "bytes", "millis")).collect()}
    assert tuple(report["w"])[1:9] == (3, 2, 1, 60, 2000, 1.0, 30.0, 20.0)
    assert (report["w"]["elapsed_text"], report["w"]["bytes_text"], report["w"]["mean_text"]) == ("2 seconds", "60 B", "20.0 B")
    assert (report["w"]["docs_speed_text"], report["w"]["bytes_speed_text"]) == ("1.0 dps", "30.0 B/s")
    assert report["v"]["docs_per_second"] is None and report["v"]["mean_bytes"] == 2.5
    log = spark.createDataFrame([(1, True, 0), (0, True, 0), (0, False, 0), (0, False, 4), (0, False, 1)],
                                "failed_shards int, timed_out boolean, hits long")
    assert reports.search_report(log).first().asDict() == {
        "total": 5, "succeeded": 2, "empty": 1, "failed": 1, "timeout": 1}
