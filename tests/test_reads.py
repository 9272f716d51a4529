"""Cursors, keyed and routed tables, lists and deep paths of JSON documents."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docops.operators import catalog, keyed, profile, search
from docops.sources import tables
from docops.sources.json_ingest import ingest_json_lists


def null_rows(seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "é"]), n) for n in range(90)]


@pytest.mark.parametrize("order", [["a", "b", "n"], ["-a", "b", "-n"], ["-b", "-a", "n"], ["b", "-n"]])
def test_pages_by_cursor_equal_the_order(spark, order):
    df = spark.createDataFrame(null_rows(), "a int, b string, n long").repartition(3)
    want = [tuple(r) for r in df.orderBy(*[F.col(o[1:]).desc() if o[0] == "-" else F.col(o) for o in order]).collect()]
    got, cursor = [], None
    for _ in range(20):
        page = search.scroll_page(df, order, 13, cursor)
        got += [tuple(r) for r in page.collect()]
        cursor = search.cursor_of(page, order)
        if cursor is None:
            break
    assert got == want
    rest = df.where(search.after(df, order, want_values(want[40], order)))
    assert sorted(map(repr, map(tuple, rest.collect()))) == sorted(map(repr, want[41:]))


def want_values(row, order):
    return tuple(row["abn".index(o.removeprefix("-"))] for o in order)


def test_cursor_is_pushed_to_the_scan(spark, tmp_path, capsys):
    spark.range(1000).selectExpr("id", "id % 7 AS a").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    search.scroll_page(df, ["id", "a"], 5, (900, 3)).explain()
    assert "GreaterThanOrEqual(id,900)" in capsys.readouterr().out
    with pytest.raises(ValueError):
        search.after(df, ["id"], (1, 2))


def rows_scanned(df):
    """Rows that the file scans of ``df`` handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()

    def leaves(node):
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            return leaves(node.plan())
        below = [node.children().apply(i) for i in range(node.children().size())]
        return [node] if not below else [leaf for child in below for leaf in leaves(child)]

    found = [n for n in leaves(plan) if n.getClass().getSimpleName() == "FileSourceScanExec"]
    return sum(n.metrics().apply("numOutputRows").value() for n in found)


def test_point_reads_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "keyed")
    wide = spark.range(40_000).select(
        F.concat(F.lit("k"), F.sha2(F.col("id").cast("string"), 256)).alias("name"),
        F.col("id").alias("n"),
        F.repeat(F.sha2(F.col("id").cast("string"), 512), 2).alias("filler"),
    )
    tables.write_keyed(wide, path, "name", files=4, group_bytes=256 << 10)
    table = spark.read.parquet(path)
    docs = keyed.with_document_key(table, F.lit("i"), "name")
    some = [r["name"] for r in table.where("n IN (5, 17, 39999)").collect()]
    asked = [("i", name) for name in [*some, "k", some[0], "absent"]] + [("other", some[1]), ("i", None)]
    requests = spark.createDataFrame(asked, "index string, id string")
    found = keyed.multi_get(docs, requests, ["n"], stored="name")
    assert sorted(r["n"] for r in found.where("found").collect()) == sorted([5, 17, 39999, found.where(F.col("id") == some[0]).first()["n"]])
    assert found.count() == len(asked)
    assert keyed.exists(docs, requests, stored="name").where("exists").count() == 4
    assert rows_scanned(table.where(keyed.any_of(table, "name", some))) < 8_000
    assert rows_scanned(table.where(keyed.any_of(table, "name", ["absent", None]))) < 8_000


def test_ids_are_compared_in_their_own_type(spark):
    table = spark.createDataFrame([(n, f"v{n}") for n in range(30)], "doc long, v string")
    docs = keyed.with_document_key(table, F.lit("i"), "doc")
    asked = spark.createDataFrame([("i", t) for t in ("7", "007", "x", "29", None, "3")], "index string, id string")
    plain = keyed.multi_get(docs, asked, ["v"])
    stored = keyed.multi_get(docs, asked, ["v"], stored="doc")
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, plain.collect()))
    assert {r["id"] for r in stored.where("found").collect()} == {"7", "29", "3"}


@pytest.mark.parametrize("bound", [0, 2, 100])
def test_many_ids_are_joined(spark, monkeypatch, bound):
    monkeypatch.setattr(keyed, "PUSHED_IDS", bound)
    table = spark.range(50).withColumnRenamed("id", "doc")
    docs = keyed.with_document_key(table, F.lit("i"), "doc")
    asked = spark.createDataFrame([("i", str(n)) for n in range(45, 55)], "index string, id string")
    assert keyed.exists(docs, asked, stored="doc").where("exists").count() == 5


def routed(spark, path):
    rows = [(f"logs2024010{day}", n) for day in range(1, 6) for n in range(20)] + [(None, 7)]
    tables.write_routed(spark.createDataFrame(rows, "index string, n long"), path)
    return tables.read_routed(spark, path)


def spoil(path, kept):
    """Makes every directory but the kept ones unreadable."""
    for file in path.glob("index=*/*.parquet"):
        if file.parent.name.removeprefix("index=") not in kept:
            file.write_bytes(b"no parquet")


def test_named_indices_are_all_that_is_read(spark, tmp_path, capsys):
    table = routed(spark, str(tmp_path / "t"))
    chosen = table.where(search.in_indices(["logs20240102", "logs20240105", "absent"]))
    chosen.explain("formatted")
    assert "PartitionFilters: [index" in capsys.readouterr().out.replace("isnotnull(index#", "index#")
    spoil(tmp_path / "t", ["logs20240102", "logs20240105"])
    assert chosen.groupBy("index").count().count() == 2 and chosen.count() == 40
    with pytest.raises(Exception):
        table.count() and table.collect()


@pytest.mark.parametrize("listed", [0, 100])
def test_open_indices_prune_the_table(spark, tmp_path, capsys, listed):
    table = routed(spark, str(tmp_path / "t"))
    states = [(f"logs2024010{day}", "OPEN" if day in (1, 4) else "CLOSE") for day in range(1, 6)] + [(None, "OPEN")]
    spark.createDataFrame(states, "index string, state string").write.parquet(str(tmp_path / "catalogue"))
    rows = catalog.scan_open(table, spark.read.parquet(str(tmp_path / "catalogue")), listed)
    rows.explain("formatted")
    plan = capsys.readouterr().out
    assert ("dynamicpruning" in plan) == (listed == 0)
    spoil(tmp_path / "t", ["logs20240101", "logs20240104"])
    assert {(r["index"], r["count"]) for r in rows.groupBy("index").count().collect()} == {
        ("logs20240101", 20), ("logs20240104", 20)}


MAPPING = {
    "properties": {
        "n": {"type": "long"},
        "w": {"type": "keyword"},
        "p": {"type": "geo_point"},
        "person": {"properties": {"name": {"type": "keyword"}, "age": {"type": "integer"}}},
    }
}


def test_fields_hold_one_value_or_several(spark):
    cases = [
        ('{"n":5,"w":"a","person":{"name":"x","age":"7"}}', ([5], ["a"], [], [(["x"], [7])]), False),
        ('{"n":["5",6,null],"w":["a",3],"person":[{"name":"x"},{"name":["y","z"],"age":[1,2]}]}',
         ([5, 6], ["a", "3"], [], [(["x"], []), (["y", "z"], [1, 2])]), False),
        ('{"n":"five"}', ([None], [], [], []), True),
        ('{"w":{"a":1}}', ([], [None], [], []), True),
        ('{"person":3}', ([], [], [], [None]), True),
        ('{"person":[{"age":"old"}]}', ([], [], [], [([], [None])]), True),
        ('{"n":[[1]]}', ([None], [], [], []), True),
        ("{}", ([], [], [], []), False),
        ('{"n":null,"person":null}', ([], [], [], []), False),
        ('{"p":[2,1.5]}', ([], [], [(1.5, 2.0)], []), False),
        ('{"p":["1,2",{"lat":3,"lon":4},[5,6]]}', ([], [], [(1.0, 2.0), (3.0, 4.0), (6.0, 5.0)], []), False),
        ('{"p":"north"}', ([], [], [None], []), True),
        ('{"n":', None, True),
        ("[1]", None, True),
        ("7", None, True),
        (None, None, False),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    rows = ingest_json_lists(df, "t", MAPPING, "bad").orderBy("i").collect()

    def plain(value):
        if isinstance(value, list):
            return [plain(v) for v in value]
        return tuple(plain(v) for v in value) if isinstance(value, tuple) else value

    for row, (text, doc, bad) in zip(rows, cases):
        assert (plain(row["doc"]) if row["doc"] is not None else None, row["bad"]) == (doc, bad), text


def walk(value, path=""):
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in walk(v, f"{path}.{k}" if path else k)}
    if isinstance(value, list):
        return {p for v in value for p in walk(v, path)}
    return set() if value is None else {path}


@pytest.mark.parametrize("rounds", [1, 4])
def test_paths_at_every_depth(spark, rounds):
    rng = random.Random(3)

    def made(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind < 3:
            return [rng.randrange(9), "text", None][kind]
        if kind == 3:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return {name: made(depth - 1) for name in rng.sample(["a", "b", "c d"], rng.randrange(4))}

    values = [made(7) for _ in range(200)] + [{"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": {"i": [1]}}}}}}}}}]
    want = Counter(p for v in values for p in walk(v))
    texts = [json.dumps(v) for v in values] + ["{", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["path"]: r["docs"] for r in profile.observed_paths(df, "t", rounds).collect()} == want
    assert profile.observed_paths(df.limit(0), "t").count() == 0


@pytest.mark.parametrize("ranges", [2_000_000, 300])
@pytest.mark.parametrize("order", [["-few", "a"], ["a"], ["few"], ["-id"]])
def test_deep_pages_equal_the_whole_order(spark, monkeypatch, order, ranges):
    monkeypatch.setattr(search, "TOP_ROWS", 10)
    monkeypatch.setattr(search, "RANGE_ROWS", ranges)
    df = spark.range(2_000).selectExpr(
        "id", "if(id % 7 = 0, null, id % 3) AS few", "id * 37 % 500 AS a", "cast(id % 5 AS string) AS other"
    )
    tied = df.withColumn("_tie", search.row_hash(df))
    whole = [r["id"] for r in tied.orderBy(*search.order_columns([*order, "_tie"])).collect()]
    for start in (11, 1_990, 2_000):
        got = [r["id"] for r in search.page(df, order, start, 25).collect()]
        assert got == whole[start : start + 25]


@pytest.mark.parametrize("unique", [True, False])
def test_deep_page_reads_the_order_and_the_result_only(spark, tmp_path, unique):
    path = str(tmp_path / "rows")
    spark.range(5_000).selectExpr("id", "id % 11 AS few", "id * 7 AS shown", "repeat('x', 50) AS wide").write.parquet(path)
    page = search.page(spark.read.parquet(path), ["-few", "id"], 2_000, 10, unique=unique).select("id", "shown")
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan and "shown" in plan
    by = sorted(range(5_000), key=lambda i: (-(i % 11), i))
    assert [tuple(r) for r in page.collect()] == [(i, i * 7) for i in by[2_000:2_010]]
