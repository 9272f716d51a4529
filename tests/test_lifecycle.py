"""Aliases, catalogue, retention and profiles against known answers."""

import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from docops.definitions import IndexDefinition
from docops.operators import aliases, catalog, lifecycle, profile, retention
from docops.plans import skew
from docops.sources.versions import VersionConflictError, VersionedTables

ALIAS = "alias string, index string, filter_field string, filter_value string"
STATE = "index string, state string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), ALIAS)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def only(df):
    return {r[0] for r in df.collect()}


@pytest.fixture
def known(spark):
    return spark.createDataFrame([("test_shift", "OPEN"), ("test_shift2", "OPEN")], STATE)


def test_two_shifts(spark, known):
    first = IndexDefinition("test", "test_shift", shift=True)
    shift = lifecycle.shift_index(first, table(spark), known, ["a", "b", "c", "", None])
    assert only(shift.new()) == {"test", "a", "b", "c"} and only(shift.moved()) == set()
    assert as_set(shift.aliases) == {(a, "test_shift", None, None) for a in ("test", "a", "b", "c")}
    # A later shift whose new aliases are filtered by their own name.
    second = IndexDefinition("test", "test_shift2", shift=True)
    adder = lambda index, alias: (F.lit("my_key"), alias)
    shift = lifecycle.shift_index(second, shift.aliases, known, ["d", "e", "f"], adder)
    assert only(shift.new()) == {"d", "e", "f"} and only(shift.moved()) == {"test", "a", "b", "c"}
    assert as_set(shift.aliases) == {(a, "test_shift2", None, None) for a in ("test", "a", "b", "c")} | {
        (a, "test_shift2", "my_key", a) for a in ("d", "e", "f")}
    # Filters move along; an extra that moves is reported once and keeps its filter.
    third = IndexDefinition("test", "test_shift3", shift=True)
    shift = lifecycle.shift_index(third, shift.aliases, known, ["d"])
    assert sorted(r["alias"] for r in shift.plan.collect()) == ["a", "b", "c", "d", "e", "f", "test"]
    assert ("d", "test_shift3", "my_key", "d") in as_set(shift.aliases)


@pytest.mark.parametrize(
    "definition, extras",
    [
        (IndexDefinition("test", "test2", shift=False), []),
        (IndexDefinition("test", "test2", shift=True, enabled=False), []),
        (IndexDefinition("test", "test", shift=True), []),
        (IndexDefinition(None, "test2", shift=True), []),
        (IndexDefinition("test", "test2", shift=True), None),
    ],
)
def test_nothing_shifts(spark, known, definition, extras):
    before = table(spark, ("test", "test1", None, None))
    shift = lifecycle.shift_index(definition, before, known, extras)
    assert shift.plan.count() == 0 and as_set(shift.aliases) == as_set(before)


def test_shift_leaves_other_indices_alone_and_closes_old(spark):
    before = table(
        spark,
        ("t", "t1", None, None), ("t", "t2", None, None), ("x", "t1", "f", "v"), ("x", "t2", None, None),
        ("x", "t3", None, None), ("u", "u1", None, None),
    )
    known = spark.createDataFrame([(i, "OPEN") for i in ("t1", "t2", "t3", "u1")], STATE)
    shift = lifecycle.shift_index(IndexDefinition("t", "t3", shift=True, close_shifted=True), before, known, [])
    assert as_set(shift.aliases) == {
        ("t", "t2", None, None), ("x", "t2", None, None), ("t", "t3", None, None), ("x", "t3", "f", "v"),
        ("u", "u1", None, None)}
    assert as_set(shift.catalog.select("index", "state")) == {
        ("t1", "CLOSE"), ("t2", "CLOSE"), ("t3", "OPEN"), ("u1", "OPEN")}


def test_alias_lookup(spark):
    rows = table(spark, *[("test", f"test2016010{d}", None, None) for d in (2, 3, 1)], ("test", "other", "f", "v"))
    assert [r[0] for r in aliases.resolve_alias(rows, "test").collect()] == [
        "other", "test20160101", "test20160102", "test20160103"]
    assert aliases.resolve_alias(rows, "none").count() == 0
    wanted = spark.createDataFrame([("test",), ("none",)], "alias string")
    assert as_set(aliases.most_recent_index(rows, wanted).select("alias", "index")) == {
        ("test", "test20160103"), ("none", "none")}
    assert as_set(aliases.aliases_of(rows, "other")) == {("test", "f", "v")}


@pytest.mark.parametrize("bound", [200_000, 1])
def test_alias_scan_applies_each_filter(spark, monkeypatch, bound):
    """The same rows whether the sides are broadcast or joined by shuffle."""
    monkeypatch.setattr(skew.checked_broadcast, "__defaults__", (bound,))
    docs = spark.createDataFrame([("i1", 1, "x"), ("i1", 2, "y"), ("i2", 3, "y"), ("i3", 4, "y")],
                                 "index string, n int, kind string")
    rows = table(spark, ("all", "i1", None, None), ("all", "i2", None, None), ("some", "i1", "kind", "y"),
                 ("some", "i3", "n", "4"), ("bad", "i1", "missing", "y"))
    seen = aliases.scan_aliases(docs, rows, ["kind", "n"]).select("alias", "n")
    assert as_set(seen) == {("all", 1), ("all", 2), ("all", 3), ("some", 2), ("some", 4)}
    assert only(aliases.scan_alias(docs, rows, "some").select("n")) == {2, 4}
    assert only(aliases.scan_alias(docs, rows, "all").select("n")) == {1, 2, 3}
    assert aliases.scan_alias(docs, rows, "unknown").count() == 0


def test_alias_scan_shows_a_document_once_and_compares_in_the_type_of_the_field(spark):
    docs = spark.createDataFrame([("i1", 1, 1.0), ("i1", 2, 2.5), (None, 3, 1.0)], "index string, n int, v double")
    rows = table(spark, ("a", "i1", "n", "1"), ("a", "i1", "v", "1"), ("a", "i1", "n", "1"), ("b", "i1", None, None),
                 ("b", "i1", "n", "2"), ("c", "i1", "v", "none"), ("c", "i1", "v", None), ("d", None, None, None))
    seen = [tuple(r) for r in aliases.scan_aliases(docs, rows, ["n", "v"]).select("alias", "n").collect()]
    assert sorted(seen) == [("a", 1), ("b", 1), ("b", 2)]
    assert [r["n"] for r in aliases.scan_alias(docs, rows, "a").collect()] == [1]


def test_null_names_drop_and_keep_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([("j", 1), ("k", 2), (None, 3)], "index string, n int")
    names = spark.createDataFrame([("j",), (None,)], "index string")
    for bound in (10_000, 0):
        monkeypatch.setattr(catalog, "PRUNING_NAMES", bound)
        assert only(catalog.drop_indices(docs, names).select("n")) == {2, 3}
        assert only(catalog.keep_indices(docs, names).select("n")) == {1}
    assert only(catalog.drop_indices(docs, ["j", None]).select("n")) == {2, 3}


def test_two_rules_on_one_base_do_not_mix(spark):
    known = spark.createDataFrame([(f"b{n}", "OPEN") for n in range(1, 7)], STATE)
    one = [retention.Retention("b", "b6", 3, 2)]
    other = [retention.Retention("b", "b5", 100, 1)]
    alone = as_set(retention.plan_retention(known, one).where("action = 'delete'").select("index"))
    both = as_set(retention.plan_retention(known, one + other).where("action = 'delete'").select("index"))
    assert alone == both and as_set(retention.plan_retention(known, other).where("action = 'delete'")) == set()


def prune_loop(names, rule):
    """Retention, one candidate after the other."""
    if not rule.applies():
        return None
    pattern = re.compile(r"^(.*?)(\d+)$")
    found = sorted(n for n in names if (m := pattern.match(n)) and m[1] == rule.base and n != rule.full)
    if not found:
        return None
    gone = []
    current = pattern.match(rule.full)
    if current and not (rule.min_to_keep > 0 and len(found) <= rule.min_to_keep):
        for name in found:
            distance = int(current[2]) - int(pattern.match(name)[2])
            far = rule.delta == 0 or (rule.delta > 0 and distance >= rule.delta)
            if far and rule.min_to_keep <= len(found) - len(gone):
                gone.append(name)
    return set(found), set(gone)


def test_retention_equals_the_loop(spark):
    rng = random.Random(4)
    names, rules = set(), []
    for n in range(60):
        base = f"b{'x' * (n % 3)}_{n}_"
        for _ in range(rng.randrange(1, 9)):
            names.add(base + rng.choice(["", "0", "00"]) + str(rng.randrange(1, 30)))
        full = base + rng.choice([str(rng.randrange(1, 40)), "now"])
        rules.append(retention.Retention(base, full, rng.choice([-1, 0, 1, 2, 5]), rng.randrange(0, 5)))
    known = spark.createDataFrame([(n, "OPEN") for n in names], STATE)
    planned = retention.plan_retention(known, rules)
    got = {}
    for base, index, action in planned.collect():
        got.setdefault(base, (set(), set()))[0].add(index)
        if action == "delete":
            got[base][1].add(index)
    states = {r["base"]: r for r in retention.retention_result(planned, rules).collect()}
    deletions = 0
    for rule in rules:
        want = prune_loop(names, rule)
        assert got.get(rule.base) == want, rule
        assert states[rule.base]["state"] == ("NONE" if want is None else "SUCCESS")
        deletions += len(want[1]) if want else 0
    assert deletions > 30


def test_prune_four_indices(spark):
    known = spark.createDataFrame([(f"test_prune{i}", "OPEN") for i in range(1, 5)], STATE)
    definition = IndexDefinition("test_prune", "test_prune4", shift=True, prune=True, delta=2, min_to_keep=2)
    planned, result = lifecycle.prune_index(definition, known)
    assert as_set(planned.select("index", "action")) == {
        ("test_prune1", "delete"), ("test_prune2", "delete"), ("test_prune3", "keep")}
    assert result.first().asDict() == {"base": "test_prune", "state": "SUCCESS", "candidates": 3, "deleted": 2}
    docs = spark.createDataFrame([(f"test_prune{i}",) for i in range(1, 5)], "index string")
    assert only(retention.apply_retention(docs, planned)) == {"test_prune3", "test_prune4"}
    closed = known.withColumn("state", F.when(F.col("index") == "test_prune4", "OPEN").otherwise("CLOSE"))
    assert lifecycle.prune_index(definition, closed)[1].first()["state"] == "NONE"
    assert lifecycle.prune_index(None, known)[1].count() == 0
    off = IndexDefinition("test_prune", "test_prune4", prune=True, delta=2, min_to_keep=2, enabled=False)
    assert lifecycle.prune_index(off, known)[1].first()["state"] == "NONE"


def test_catalog_states(spark):
    docs = spark.createDataFrame([("a1", 5), ("a1", 3), ("a2", 9)], "index string, ts long")
    states = spark.createDataFrame([("a2", "CLOSE")], STATE)
    known = catalog.build_catalog(docs, "ts", states)
    assert as_set(known) == {("a1", 2, 3, "OPEN"), ("a2", 1, 9, "CLOSE")}
    wanted = spark.createDataFrame([("a1",), ("a2",), ("zz",)], "index string")
    assert as_set(catalog.index_state(known, wanted)) == {
        ("a1", True, "OPEN", True, False), ("a2", True, "CLOSE", False, True), ("zz", False, None, False, False)}
    assert only(catalog.closed_indices(known, F.lit(9))) == set()
    assert only(catalog.closed_indices(known, F.lit(10))) == {"a2"}
    assert catalog.purge_closed(docs, known).count() == 2
    reopened = catalog.with_state(known, wanted, catalog.OPEN)
    assert catalog.scan_open(docs, known).count() == 2 and catalog.scan_open(docs, reopened).count() == 3
    assert catalog.drop_indices(docs, ["a1", "nope"]).count() == 1
    assert catalog.drop_indices(docs, wanted.where("index = 'a2'")).count() == 2


def test_many_names_join_instead_of_a_list(spark, monkeypatch):
    docs = spark.createDataFrame([("a1", 5), ("a2", 9)], "index string, ts long")
    names = spark.createDataFrame([("a1",), ("a3",)], "index string")
    monkeypatch.setattr(catalog, "PRUNING_NAMES", 1)
    assert only(catalog.keep_indices(docs, names).select("index")) == {"a1"}
    assert only(catalog.drop_indices(docs, names).select("index")) == {"a2"}


def test_most_recent_document(spark):
    docs = spark.sql("select 'i1' index, timestamp_ntz'2024-01-01 00:00:01.5' ts union all select 'i2', null")

    def newest(full, enabled=True):
        return lifecycle.most_recent_document(IndexDefinition("i", full, enabled=enabled), docs, "ts").first()[0]

    assert newest("i1") == 1704067201500 and newest("i2") == 0 and newest("i3") == -1 and newest("i1", False) == -1
    definition = IndexDefinition("i", "i1")
    assert lifecycle.searchable_docs(definition, docs).first()[0] == 1
    assert lifecycle.searchable_docs(IndexDefinition("i", "i1", enabled=False), docs).first()[0] == -1


def test_field_coverage(spark):
    docs = spark.sql(
        """select 'i1' index, 'n' name, named_struct('x', 1, 'y', cast(null as int)) point, array(cast(null as int)) tags
           union all select 'i1', null, named_struct('x', 2, 'y', 3), array(1)
           union all select 'i1', 'm', null, null"""
    )
    mapped = {"properties": {
        "name": {"type": "keyword"}, "point": {"type": "object", "properties": {
            "x": {"type": "integer"}, "y": {"type": "integer"}, "z": {"type": "integer"}}},
        "tags": {"type": "integer"}, "unused": {"type": "keyword"}, "hidden": {"type": "keyword", "index": False}}}
    coverage = lifecycle.check_mapping(IndexDefinition("i", "i1", mapping=mapped), docs)
    assert [(r["path"], r["docs"], round(r["percent"], 2)) for r in coverage.collect()] == [
        ("point.z", 0, 0.0), ("unused", 0, 0.0), ("point.y", 1, 33.33), ("tags", 1, 33.33),
        ("name", 2, 66.67), ("point", 2, 66.67), ("point.x", 2, 66.67)]
    assert tuple(profile.coverage_summary(coverage).first()) == (7, 2)
    assert lifecycle.check_mapping(IndexDefinition("i", "i9", mapping=mapped), docs).count() == 0
    assert lifecycle.check_mapping(IndexDefinition("i", "i1", mapping=mapped, enabled=False), docs).count() == 0


def test_definition_from_settings():
    at = datetime(2024, 3, 4, tzinfo=timezone.utc)
    plain = IndexDefinition.from_settings("a", {"name": "b", "prune": True}, at)
    assert (plain.full_name, plain.shift, plain.prune, plain.compaction) == ("b", False, False, True)
    dated = IndexDefinition.from_settings("a", {"shift": "true", "prune": "true", "closeShifted": True}, at)
    assert (dated.full_name, dated.close_shifted) == ("a20240304", True)
    assert dated.retention() == retention.Retention("a", "a20240304", 2, 2, True)
    assert not IndexDefinition.dated("a", at).compaction
    hourly = IndexDefinition.from_settings("a", {"shift": True, "dateTimeFormat": "yyyy.MM.dd.HH"}, at)
    assert hourly.full_name == "a2024.03.04.00"
    with pytest.raises(ValueError):
        IndexDefinition.from_settings("a", {"shift": True, "dateTimeFormat": "EEE"}, at)


def test_routing_by_definition(spark):
    df = spark.sql("select timestamp_ntz'2024-03-04 05:06:07' ts")
    hourly = IndexDefinition.from_settings("a", {"shift": True, "dateTimeFormat": "yyyyMMddHH"})
    assert only(lifecycle.route_rows(hourly, df, "ts").select("index")) == {"a2024030405"}
    assert lifecycle.route_rows(IndexDefinition("a", "a1", enabled=False), df, "ts").count() == 0


def metadata_of(spark, root, rows, states):
    metadata = VersionedTables(spark, str(root))
    known = spark.createDataFrame(states, STATE)
    assert metadata.commit({aliases.ALIASES: table(spark, *rows), aliases.CATALOG: known}, metadata.latest()) == 0
    return metadata


def test_a_shift_is_committed_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    rows = [("t", "t1", None, None), ("x", "t1", "f", "v"), ("u", "u1", None, None)]
    metadata = metadata_of(spark, tmp_path / "m", rows, [("t1", "OPEN"), ("t2", "OPEN"), ("u1", "OPEN")])
    shifts = spark.createDataFrame([("t", "t2"), ("u", "u"), (None, "t2")], "base string, full string")
    old = metadata.read(aliases.ALIASES, metadata.latest())

    def interrupted(self, source, target):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTables, "_rename", interrupted)
        with pytest.raises(RuntimeError):
            aliases.commit_shift(metadata, shifts, close=True)
    assert metadata.latest() == 0 and as_set(metadata.read(aliases.ALIASES, 0)) == set(rows)

    assert aliases.commit_shift(metadata, shifts, close=True) == 1 == metadata.latest()
    assert as_set(metadata.read(aliases.ALIASES, 1)) == {
        ("t", "t2", None, None), ("x", "t2", "f", "v"), ("u", "u1", None, None)}
    assert as_set(metadata.read(aliases.CATALOG, 1)) == {("t1", "CLOSE"), ("t2", "OPEN"), ("u1", "OPEN")}
    assert metadata.read(aliases.PLAN, 1).count() == 2
    # A reader that began before the shift still has all of its version.
    assert as_set(old) == set(rows)


def test_of_two_writers_one_fails(spark, tmp_path):
    metadata = metadata_of(spark, tmp_path / "m", [("t", "t1", None, None)], [("t1", "OPEN")])
    second = VersionedTables(spark, str(tmp_path / "m"))
    mine, theirs = ({"aliases": table(spark, ("t", i, None, None))} for i in ("t2", "t3"))
    assert metadata.commit(mine, 0) == 1
    with pytest.raises(VersionConflictError):
        second.commit(theirs, 0)
    assert second.latest() == 1 and as_set(second.read("aliases", 1)) == {("t", "t2", None, None)}


def test_no_version_before_the_first(spark, tmp_path):
    metadata = VersionedTables(spark, str(tmp_path / "none"))
    assert metadata.latest() is None
    with pytest.raises(ValueError):
        aliases.commit_shift(metadata, spark.createDataFrame([], "base string, full string"))
