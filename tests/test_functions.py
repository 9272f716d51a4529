"""Text matching, formats, names and mappings against known answers."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from docops.functions import formats, mapping, names, text
from docops.operators import search


@pytest.mark.parametrize(
    "query, hits",
    [("010", 1), (r"0\*0", 1), ("0*0", 1), ("0?0", 1), ("0**0", 1), ("0??0", 0), ("*10", 1), ("*1*", 1),
     (r"*\*0", 0), (r"*\**", 0)],
)
def test_wildcard_counts(spark, query, hits):
    df = spark.createDataFrame([("010",), ("0*0",)], "field string")
    assert df.where(text.matches_wildcard(F.col("field"), query)).count() == hits


def test_matching_equals_token_comparison(spark):
    rng = random.Random(1)
    alphabet = "aB1 .-é*\nß"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(400)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    for query in ("a", "b1", "É", "1 ab", "a-b", "*", ""):
        words = text.query_tokens(query)
        by_tokens = F.exists(text.tokens(F.col("t")), lambda t: t.isin(words)) if words else F.lit(False)
        by_pattern = text.matches_any_token(F.col("t"), query)
        differing = df.where(F.coalesce(by_tokens, F.lit(False)) != F.coalesce(by_pattern, F.lit(False)))
        assert differing.count() == 0, query
    for query, regex in (
        ("a*", "^a.*$"), ("?b", "^.b$"), ("*1?", "^.*1.$"), ("*", "^.+$"), ("a?*b", "^a..*b$"), ("*b", "^.*b$"),
        ("**a**", "^.*a.*$"), ("?", "^.$"), ("ab?", "^ab.$"), ("a*1", "^a.*1$"), ("??*", "^...*$"), ("É*", "^é.*$"),
    ):
        by_tokens = F.exists(text.tokens(F.col("t")), lambda t: t.rlike(regex))
        by_pattern = text.matches_wildcard(F.col("t"), query)
        differing = df.where(F.coalesce(by_tokens, F.lit(False)) != F.coalesce(by_pattern, F.lit(False)))
        assert differing.count() == 0, query


def test_normalized_keyword(spark):
    df = spark.createDataFrame([("1234-ABC-567X",), ("other",)], "field string")
    assert df.where(text.matches_normalized(F.col("field"), " 1234-abc-567x ")).count() == 1


def test_field_query_compares_in_the_type_of_the_field(spark):
    df = spark.createDataFrame([(7, "7"), (8, "07")], "n int, s string")
    assert df.where(search.field_query(df, "n:07")).count() == 1
    assert df.where(search.field_query(df, "s:07")).count() == 1
    assert df.where(search.field_query(df, "n:seven")).count() == 0


def test_exists_on_arrays(spark):
    df = spark.createDataFrame([([1],), ([None],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(search.field_exists(df, "a")).collect()] == [True, False, False, False]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def loop_size(value, units, whole):
    """Size text by repeated division."""
    if value <= 0:
        return None
    if value < 1024:
        return f"{value} {units[0]}"
    at, scaled = 1, value / 1024
    while scaled > 1023:
        scaled /= 1024
        at += 1
    cut = int(scaled * 100) / 100
    return f"{cut} {units[at]}" if at < len(units) else (str(value) if whole else str(cut))


def test_sizes(spark):
    known = {0: None, 5: "5 B", 1023: "1023 B", 1024: "1.0 kB", 1536: "1.5 kB", 1048000: "0.99 MB", -3: None}
    values = list(known) + [1047552, 1047553, 1024**2, 1024**3 - 1, 1024**4 * 7, 2**62, 2**63 - 1, 99_999]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    rows = df.select("v", formats.fmt_size(F.col("v")), formats.fmt_speed(F.col("v")),
                     formats.fmt_doc_speed(F.col("v"))).collect()
    for v, size, speed, docs in rows:
        assert size == loop_size(v, formats.SIZE_UNITS, True), v
        assert speed == loop_size(v, formats.SPEED_UNITS, True), v
        assert docs == loop_size(v, formats.DOC_SPEED_UNITS, True), v
        assert v not in known or size == known[v]


def test_double_sizes(spark):
    values = [0.0, 0.5, 12.25, 1023.5, 1024.0, 1.5e6, 7.7e20, 1.2e26, 1023.0 * 1024**8, 5.0 * 1024**9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, got in df.select("v", formats.fmt_size(F.col("v"), whole=False)).collect():
        assert got == loop_size(v, formats.SIZE_UNITS, False), v


@pytest.mark.parametrize(
    "millis, pattern, want",
    [
        (93_784_005, "d'd 'H:m:s.S", "1d 2:3:4.005"),
        (93_784_005, "H'h'", "26h"),
        (93_784_005, "m s", "1563 4"),
        (93_784_005, "S", "93784005"),
        (93_784_005, "s' sec 'S", "93784 sec 005"),
        (93_784_005, "dd HH", "1 2"),
        (93_784_005, "yMd", "1"),
        (93_784_005, "s s", "93784 "),
        (5, "sS", "0005"),
        (0, "'none'", "none"),
        (7, "", ""),
    ],
)
def test_durations(spark, millis, pattern, want):
    assert one(spark, formats.fmt_duration(F.lit(millis), pattern)) == want


def words(millis, lead, trail):
    """Duration words by dropping zero parts from the ends of the list."""
    amounts = [millis // 86_400_000, millis // 3_600_000 % 24, millis // 60_000 % 60, millis // 1000 % 60]
    parts = [(a, f"{a} {n}{'' if a == 1 else 's'}") for a, n in zip(amounts, ("day", "hour", "minute", "second"))]
    if lead:
        parts = list(itertools.dropwhile(lambda p: p[0] == 0, parts))
    if trail:
        while len(parts) > (0 if lead else 1) and parts[-1][0] == 0:
            parts.pop()
    return " ".join(p[1] for p in parts)


def test_duration_words(spark):
    rng = random.Random(2)
    values = [0, 60_000, 3_605_000, 86_400_000, 90_000_000, 3_600_000, 1_000, 999] + [
        rng.randrange(10**rng.randrange(3, 10)) for _ in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for lead, trail in itertools.product((True, False), repeat=2):
        for v, got in df.select("v", formats.fmt_duration_words(F.col("v"), lead, trail)).collect():
            assert got == words(v, lead, trail), (v, lead, trail)
    assert one(spark, formats.fmt_duration_words(F.lit(3_605_000), True, True)) == "1 hour 0 minutes 5 seconds"
    assert one(spark, formats.fmt_duration_words(F.lit(0), True, True)) == ""


def test_names(spark):
    df = spark.sql("select timestamp_ntz'2024-02-29 23:59:59.9999' n, timestamp'2024-02-29 23:59:59.9999 UTC' z")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for column in ("n", "z"):
                row = df.select(names.dated_name(df, "log", column), names.utc_millis(df, column)).first()
                assert tuple(row) == ("log20240229", 1709251199999), (zone, column)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert one(spark, names.base_of(F.lit("test20160101"))) == "test"
    assert one(spark, names.suffix_of(F.lit("test0007"))) == 7
    assert one(spark, names.suffix_of(F.lit("test"))) is None


MAPPING = """{"properties": {
  "name": {"type": "keyword"},
  "location": {"type": "geo_point"},
  "point": {"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": "integer"}}},
  "isbn": {"type": "standardnumber", "properties": {"hidden": {"type": "keyword"}}},
  "raw": {"type": "text", "index": "no"},
  "plain": {"properties": {"deep": {"type": "double"}, "off": {"type": "long", "index": false}}}}}"""


def test_mapping_schema_and_paths():
    schema = mapping.mapping_schema(MAPPING)
    assert schema["name"].dataType == StringType()
    assert isinstance(schema["location"].dataType, StructType)
    assert schema["point"].dataType["x"].dataType == IntegerType()
    assert schema["isbn"].dataType == StringType()
    assert schema["plain"].dataType["deep"].dataType == DoubleType()
    assert mapping.typed_paths(MAPPING) == ["isbn", "location", "name", "plain.deep", "point", "point.x", "point.y"]
    assert mapping.field_names(MAPPING) == ["isbn", "location", "name", "plain", "point", "raw"]
    assert mapping.typed_paths({}) == [] and mapping.field_names(None) == []


def test_leaf_map(spark):
    df = spark.sql("select named_struct('a', 1, 'b', named_struct('c', 'x', 'd', cast(null as int))) s")
    assert df.select(mapping.leaf_map(F.col("s"), df.schema["s"].dataType)).first()[0] == {"a": "1", "b.c": "x"}
