"""Inputs the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docops.functions.names import utc_millis
from docops.operators.aliases import ALIAS_ROW
from docops.operators.catalog import CLOSE, OPEN, build_catalog
from docops.operators.changelog import CREATE, DELETE, INDEX, UPDATE
from docops.operators.keyed import with_document_key
from docops.session import scratch_path
from docops.sources.tables import load_table, read_routed, route, write_routed

FIRST_OPEN = "events20240111"
LAST_DAY = "events20240130"
NEXT_DAY = "events20240131"


def docs(spark: SparkSession, directory: str) -> DataFrame:
    table = load_table(spark, directory, "documents")
    return with_document_key(table, F.concat(F.lit("documents_"), "lang"), "doc_id")


def dated_events(spark: SparkSession, directory: str) -> DataFrame:
    return route(load_table(spark, directory, "events"), "events", "ts")


def dated_orders(spark: SparkSession, directory: str) -> DataFrame:
    return route(load_table(spark, directory, "orders"), "orders", "o_orderdate")


def to_operations(events: DataFrame) -> DataFrame:
    """Events as a change log of one document per user, with bytes and time for the reports."""
    kind = F.col("event_type")
    op = (
        F.when(kind == "signup", CREATE)
        .when(kind == "purchase", INDEX)
        .when(kind.isin("click", "view"), UPDATE)
        .otherwise(DELETE)
    )
    value, k = F.col("value").cast("string"), F.get_json_object("props", "$.k")
    source = (
        F.when(kind.isin("signup", "purchase"), F.create_map(F.lit("value"), value, F.lit("k"), k))
        .when(kind == "click", F.create_map(F.lit("value"), value))
        .when(kind == "view", F.create_map(F.lit("k"), k))
    )
    return events.select(
        F.col("event_id").alias("seq"),
        F.lit("users").alias("index"),
        F.col("user_id").cast("string").alias("id"),
        op.alias("op"),
        source.alias("source"),
        F.round(F.col("value") * 100).cast("long").alias("bytes"),
        utc_millis(events, "ts").alias("millis"),
    )


def oplog(spark: SparkSession, directory: str) -> DataFrame:
    return to_operations(load_table(spark, directory, "events"))


def flat_documents(documents: DataFrame, *more: str) -> DataFrame:
    """Documents of the change log with their two fields as columns."""
    return documents.select(
        "index",
        "id",
        *more,
        *[c for c in ("last_seq", "seq") if c in documents.columns],
        F.try_element_at("source", F.lit("value")).cast("double").alias("value"),
        F.try_element_at("source", F.lit("k")).cast("long").alias("k"),
    )


def nested_events(spark: SparkSession, directory: str) -> DataFrame:
    """Events with a JSON document of one of four shapes: plain, arrays, deep, and one that does not fit."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")

    def text(template: str):
        return F.replace(F.replace(F.lit(template), F.lit("K"), k), F.lit("T"), kind)

    shape = F.pmod("event_id", F.lit(4))
    doc = (
        F.when(shape == 0, text('{"k":K,"person":{"name":"T","n":"K"}}'))
        .when(shape == 1, text('{"k":["K",K],"person":[{"name":"T","n":K},{"name":["x","T"],"n":[K,"K"]}]}'))
        .when(shape == 2, text('{"k":null,"person":[],"deep":{"a":[{"b":{"c":[K]}},{"b":{"d":{"e":{"f":"T"}}}}]}}'))
        .otherwise(text('{"k":"T","person":"T"}'))
    )
    return load_table(spark, directory, "events").select("event_id", doc.alias("doc_text"))


def routed_events(spark: SparkSession, directory: str) -> DataFrame:
    """Events written to one directory for each day, and read from there."""
    path = scratch_path(spark, "routed")
    write_routed(dated_events(spark, directory).select("index", "event_id", "event_type"), path)
    return read_routed(spark, path)


def catalog(spark: SparkSession, directory: str) -> DataFrame:
    """Daily event indices, the first ten days closed."""
    built = build_catalog(dated_events(spark, directory), "ts")
    return built.withColumn("state", F.when(F.col("index") < FIRST_OPEN, CLOSE).otherwise(OPEN))


def order_catalog(spark: SparkSession, directory: str) -> DataFrame:
    return build_catalog(dated_orders(spark, directory), "o_orderdate")


def event_aliases(spark: SparkSession, directory: str) -> DataFrame:
    """Alias ``events`` on every day; one filtered alias per event type on the last day."""
    events = dated_events(spark, directory)
    nothing = F.lit(None).cast("string")
    daily = events.select("index").distinct().select(
        F.lit("events").alias("alias"), "index", nothing.alias("filter_field"), nothing.alias("filter_value")
    )
    last = events.agg(F.max("index").alias("index")).scalar()
    typed = events.select("event_type").distinct().select(
        F.concat(F.lit("events_"), "event_type").alias("alias"),
        last.alias("index"),
        F.lit("event_type").alias("filter_field"),
        F.col("event_type").alias("filter_value"),
    )
    return daily.unionByName(typed)


def customer_aliases(spark: SparkSession, directory: str) -> DataFrame:
    """Per nation a dated index with its base alias and one filtered alias per customer; suppliers apart."""
    customer = load_table(spark, directory, "customer")
    nothing = F.lit(None).cast("string")
    base = F.concat(F.lit("nation_"), "c_nationkey")
    index = F.concat(base, F.lit("_v20240101"))
    bases = customer.select(base.alias("alias"), index.alias("index")).distinct()
    named = customer.select(
        F.col("c_name").alias("alias"),
        index.alias("index"),
        F.lit("c_custkey").alias("filter_field"),
        F.col("c_custkey").cast("string").alias("filter_value"),
    )
    suppliers = load_table(spark, directory, "supplier").select(
        F.col("s_name").alias("alias"), F.lit("suppliers").alias("index")
    )
    plain = bases.unionByName(suppliers)
    return (
        plain.withColumn("filter_field", nothing).withColumn("filter_value", nothing).unionByName(named)
    ).select(*ALIAS_ROW)


def nation_shifts(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """The next dated index of every nation, and extra aliases: its market segments and builders."""
    customer = load_table(spark, directory, "customer")
    base = F.concat(F.lit("nation_"), "c_nationkey").alias("base")
    shifts = customer.select(base).distinct().withColumn("full", F.concat("base", F.lit("_v20240102")))
    segments = customer.select(base, F.concat("c_mktsegment", F.lit("_"), "c_nationkey").alias("alias")).distinct()
    builders = customer.where("c_mktsegment = 'BUILDING'").select(base, F.col("c_name").alias("alias"))
    return shifts, segments.unionByName(builders)


def definitions(spark: SparkSession, directory: str) -> DataFrame:
    """One index definition per event type; the one for errors is disabled."""
    kinds = load_table(spark, directory, "events").select("event_type").distinct()
    return kinds.select(
        F.concat(F.lit("events_"), "event_type").alias("index"), (F.col("event_type") != "error").alias("enabled")
    )


def query_log(spark: SparkSession, directory: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("event_type")
    return load_table(spark, directory, "events").select(
        F.col("event_id").alias("query_id"),
        (kind == "error").cast("int").alias("failed_shards"),
        (kind == "signup").alias("timed_out"),
        F.when(kind == "view", F.lit(0).cast("long")).otherwise(k).alias("hits"),
    )


def request_log(spark: SparkSession, directory: str) -> DataFrame:
    return load_table(spark, directory, "events").select(
        F.col("user_id").alias("writer"),
        F.col("event_id").alias("seq"),
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("took_ms"),
        F.round(F.col("value") * 100).cast("long").alias("bytes"),
    )


def document_requests(spark: SparkSession, directory: str) -> DataFrame:
    """Every labelled document asked for in the English index, the toxic ones twice."""
    labels = load_table(spark, directory, "labels")
    index, doc = F.lit("documents_en").alias("index"), F.col("doc_id").cast("string").alias("id")
    first = labels.select(F.col("doc_id").alias("position"), F.lit(0).alias("again"), index, doc)
    second = labels.where("toxic = 1").select(F.col("doc_id").alias("position"), F.lit(1).alias("again"), index, doc)
    return first.unionByName(second)


def labelled_docs(spark: SparkSession, directory: str) -> DataFrame:
    labels = load_table(spark, directory, "labels")
    return docs(spark, directory).join(labels, "doc_id", "left")


def customer_documents(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Builders as documents, and one update with upsert per order."""
    customer = load_table(spark, directory, "customer").where("c_mktsegment = 'BUILDING'")
    documents = customer.select(
        F.lit("customers").alias("index"),
        F.col("c_custkey").cast("string").alias("id"),
        F.create_map(F.lit("name"), "c_name").alias("source"),
    )
    price = F.col("o_totalprice").cast("string")
    updates = load_table(spark, directory, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.lit("customers").alias("index"),
        F.col("o_custkey").cast("string").alias("id"),
        F.create_map(F.lit("last_price"), price).alias("doc"),
        F.create_map(F.lit("first_price"), price).alias("upsert"),
    )
    return documents, updates
