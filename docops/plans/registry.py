"""The registered queries: every operator run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docops.functions.formats import fmt_doc_speed, fmt_duration, fmt_duration_words, fmt_size, fmt_speed
from docops.functions.names import utc_millis
from docops.operators import aliases, catalog, changelog, chunks, keyed, profile, reports, retention, search
from docops.plans import inputs
from docops.session import scratch_path
from docops.sources import bulk_lines, json_ingest, tables
from docops.sources.versions import VersionedTables
from docops.streaming.ingest import BulkIngest, operation_stream

Query = Callable[[SparkSession, str], DataFrame]

PROPS_MAPPING = {"properties": {"k": {"type": "integer"}}}
LISTS_MAPPING = {
    "properties": {
        "k": {"type": "long"},
        "person": {"properties": {"name": {"type": "keyword"}, "n": {"type": "long"}}},
    }
}
DOCUMENT_MAPPING = {
    "properties": {
        "doc_id": {"type": "long"},
        "text": {"type": "text"},
        "lang": {"type": "keyword"},
        "source": {"type": "keyword"},
        "n_chars": {"type": "long"},
        "quality": {"type": "integer"},
        "toxic": {"type": "integer"},
        "author": {"type": "keyword"},
        "internal": {"type": "keyword", "index": False},
    }
}
RETENTION = [
    retention.Retention("events", inputs.NEXT_DAY, delta=5, min_to_keep=10),
    retention.Retention("orders", "orders20010801"),
    retention.Retention("unknown", "unknown20240101"),
]

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _price_order():
    return ["-o_totalprice", "o_orderkey"]


# Sources and sinks


@_query
def ingest_json_source(spark, directory):
    events = tables.load_table(spark, directory, "events").select("event_id", "props")
    typed = json_ingest.ingest_json(events, "props", PROPS_MAPPING).withColumnRenamed("doc", "typed")
    dynamic = json_ingest.ingest_json(typed, "props")
    return dynamic.select(
        "event_id", F.col("typed.k").alias("k"), F.try_element_at("doc", F.lit("k")).alias("dynamic_k")
    )


@_query
def ingest_json_lists(spark, directory):
    """Fields that hold one value or several, objects included; counts and sums of what they hold."""
    rows = json_ingest.ingest_json_lists(inputs.nested_events(spark, directory), "doc_text", LISTS_MAPPING, "rejected")

    def total(values):
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)

    def fitting(value):
        return F.when(~F.col("rejected"), value)

    # One pass: rejected documents give their id alone.
    return rows.select(
        "event_id",
        fitting(F.size("doc.k")).alias("k_count"),
        fitting(total(F.col("doc.k"))).alias("k_sum"),
        fitting(F.array_join(F.flatten("doc.person.name"), ",")).alias("names"),
        fitting(total(F.flatten("doc.person.n"))).alias("n_sum"),
    )


@_query
def ingest_rejected(spark, directory):
    """Event properties of which every fifth is cut short and every seventh has a wrong type."""
    broken = (
        F.when(F.col("event_id") % 5 == 0, F.expr("left(props, length(props) - 1)"))
        .when(F.col("event_id") % 7 == 0, '{"k":"x"}')
        .otherwise(F.col("props"))
    )
    events = tables.load_table(spark, directory, "events").select("event_id", broken.alias("props"))
    typed = json_ingest.ingest_json(events, "props", PROPS_MAPPING, rejected="rejected")
    return typed.select("event_id", F.when(~F.col("rejected"), F.col("doc.k")).alias("k"), "rejected")


@_query
def field_coverage_documents(spark, directory):
    """Coverage of the documents that the change log leaves, in the map they are stored in."""
    mapping = {"properties": {n: {"type": "keyword"} for n in ("value", "k", "author")}}
    found = profile.field_coverage(changelog.apply_changes(inputs.oplog(spark, directory)), mapping, within="source")
    return found.withColumn("percent", F.round("percent", 6))


@_query
def rollover_route(spark, directory):
    return inputs.dated_events(spark, directory).select("event_id", "index")


@_query
def bulk_ndjson_export(spark, directory):
    return bulk_lines.bulk_lines(inputs.oplog(spark, directory)).select("seq", "body")


@_query
def bulk_chunk_by_count(spark, directory):
    return chunks.chunk_by_count(inputs.request_log(spark, directory).select("writer", "seq"), "writer", "seq", 10)


@_query
def bulk_chunk_by_volume(spark, directory):
    requests = inputs.request_log(spark, directory).select("writer", "seq", "bytes")
    return chunks.chunk_by_volume(requests, "writer", "seq", "bytes", 10_000)


@_query
def bulk_chunk(spark, directory):
    requests = inputs.request_log(spark, directory).select("writer", "seq", "bytes")
    return chunks.chunk(requests, "writer", "seq", "bytes", 5, 10_000)


@_query
def auto_id(spark, directory):
    events = tables.load_table(spark, directory, "events")
    given = F.when(F.col("event_type") != "error", F.col("event_id").cast("string"))
    return tables.with_auto_id(events.withColumn("id", given), "event_id", "props").select("event_id", "id")


@_query
def scroll_pages(spark, directory):
    return search.scroll(inputs.docs(spark, directory).select("doc_id", "index"), ["doc_id"], 79)


@_query
def scroll_stats(spark, directory):
    return search.scroll_summary(scroll_pages(spark, directory))


@_query
def scroll_resumed(spark, directory):
    """Line items by price: a page, a page from its cursor, and a scroll of all that lies behind that one."""
    order, size = ["-l_extendedprice", "l_orderkey", "l_linenumber"], 100
    lines = tables.load_table(spark, directory, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    first = search.scroll_page(lines, order, size)
    second = search.scroll_page(lines, order, size, search.cursor_of(first, order))
    cursor = search.cursor_of(second, order)
    pages = [rows.withColumn("page", F.lit(n).cast("long")) for n, rows in enumerate((first, second))]
    if cursor is not None:
        rest = search.scroll(lines.where(search.after(lines, order, cursor)), order, size)
        pages.append(rest.withColumn("page", F.col("page") + 2))
    return reduce(DataFrame.unionByName, pages)


@_query
def get_ids(spark, directory):
    return keyed.ids_of(inputs.docs(spark, directory), search.term("lang", "fr"))


@_query
def compact_index(spark, directory):
    many, few = scratch_path(spark, "routed"), scratch_path(spark, "compacted")
    tables.write_routed(inputs.dated_events(spark, directory), many)
    tables.compact(tables.read_routed(spark, many), inputs.LAST_DAY, few, 1)
    return tables.file_counts(tables.read_routed(spark, few))


# Keyed reads


@_query
def doc_get(spark, directory):
    return keyed.get(inputs.docs(spark, directory), "documents_en", "1", stored="doc_id").select("index", "id", "text", "score")


@_query
def doc_multi_get(spark, directory):
    requests = inputs.document_requests(spark, directory)
    return keyed.multi_get(inputs.docs(spark, directory), requests, ["source", "n_chars"])


@_query
def doc_exists(spark, directory):
    return keyed.exists(inputs.docs(spark, directory), inputs.document_requests(spark, directory))


def _keyed_docs(spark, directory):
    """The documents written for reads by id, and read from there."""
    path = scratch_path(spark, "keyed")
    tables.write_keyed(tables.load_table(spark, directory, "documents"), path, "doc_id", files=8)
    return keyed.with_document_key(spark.read.parquet(path), F.concat(F.lit("documents_"), "lang"), "doc_id")


@_query
def keyed_multi_get(spark, directory):
    requests = inputs.document_requests(spark, directory).where("again = 1")
    return keyed.multi_get(_keyed_docs(spark, directory), requests, ["source", "n_chars"], stored="doc_id")


@_query
def keyed_exists(spark, directory):
    requests = inputs.document_requests(spark, directory).where("again = 1")
    return keyed.exists(_keyed_docs(spark, directory), requests, stored="doc_id")


# Search


@_query
def searchable_docs(spark, directory):
    return search.searchable_count(inputs.docs(spark, directory), "documents_en")


@_query
def search_term(spark, directory):
    return inputs.docs(spark, directory).where(search.term("lang", "de")).select("index", "id")


@_query
def search_exists(spark, directory):
    docs = inputs.labelled_docs(spark, directory)
    return search.constant_score(docs, search.field_exists(docs, "quality")).select("index", "id", "score")


@_query
def search_match_normalized(spark, directory):
    part = tables.load_table(spark, directory, "part")
    return part.where(search.matches_normalized(F.col("p_name"), "  Small RING ")).select("p_partkey", "p_name")


@_query
def search_field_query(spark, directory):
    lineitem = tables.load_table(spark, directory, "lineitem")
    wanted = search.all_of(search.field_query(lineitem, "l_quantity:23"), search.field_query(lineitem, "l_returnflag:A"))
    return lineitem.where(wanted).select("l_orderkey", "l_linenumber", "l_quantity")


@_query
def search_analyzed_term(spark, directory):
    docs = inputs.docs(spark, directory)
    return docs.where(search.matches_any_token(F.col("text"), "That WITH")).select("index", "id")


@_query
def search_wildcard(spark, directory):
    docs = inputs.docs(spark, directory)
    return docs.where(search.matches_wildcard(F.col("text"), "re?t*ing*")).select("index", "id")


@_query
def search_sorted_page(spark, directory):
    orders = tables.load_table(spark, directory, "orders")
    return search.page(orders, _price_order(), 20, 10).select("o_orderkey", "o_totalprice")


@_query
def search_total(spark, directory):
    orders = tables.load_table(spark, directory, "orders").where(search.term("o_orderstatus", "F"))
    return search.page_with_total(orders, _price_order(), 0, 10).select("o_orderkey", "o_totalprice", "total")


@_query
def search_aggregate(spark, directory):
    lineitem = tables.load_table(spark, directory, "lineitem")
    return search.aggregate(
        lineitem,
        F.col("l_discount") >= 0.05,
        ["l_returnflag", "l_linestatus"],
        [
            F.count("*").alias("n"),
            F.sum("l_quantity").alias("quantity"),
            F.round(F.avg("l_extendedprice"), 4).alias("mean_price"),
            F.max("l_extendedprice").alias("max_price"),
        ],
    )


@_query
def search_multi_index(spark, directory):
    events = inputs.dated_events(spark, directory)
    return events.where(search.in_indices(["events20240105", "events20240117"])).select("index", "event_id")


@_query
def routed_multi_index(spark, directory):
    """The same over a table with one directory for each day: only the named ones are read."""
    events = inputs.routed_events(spark, directory)
    return events.where(search.in_indices(["events20240105", "events20240117"])).select("index", "event_id")


@_query
def search_projection(spark, directory):
    orders = tables.load_table(spark, directory, "orders").where(search.term("o_orderpriority", "2-HIGH"))
    return search.project(orders, ["o_orderkey", "o_orderstatus"])


@_query
def search_empty_page(spark, directory):
    orders = tables.load_table(spark, directory, "orders").where(search.term("o_orderstatus", "F"))
    return search.page_summary(orders, 1_000_000_000, 10)


@_query
def search_deep_page_ties(spark, directory):
    """A deep page in an order with few values; the keys shown are those of the order alone."""
    lineitem = tables.load_table(spark, directory, "lineitem")
    return search.page(lineitem, ["-l_quantity"], 30_000, 40).select("l_quantity")


@_query
def search_deep_page(spark, directory):
    lineitem = tables.load_table(spark, directory, "lineitem")
    order = ["-l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]
    return search.page(lineitem, order, 55_000, 25).select("l_extendedprice", "l_orderkey", "l_linenumber")


# Change logs


@_query
def bulk_index_last_wins(spark, directory):
    return inputs.flat_documents(changelog.index_last_wins(inputs.oplog(spark, directory)))


@_query
def bulk_create_if_absent(spark, directory):
    return changelog.created(changelog.outcomes(inputs.oplog(spark, directory))).select("seq", "index", "id")


@_query
def bulk_partial_update(spark, directory):
    """The documents after the whole log that it updated at any time."""
    ops = inputs.oplog(spark, directory)
    updated = ops.where(F.col("op") == changelog.UPDATE).select(*changelog.KEY).distinct()
    return inputs.flat_documents(changelog.apply_changes(ops).join(updated, changelog.KEY, "left_semi"))


@_query
def bulk_delete(spark, directory):
    """What the whole log leaves of every document that it deleted at any time."""
    ops = inputs.oplog(spark, directory)
    gone = ops.where(F.col("op") == changelog.DELETE).select(*changelog.KEY).distinct()
    left = changelog.apply_changes(ops, keep_deleted=True).join(gone, changelog.KEY, "left_semi")
    return inputs.flat_documents(left, "deleted")


@_query
def delete_by_id(spark, directory):
    toxic = inputs.labelled_docs(spark, directory).where("toxic = 1")
    return changelog.delete_by_id(inputs.docs(spark, directory), toxic).select("index", "id")


@_query
def bulk_apply(spark, directory):
    return inputs.flat_documents(changelog.apply_changes(inputs.oplog(spark, directory)))


@_query
def bulk_item_outcome(spark, directory):
    return changelog.outcomes(inputs.oplog(spark, directory)).select("seq", "id", "op", "outcome")


@_query
def bulk_fail_on_error(spark, directory):
    return changelog.failure_counts(changelog.outcomes(inputs.oplog(spark, directory)))


@_query
def update_with_upsert(spark, directory):
    documents, updates = inputs.customer_documents(spark, directory)
    merged = changelog.update_with_upsert(documents, updates)

    def field(name):
        return F.try_element_at("source", F.lit(name)).alias(name)

    return merged.select("id", "live", field("name"), field("first_price"), field("last_price"))


@_query
def enabled_only(spark, directory):
    events = tables.load_table(spark, directory, "events")
    ops = events.select(F.col("event_id").alias("seq"), F.concat(F.lit("events_"), "event_type").alias("index"))
    return changelog.enabled_only(ops, inputs.definitions(spark, directory)).select("seq", "index")


# Catalogue, aliases, retention


def _catalog_columns(df):
    return df.select("index", "doc_count", utc_millis(df, "created").alias("created_millis"), "state")


@_query
def index_catalog(spark, directory):
    return _catalog_columns(catalog.list_indices(inputs.catalog(spark, directory)))


@_query
def index_state(spark, directory):
    events = inputs.dated_events(spark, directory).select("index").distinct()
    documents = inputs.docs(spark, directory).select("index").distinct()
    return catalog.index_state(inputs.catalog(spark, directory), events.unionByName(documents))


@_query
def closed_older_than(spark, directory):
    before = F.lit("2024-01-06 00:00:00").cast("timestamp_ntz")
    return catalog.closed_indices(inputs.catalog(spark, directory), before)


@_query
def purge_closed(spark, directory):
    before = F.lit("2024-01-06 00:00:00").cast("timestamp_ntz")
    rows = inputs.dated_events(spark, directory)
    return catalog.purge_closed(rows, inputs.catalog(spark, directory), before).select("index", "event_id")


@_query
def open_close_scan(spark, directory):
    known = inputs.catalog(spark, directory)
    reopened = catalog.with_state(known, known.where(F.col("index") == "events20240103"), catalog.OPEN)
    return catalog.scan_open(inputs.dated_events(spark, directory), reopened).select("index", "event_id")


@_query
def routed_open_scan(spark, directory):
    """Open indices of a routed table by a join with the stored catalogue, which prunes it while running."""
    path = scratch_path(spark, "catalogue")
    inputs.catalog(spark, directory).write.parquet(path)
    events = inputs.routed_events(spark, directory)
    return catalog.scan_open(events, spark.read.parquet(path), listed=0).select("index", "event_id")


@_query
def drop_index(spark, directory):
    gone = ["events20240107", "events20240108", "events19990101"]
    return catalog.drop_indices(inputs.dated_events(spark, directory), gone).select("index", "event_id")


@_query
def resolve_alias(spark, directory):
    return aliases.resolve_alias(inputs.event_aliases(spark, directory), "events")


@_query
def most_recent_index(spark, directory):
    table = inputs.event_aliases(spark, directory)
    return aliases.most_recent_index(table, table.select("alias").distinct())


@_query
def aliases_of_index(spark, directory):
    return aliases.aliases_of(inputs.event_aliases(spark, directory), inputs.LAST_DAY)


def _segment_filter(index, alias):
    return F.lit("c_mktsegment"), F.regexp_extract(alias, "^(.*)_", 1)


@_query
def shift_alias(spark, directory):
    shifts, extras = inputs.nation_shifts(spark, directory)
    return aliases.plan_shift(inputs.customer_aliases(spark, directory), shifts, extras, _segment_filter)


@_query
def shift_alias_table(spark, directory):
    table = inputs.customer_aliases(spark, directory)
    shifts, extras = inputs.nation_shifts(spark, directory)
    return aliases.apply_shift(table, aliases.plan_shift(table, shifts, extras, _segment_filter))


@_query
def shift_close_old(spark, directory):
    table = inputs.event_aliases(spark, directory)
    closed = aliases.close_shifted(inputs.catalog(spark, directory), table, "events", inputs.LAST_DAY)
    return closed.select("index", "state")


@_query
def shift_versions(spark, directory):
    """Aliases and index states read back from the version that a shift of every nation has committed."""
    metadata = VersionedTables(spark, scratch_path(spark, "metadata"))
    table = inputs.customer_aliases(spark, directory)
    shifts, extras = inputs.nation_shifts(spark, directory)
    named = table.select("index").unionByName(shifts.select(F.col("full").alias("index"))).distinct()
    known = named.withColumn("state", F.lit(catalog.OPEN))
    metadata.commit({aliases.ALIASES: table, aliases.CATALOG: known}, metadata.latest())
    version = aliases.commit_shift(metadata, shifts, extras, _segment_filter, close=True)
    states = metadata.read(aliases.CATALOG, version).withColumnRenamed("index", "known")
    rows = metadata.read(aliases.ALIASES, version)
    return (
        states.join(rows, F.col("known") == F.col("index"), "left")
        .groupBy(F.col("known").alias("index"), "state")
        .agg(F.count("alias").alias("aliases"), F.count("filter_field").alias("filtered"))
        .withColumn("version", F.lit(version).cast("long"))
    )


@_query
def filtered_alias_scan(spark, directory):
    rows = inputs.dated_events(spark, directory)
    seen = aliases.scan_aliases(rows, inputs.event_aliases(spark, directory), ["event_type"])
    return seen.select("alias", "index", "event_id")


@_query
def alias_scan_one(spark, directory):
    rows = inputs.dated_events(spark, directory)
    seen = aliases.scan_alias(rows, inputs.event_aliases(spark, directory), "events_click")
    return seen.select("index", "event_id")


def _retention(spark, directory):
    known = inputs.catalog(spark, directory).select("index", "state")
    return retention.plan_retention(
        known.unionByName(inputs.order_catalog(spark, directory).select("index", "state")), RETENTION
    )


@_query
def prune_index(spark, directory):
    return _retention(spark, directory)


@_query
def prune_result(spark, directory):
    return retention.retention_result(_retention(spark, directory), RETENTION)


@_query
def prune_rows(spark, directory):
    planned = retention.plan_retention(inputs.catalog(spark, directory).select("index", "state"), RETENTION)
    return retention.apply_retention(inputs.dated_events(spark, directory), planned).select("index", "event_id")


# Profiles


@_query
def most_recent_document(spark, directory):
    return profile.most_recent(tables.load_table(spark, directory, "events"), "ts")


@_query
def most_recent_by_index(spark, directory):
    return profile.most_recent_by_index(inputs.dated_events(spark, directory), "ts")


def _coverage(spark, directory):
    return profile.field_coverage(inputs.labelled_docs(spark, directory), DOCUMENT_MAPPING)


@_query
def field_coverage(spark, directory):
    return _coverage(spark, directory).withColumn("percent", F.round("percent", 6))


@_query
def field_coverage_summary(spark, directory):
    return profile.coverage_summary(_coverage(spark, directory))


@_query
def observed_fields(spark, directory):
    return profile.observed_fields(tables.load_table(spark, directory, "events"), "props")


@_query
def observed_paths(spark, directory):
    return profile.observed_paths(inputs.nested_events(spark, directory), "doc_text")


# Streaming


def _drained(spark, stream):
    """The stream of operations, drained into a new table."""
    ingest = BulkIngest(spark, scratch_path(spark, "stream"), fail_on_error=False)
    ingest.start(stream, drain=True).awaitTermination()
    return ingest


def _events(spark, directory):
    """The event table as a file stream; the glob matches one file as well as a directory of files."""
    schema = tables.load_table(spark, directory, "events").schema
    return _drained(spark, inputs.to_operations(operation_stream(spark, f"{directory}/events.parque[t]", schema)))


@_query
def stream_bulk_apply(spark, directory):
    return inputs.flat_documents(_events(spark, directory).documents())


@_query
def stream_ingest_metrics(spark, directory):
    return _events(spark, directory).metrics()


def _operation_files(spark, directory, parts):
    """The change log as files in the order of its operations, with the path they lie in."""
    ops = inputs.oplog(spark, directory).select(*changelog.OPERATION)
    known = ops.agg(F.min("seq").alias("low"), F.max("seq").alias("high"), F.count("*").alias("n")).first()
    files, low = scratch_path(spark, "operations"), known["low"] or 0
    width = ((known["high"] or 0) - low) // parts + 1
    part_of = F.coalesce(F.floor((F.col("seq") - low) / width), F.lit(0))
    for part in range(parts):
        # All operations of a key in a part are in one file, of a million or so.
        rows = ops.where(part_of == part)
        rows.repartition(known["n"] // (1_000_000 * parts) + 1, *changelog.KEY).write.mode("append").parquet(files)
    return ops.schema, files


def _with_flushes(ingest, least):
    flushed = ingest.metrics().agg(F.count("*").alias("n"), F.sum("late").alias("late")).first()
    return inputs.flat_documents(ingest.documents()).withColumns(
        {"several": F.lit(flushed["n"] >= least), "late": F.lit(flushed["late"]).cast("long")}
    )


@_query
def stream_flush_by_size(spark, directory):
    """One file a flush; late keys would show."""
    schema, files = _operation_files(spark, directory, 3)
    return _with_flushes(_drained(spark, operation_stream(spark, files, schema, files=1)), 3)


@_query
def stream_flush_by_bytes(spark, directory):
    """Flushes of the bytes of the largest file: each takes one file, or more of smaller ones."""
    schema, files = _operation_files(spark, directory, 4)
    sizes = spark.read.parquet(files).select("_metadata.file_path", "_metadata.file_size").distinct()
    largest = sizes.agg(F.max("file_size")).first()[0] or 1
    return _with_flushes(_drained(spark, operation_stream(spark, files, schema, volume=largest)), 2)


@_query
def stream_fold(spark, directory):
    """The stream's table folded into one row for each key, and the whole log repeated on top: all of it late."""
    ops = inputs.oplog(spark, directory).select(*changelog.OPERATION)
    schema, files = _operation_files(spark, directory, 2)
    first = _drained(spark, operation_stream(spark, files, schema, files=1))
    folded = first.folded(scratch_path(spark, "folded"))
    per_key = folded.table.changes().groupBy("index", "id").agg(F.count("*").alias("n"))
    rows = per_key.agg(F.max("n")).first()[0]
    folded.flush(ops.where("seq IS NOT NULL"), first.flushed())
    late = folded.metrics().agg(F.sum("late")).first()[0]
    return inputs.flat_documents(folded.documents()).withColumns(
        {"rows_per_key": F.lit(rows).cast("long"), "late": F.lit(late).cast("long")}
    )


# Reports and formats


@_query
def bulk_report(spark, directory):
    judged = changelog.outcomes(inputs.oplog(spark, directory))
    report = reports.bulk_report(judged, "id", "bytes", "millis")
    rates = ["docs_per_second", "bytes_per_second", "mean_bytes"]
    return report.select(
        "id", "submitted", "succeeded", "failed", "bytes", "elapsed", *[F.round(r, 8).alias(r) for r in rates]
    )


def _blocks(spark, directory, hot_rows=None):
    log = inputs.request_log(spark, directory)
    blocks = reports.throughput_blocks(log, "writer", "seq", "took_ms", "bytes", 8, hot_rows)
    rounded = ["avg_took", "avg_size", "throughput", "delta", "delta_percent"]
    return blocks.select(
        "writer", "block", "min_took", "max_took", "min_size", "max_size", *[F.round(c, 6).alias(c) for c in rounded]
    )


@_query
def throughput_blocks(spark, directory):
    return _blocks(spark, directory)


@_query
def search_report(spark, directory):
    return reports.search_report(inputs.query_log(spark, directory))


@_query
def format_sizes(spark, directory):
    lineitem = tables.load_table(spark, directory, "lineitem")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        fmt_size(F.floor(F.col("l_extendedprice")).cast("long") * F.col("l_orderkey")).alias("size_text"),
        fmt_size(F.col("l_extendedprice"), whole=False).alias("price_text"),
        fmt_speed(F.floor("l_extendedprice")).alias("speed_text"),
        fmt_doc_speed(F.floor("l_quantity")).alias("docs_text"),
    )


def _span():
    return F.round(F.col("value") * 1_000_000).cast("long")


@_query
def format_duration(spark, directory):
    events = tables.load_table(spark, directory, "events")
    return events.select(
        "event_id",
        fmt_duration(_span(), "d'd 'H:m:s.S").alias("full_text"),
        fmt_duration(_span(), "H' h 'S").alias("part_text"),
    )


@_query
def format_duration_words(spark, directory):
    events = tables.load_table(spark, directory, "events")
    whole_minutes = F.floor(_span() / 60_000).cast("long") * 60_000
    return events.select(
        "event_id",
        *[
            fmt_duration_words(whole_minutes, lead, trail).alias(f"words_{int(lead)}{int(trail)}")
            for lead in (True, False)
            for trail in (True, False)
        ],
    )


# The same operators with so low a limit that most keys take the plan for hot keys

SPLIT_ROWS = 60


@_query
def bulk_apply_split(spark, directory):
    ops = inputs.oplog(spark, directory)
    return inputs.flat_documents(changelog.apply_changes(ops, hot=changelog.hot_documents(ops, SPLIT_ROWS)))


@_query
def bulk_item_outcome_split(spark, directory):
    ops = inputs.oplog(spark, directory)
    judged = changelog.outcomes(ops, hot=changelog.hot_documents(ops, SPLIT_ROWS))
    return judged.select("seq", "id", "op", "outcome")


@_query
def bulk_chunk_split(spark, directory):
    requests = inputs.request_log(spark, directory).select("writer", "seq", "bytes")
    return chunks.chunk(requests, "writer", "seq", "bytes", 5, 10_000, SPLIT_ROWS)


@_query
def bulk_chunk_by_count_split(spark, directory):
    requests = inputs.request_log(spark, directory).select("writer", "seq")
    return chunks.chunk_by_count(requests, "writer", "seq", 10, SPLIT_ROWS)


@_query
def throughput_blocks_split(spark, directory):
    return _blocks(spark, directory, SPLIT_ROWS)


@_query
def matching_page(spark, directory):
    """Page one of the documents whose text contains a word, with the total."""
    docs = inputs.docs(spark, directory)
    found = docs.where(search.matches_any_token(F.col("text"), "that")).select("index", "id", "doc_id", "n_chars")
    return search.page_with_total(found, ["-n_chars", "doc_id"], 0, 10)
