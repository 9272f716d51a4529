"""Not-modified revisits of a web archive resolved to the response they stand for.

A revisit says that a page had not changed. It is joined to the latest full response
for the same canonical URL before it; if the validators agree, it gets that response's
headers, overlaid with those of its own that a not-modified answer may change.

* Status is ``resolved``, ``changed`` (validators differ), ``unproven`` (the revisit or the
  response has no validator to compare), ``missing`` (no earlier response), or ``invalid``
  (the revisit has no URL or time).
* Of responses at one time the one with the greatest id counts, one without id last; a
  response at the time of the revisit is not earlier. Responses without URL or time are
  never found. One without id is found like any other, with a null ``response_id``.
* Entity tags are compared without their weakness mark; dates only where a tag is missing.
* Repeated revisits are resolved each on their own. Empty tables give an empty result.
* Other columns are ignored; null headers count as none, header names ignore case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docops.llm.common import stored, table
from docops.plans.skew import SEGMENT, order_bounds, partitions, segment_of

#: Query parameters that only track the visitor.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|phpsessid|jsessionid)="
#: Headers of a not-modified answer that describe its missing body or its connection.
NOT_MERGED = (
    "content-length content-type content-encoding content-range connection keep-alive "
    "proxy-authenticate proxy-authorization te trailer transfer-encoding upgrade"
).split()
_PARTS = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www``, default port, fragment, tracking and closing slash."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _PARTS, 1)), r"^(.*@)?(www[0-9]*\.)?", "")
    host = F.regexp_replace(host, r":(80|443)?$", "")
    path = F.regexp_replace(F.regexp_extract(url, _PARTS, 2), r"/+$", "")
    given = F.split(F.regexp_extract(url, _PARTS, 3), "&")
    query = F.array_join(
        F.sort_array(F.filter(given, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))), "&"
    )
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _tag(column: str) -> Column:
    return F.regexp_replace(F.col(column), "^W/", "")


def merged_headers(stored_headers: Column, update: Column) -> Column:
    """The stored headers overlaid with the permitted ones of ``update``, sorted by name."""

    def entries(headers: Column) -> Column:
        lower = F.transform(
            F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
            lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
        )
        # Names that differ in case only: the smallest value counts, whatever their order in the map.
        return F.sort_array(lower)

    fresh = F.filter(entries(update), lambda e: ~e["key"].isin(NOT_MERGED))
    names = F.transform(fresh, lambda e: e["key"])
    kept = F.filter(entries(stored_headers), lambda e: ~F.array_contains(names, e["key"]))
    both = F.sort_array(F.concat(kept, fresh))
    distinct = F.array_distinct(F.transform(both, lambda e: e["key"]))
    return F.map_from_arrays(
        distinct,
        F.transform(distinct, lambda k: F.filter(both, lambda e: e["key"] == k)[0]["value"]),
    )


def resolve_revisits(responses: DataFrame, revisits: DataFrame) -> DataFrame:
    """One row for each revisit: id, url, ts, status, response_id and merged headers.

    Both frames have (id long, url, ts long, etag, last_modified, headers map). URLs are cut
    into time segments and a summary of one row for each URL and segment carries the latest
    response on, so a URL with a third of all rows is spread over many tasks.
    """
    response = F.struct(F.col("id"), F.col("etag"), F.col("last_modified"), F.col("headers"))
    found = responses.select(canonical_url(F.col("url")).alias("url"), "ts", "id", response.alias("response"))
    found = found.where("url IS NOT NULL AND ts IS NOT NULL")
    asked = revisits.select(
        "id", canonical_url(F.col("url")).alias("url"), "ts", "etag", "last_modified", "headers"
    )
    times = found.groupBy("url", "ts").agg(F.max("id").alias("id")).withColumn("_asked", F.lit(False))
    wanted = asked.where("url IS NOT NULL AND ts IS NOT NULL").select("url", "ts").distinct()
    points = times.unionByName(wanted.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    points = stored(points.select("url", "ts", "id", "_asked"), "revisits-points")
    # Aim at segments of some thousand points each, but no more than the helper's bound.
    parts = max(partitions(points), points.count() // 4096)
    segment = segment_of(points.schema, ["ts"], order_bounds(points, ["ts"], parts))
    points = points.withColumn(SEGMENT, segment)
    at = F.when(~F.col("_asked"), F.struct("ts", "id"))
    inside = Window.partitionBy("url", SEGMENT).orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    latest = points.groupBy("url", SEGMENT).agg(F.max(at).alias("_last"))
    before = Window.partitionBy("url").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("url", SEGMENT, F.max("_last").over(before).alias("_carried"))
    joined = (
        points.withColumn("_near", F.max(at).over(inside))
        .where("_asked")
        .join(carried, ["url", SEGMENT])
        .select("url", "ts", F.coalesce("_near", "_carried").alias("_at"))
        .where("_at IS NOT NULL")
        .select("url", "ts", F.col("_at.ts").alias("_ts"), F.col("_at.id").alias("_id"))
    )
    keyed = found.select("url", F.col("ts").alias("_ts"), F.col("id").alias("_id"), "response")
    # Of repeated rows with one id, the one with the smallest content.
    content = F.struct("response.etag", "response.last_modified", F.to_json("response.headers"))
    keyed = keyed.groupBy("url", "_ts", "_id").agg(F.min_by("response", content).alias("response"))
    j, k = joined.alias("j"), keyed.alias("k")
    same_id = F.col("j._id").eqNullSafe(F.col("k._id"))
    on = (F.col("j.url") == F.col("k.url")) & (F.col("j._ts") == F.col("k._ts")) & same_id
    sources = j.join(k, on).select("j.url", "ts", "response")
    rows = asked.alias("r").join(sources.alias("s"), ["url", "ts"], "left").select("r.*", "s.response")
    by_tag = _tag("etag").isNotNull() & F.col("response.etag").isNotNull()
    by_date = F.col("last_modified").isNotNull() & F.col("response.last_modified").isNotNull()
    same = F.when(by_tag, _tag("etag") == _tag("response.etag")).when(
        by_date, F.col("last_modified") == F.col("response.last_modified")
    )
    status = (
        F.when(F.col("url").isNull() | F.col("ts").isNull(), "invalid")
        .when(F.col("response").isNull(), "missing")
        .when(same.isNull(), "unproven")
        .otherwise(F.when(same, "resolved").otherwise("changed"))
    )
    done = F.coalesce(same, F.lit(False))
    return rows.select(
        "id",
        "url",
        "ts",
        status.alias("status"),
        F.when(done, F.col("response.id")).alias("response_id"),
        F.when(done, merged_headers(F.col("response.headers"), F.col("headers"))).alias("headers"),
    )


def captures(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A capture log derived from ``pages``: full responses and revisits of section fronts.

    The number of the page is its time; two captures in three are full responses. A
    section changes its version every 64 seconds. Versions that divide by five have dates only.
    A page without number counts as a revisit without time, so it stays in the result.
    """
    version = F.expr("CAST(page_id div 64 AS STRING)")
    dated = F.expr("(page_id div 64) % 5 = 0")
    log = pages.select(
        F.col("page_id").alias("id"),
        F.regexp_replace("url", r"/[0-9]+(\.html)?", "/").alias("url"),
        F.col("page_id").alias("ts"),
        F.when(~dated, F.concat(F.when(F.col("page_id") % 2 == 0, "W/").otherwise(""), F.lit('"v'), version, F.lit('"'))).alias("etag"),
        F.concat(F.lit("day "), version).alias("last_modified"),
        F.length("html").cast("string").alias("_length"),
        F.expr("coalesce(page_id % 3 = 2, true)").alias("_revisit"),
    )
    full = log.where("NOT _revisit").withColumn(
        "headers",
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("_length"),
            F.lit("Date"), F.col("ts").cast("string"), F.lit("Server"), F.lit("origin"),
        ),
    )
    again = log.where("_revisit").withColumn(
        "headers",
        F.create_map(
            F.lit("content-length"), F.lit("0"), F.lit("date"), F.col("ts").cast("string"),
            F.lit("Cache-Control"), F.concat(F.lit("max-age="), F.col("_length")),
        ),
    )
    return full.drop("_length", "_revisit"), again.drop("_length", "_revisit")


def op8_revisits(spark, directory: str) -> DataFrame:
    rows = resolve_revisits(*captures(table(spark, directory, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return rows.withColumn("headers", F.array_join(lines, "\n"))


OP8_SQL = r"""
WITH log AS (SELECT page_id AS id, regexp_replace(url, '/[0-9]+(\.html)?', '/', 'g') AS url, page_id AS ts,
    CASE WHEN (page_id // 64) % 5 <> 0 THEN '"v' || (page_id // 64) || '"' END AS etag, 'day ' || (page_id // 64) AS dated,
    CAST(length(html) AS VARCHAR) AS len, coalesce(page_id % 3 = 2, true) AS revisit FROM pages),
parts AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url,
    '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)', 1)), '^(.*@)?(www[0-9]*\.)?', ''), ':(80|443)?$', '') AS host,
    regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)', 2), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(url,
    '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)', 3), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p),
    '^(utm_[a-z]+|ref|fbclid|gclid|phpsessid|jsessionid)='))), '&') AS query FROM log),
named AS (SELECT * EXCLUDE (url), CASE WHEN host <> '' THEN host || path || CASE WHEN query <> '' THEN '?' || query
    ELSE '' END END AS url FROM parts),
joined AS (SELECT r.*, (SELECT max(f.id) FROM named f WHERE NOT f.revisit AND f.url = r.url AND f.ts < r.ts) AS fid
    FROM named r WHERE r.revisit),
judged AS (SELECT j.*, f.len AS flen, f.id AS rid, CASE WHEN j.etag IS NOT NULL AND f.etag IS NOT NULL
    THEN j.etag = f.etag ELSE j.dated = f.dated END AS same FROM joined j LEFT JOIN named f ON f.id = j.fid)
SELECT id, url, ts, CASE WHEN url IS NULL THEN 'invalid' WHEN rid IS NULL THEN 'missing' WHEN same THEN 'resolved' ELSE 'changed' END
    AS status, CASE WHEN same THEN rid END AS response_id, CASE WHEN same THEN 'cache-control: max-age=' || len ||
    chr(10) || 'content-length: ' || flen || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts ||
    chr(10) || 'server: origin' END AS headers FROM judged"""

QUERIES = {"op8_revisits": op8_revisits}
SQL = {"op8_revisits": OP8_SQL}
