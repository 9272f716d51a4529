"""Reads by key: get, multi-get and exists over ``index, id`` documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.plans.skew import bounded_rows, checked_broadcast

# Fixed value: keyed reads carry no relevance, so their score is always -1.
KEYED_SCORE = -1.0
DOC_KEY = ["index", "id"]
#: Ids that a scan looks up by itself, and how many of them in one list.
PUSHED_IDS = 1_000
LISTED = 10


def with_document_key(df: DataFrame, index: Column, id_column: str) -> DataFrame:
    """Adds ``index`` and the text ``id`` that the document operators work on."""
    return df.select(index.alias("index"), F.col(id_column).cast("string").alias("id"), "*")


def get(docs: DataFrame, index: str, doc_id: str, stored: str | None = None) -> DataFrame:
    """The document under (index, id): one row or none, score -1.

    ``stored`` names the column the text id was made from; comparing it in its own type
    as well lets the scan skip files and row groups.
    """
    wanted = (F.col("index") == index) & (F.col("id") == doc_id)
    if stored is not None:
        wanted = wanted & (F.col(stored) == F.lit(doc_id).try_cast(docs.schema[stored].dataType))
    return docs.where(wanted).withColumn("score", F.lit(KEYED_SCORE).cast("float"))


def any_of(docs: DataFrame, column: str, texts: Sequence[str | None]) -> Column:
    """Rows whose ``column`` has one of the values, given as text and compared in the column's own type.

    The sorted values are compared ten at a time, which is what a scan takes as a list: it
    skips row groups by their least and greatest value and by their Bloom filter.
    """
    kind = docs.schema[column].dataType
    listed = docs.sparkSession.createDataFrame([(t,) for t in texts], "t string")
    values = sorted(r[0] for r in listed.select(F.col("t").try_cast(kind)).distinct().collect() if r[0] is not None)
    lists = [F.col(column).isin(values[at : at + LISTED]) for at in range(0, len(values), LISTED)]
    return reduce(lambda a, b: a | b, lists, F.lit(False))


def _requested(docs: DataFrame, requests: DataFrame, stored: str | None = None) -> DataFrame:
    """The documents some request names, found without shuffling ``docs`` if requests are few."""
    keys = requests.select(*DOC_KEY).distinct()
    if stored is not None:
        ids = bounded_rows(keys.select("id").distinct(), PUSHED_IDS)
        if ids is not None:
            docs = docs.where(any_of(docs, stored, [row["id"] for row in ids]))
    return docs.join(checked_broadcast(keys), DOC_KEY, "left_semi")


def multi_get(docs: DataFrame, requests: DataFrame, columns: Sequence[str], stored: str | None = None) -> DataFrame:
    """One row per request, duplicates kept; a missing document has ``found`` false.

    Request columns beyond the key (such as the request's position) are passed
    through. ``columns`` are the document columns to return. ``stored`` names the column
    the text id was made from: up to ``PUSHED_IDS`` different ids are then looked up by the
    scan itself, more are joined.
    """
    found = _requested(docs, requests, stored).select(*DOC_KEY, *columns, F.lit(True).alias("found"))
    return (
        requests.join(found, DOC_KEY, "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
        .withColumn("score", F.lit(KEYED_SCORE).cast("float"))
    )


def exists(docs: DataFrame, requests: DataFrame, stored: str | None = None) -> DataFrame:
    """The requests with a flag telling whether the document is there; nothing but keys is read."""
    keys = docs.select(*DOC_KEY, *([] if stored is None else [stored]))
    found = _requested(keys, requests, stored).select(*DOC_KEY).distinct().withColumn("exists", F.lit(True))
    return requests.join(found, DOC_KEY, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def ids_of(docs: DataFrame, predicate: Column | None = None) -> DataFrame:
    """The ids of all documents that match."""
    matched = docs if predicate is None else docs.where(predicate)
    return matched.select("id")
