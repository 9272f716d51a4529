"""Search over a document frame: filters, pages, totals, aggregates and scrolls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from docops.functions.text import matches_any_token, matches_normalized, matches_wildcard
from docops.plans.skew import RANGE_ROWS, OrderedRanges, order_columns

# Score of a filter-only match, count for a disabled index, page size of an id stream.
CONSTANT_SCORE = 1.0
DISABLED_COUNT = -1
ID_PAGE = 1000

# A page that ends within this many rows is a top-k: every task hands over that many rows to one merge.
TOP_ROWS = 1_000

__all__ = [
    "after", "aggregate", "cursor_of", "field_exists", "field_query", "in_indices", "match_all", "matches_any_token",
    "matches_normalized", "matches_wildcard", "page", "page_summary", "page_with_total", "project",
    "scroll", "scroll_page", "scroll_summary", "searchable_count", "term",
]


def match_all() -> Column:
    return F.lit(True)


def term(field: str, value) -> Column:
    """Exact equality with a stored value."""
    return F.col(field) == F.lit(value)


def field_exists(df: DataFrame, field: str) -> Column:
    """True where the field has a value; an array needs at least one that is not null."""
    if isinstance(df.schema[field].dataType, ArrayType):
        return F.coalesce(F.exists(F.col(field), lambda item: item.isNotNull()), F.lit(False))
    return F.col(field).isNotNull()


def constant_score(df: DataFrame, predicate: Column) -> DataFrame:
    """The matches of a filter, all with the same score."""
    return df.where(predicate).withColumn("score", F.lit(CONSTANT_SCORE).cast("float"))


def field_query(df: DataFrame, query: str) -> Column:
    """The filter ``field:value``, comparing in the type of the field."""
    field, _, value = query.partition(":")
    return F.col(field) == F.lit(value.strip()).try_cast(df.schema[field].dataType)


def in_indices(names: Sequence[str]) -> Column:
    """The scope of a search over several indices; prunes partitions of a routed table."""
    return F.col("index").isin(list(names))


def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def searchable_count(docs: DataFrame, index: str, enabled: bool = True) -> DataFrame:
    """How many documents of ``index`` can be searched; -1 when its definition is disabled."""
    if not enabled:
        return docs.sparkSession.range(1).select(F.lit(DISABLED_COUNT).cast("long").alias("docs"))
    return docs.where(F.col("index") == index).agg(F.count("*").alias("docs"))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns; maps by their JSON text."""
    return F.xxhash64(*[F.to_json(c) if "map<" in kind else F.col(c) for c, kind in df.dtypes])


def _with_ties(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return df.withColumn("_tie", row_hash(df)), [*order, "_tie"]


def page(df: DataFrame, order: Sequence[str], start: int, size: int, unique: bool = False) -> DataFrame:
    """``size`` rows from position ``start``; ``order`` names columns, ``-name`` for descending.

    A page near the front is a distributed top-k. A page further in is found in two
    steps: the order columns alone say which ordered range holds it, then only the rows of
    that range are read whole. Rows that tie in ``order`` follow each other by a hash of
    the whole row, so pages never overlap and an order with few values is cut into ranges
    too. The hash reads every column: it is left out where the order does not repeat in the
    range, and everywhere if the caller says that ``order`` is ``unique``.
    """
    if start + size <= TOP_ROWS:
        rows, by = (df, order) if unique else _with_ties(df, order)
        return rows.orderBy(*order_columns(by)).offset(start).limit(size).drop("_tie")
    names = list(dict.fromkeys(o.removeprefix("-") for o in order))
    found = OrderedRanges(df.select(*names), order)
    rows, before, count = found.holding(df, start, start + size)
    if not count:
        return df.limit(0)
    if not unique and _repeats(rows, names):
        rows, order = _with_ties(rows, order)
    if count <= RANGE_ROWS:
        return rows.orderBy(*order_columns(order)).offset(start - before).limit(size).drop("_tie")
    rows = OrderedRanges(rows, order).rows_between(start - before, start - before + size, "_position")
    return rows.orderBy("_position").drop("_position", "_tie")


def _repeats(rows: DataFrame, names: Sequence[str]) -> bool:
    """Whether two rows agree in all of ``names``; no other column is read."""
    return not rows.groupBy(*names).agg(F.count("*").alias("_n")).where("_n > 1").isEmpty()


def page_with_total(df: DataFrame, order: Sequence[str], start: int, size: int) -> DataFrame:
    """A page whose rows also carry the exact number of matches before paging."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return page(df, order, start, size).withColumn("total", total)


def page_summary(df: DataFrame, start: int, size: int) -> DataFrame:
    """Hits on the page, total matches, and whether the search yields a result at all.

    A page without hits yields none, even if the total is above zero. Both numbers
    follow from one count.
    """
    total = F.col("total")
    hits = F.greatest(F.lit(0), F.least(F.lit(size), total - start)).cast("long")
    return df.agg(F.count("*").alias("total")).select(
        hits.alias("hits"), "total", (hits > 0).alias("has_result")
    )


def aggregate(df: DataFrame, predicate: Column, by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Caller's aggregates over the whole match set, whatever page is shown."""
    return df.where(predicate).groupBy(*by).agg(*aggregates)


def project(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Only the named stored fields."""
    return df.select(*fields)


def scroll(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """The whole match set with the number of the page each row falls on.

    ``order`` must be unique. The rows are numbered in ordered ranges, so no task
    sees more than its range. Pull the rows with ``toLocalIterator()``.
    """
    numbered = OrderedRanges(df, order).numbered("_position")
    page_number = F.call_function("div", F.col("_position") - 1, F.lit(size).cast("long"))
    return numbered.withColumn("page", page_number).drop("_position")


def scroll_summary(scrolled: DataFrame) -> DataFrame:
    """What a scroll went through: hits, pages, and the least and most rows of a page."""
    pages = scrolled.groupBy("page").agg(F.count("*").alias("n"))
    none = F.lit(0).cast("long")
    return pages.agg(
        F.coalesce(F.sum("n"), none).alias("hits"),
        F.count("*").alias("pages"),
        F.coalesce(F.min("n"), none).alias("least"),
        F.coalesce(F.max("n"), none).alias("most"),
    )


def cursor_of(page_rows: DataFrame, order: Sequence[str]) -> tuple | None:
    """The order values of the last row of a page, from which a scroll goes on; None behind the end."""
    names = [o.removeprefix("-") for o in order]
    last = page_rows.orderBy(*[_reversed(o) for o in order]).select(*names).head(1)
    return tuple(last[0]) if last else None


def _reversed(name: str) -> Column:
    return F.col(name[1:]).asc() if name.startswith("-") else F.col(name).desc()


def _behind(name: str, value, kind: DataType) -> Column:
    """Rows strictly behind ``value`` in one order column: nulls are first, in descending order last."""
    column = F.col(name.removeprefix("-"))
    if name.startswith("-"):
        return F.lit(False) if value is None else (column < F.lit(value).cast(kind)) | column.isNull()
    return column.isNotNull() if value is None else column > F.lit(value).cast(kind)


def after(df: DataFrame, order: Sequence[str], cursor: Sequence) -> Column:
    """The rows behind ``cursor``; plain comparisons, which the scan uses to skip files and row groups."""
    if len(order) != len(cursor):
        raise ValueError("a cursor has one value for each order column")
    kinds = [df.schema[o.removeprefix("-")].dataType for o in order]
    behind, equal = F.lit(False), F.lit(True)
    for name, value, kind in zip(order, cursor, kinds):
        behind = behind | (equal & _behind(name, value, kind))
        equal = equal & F.col(name.removeprefix("-")).eqNullSafe(F.lit(value).cast(kind))
    # What is behind the cursor is not before its first value: a condition of one column, pushed to the scan.
    first, value = F.col(order[0].removeprefix("-")), F.lit(cursor[0]).cast(kinds[0])
    if cursor[0] is None:
        return behind
    reach = (first <= value) | first.isNull() if order[0].startswith("-") else first >= value
    return reach & behind


def scroll_page(df: DataFrame, order: Sequence[str], size: int, cursor: Sequence | None = None) -> DataFrame:
    """The next ``size`` rows behind ``cursor``, from the beginning without one; ``order`` must be unique.

    Nothing is kept between pages: the cursor alone says where to go on, also in another
    session. Each page is a distributed top-k over what lies behind it.
    """
    rows = df if cursor is None else df.where(after(df, order, cursor))
    return rows.orderBy(*order_columns(order)).limit(size)
