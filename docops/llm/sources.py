"""How the word use of sources differs, priced for every pair of sources of a language.

Words are counted once for each (language, source), first inside every task and then by a
shuffle of those counts, and a language keeps the words of many documents. Kept words get ids in one order; a source's (word id, count) pairs are sorted
arrays, cut at fixed id ranges so that no array exceeds ``RANGE`` entries however large the
vocabulary is. For every unordered pair of sources and id range the two arrays are
co-grouped and merged: the shorter array gallops through the longer one, words of both, of
the first and of the second only are priced from the counts, and words that neither has
cost the same each and are priced by their number. One pass serves both directions.

Shares are integers: 1 + floor(10**9 * (count + 5) / (N + 5 * V)), computed digit by digit
so that no product leaves 64 bits while N + 5 * V is below 9 * 10**15.

* Null text, language and source are empty. A language or source without words is a group
  like any other; without kept words (V = 0) its pairs cost 0 and it has no terms.
* Every row is a document, repeated rows too. Ties are ranked by the item's UTF-8 bytes.
* A source that is alone in its language has no pair. An empty table gives an empty result.
  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docops.llm.common import stored, table
from docops.plans.skew import OrderedRanges

MIN_DOCUMENTS = 30
TOP_TERMS = 50
#: Word ids of one array at most.
RANGE = 1 << 16
#: Words of all sources that a counting task holds before it hands them on.
HELD = 1 << 18
#: Entries of the shorter array that one galloping step looks up together.
STRIPE = 64

_WORD = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GROUP = ["lang", "source"]
_COUNTED = ["lang", "source", "term", "n", "documents"]
#: Rows of a batch of counts.
_ROWS = 1 << 14
_PRICED = "lang string, a string, b string, seen long, cost long"


def _share(count, total):
    """1 + floor(10**9 * (count + 5) / total) of numpy numbers; count + 5 <= total."""
    left, digits = (count + 5) % total, (count + 5) // total
    for _ in range(3):
        left = left * 1000
        digits, left = digits * 1000 + left // total, left % total
    return digits + 1


def _share_column(count: str, total: str) -> Column:
    """The same of columns, by decimals."""
    return F.expr(f"1 + CAST({count} + 5 AS DECIMAL(20, 0)) * 1000000000BD div {total}")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (lang, source, text) to counts by source; what is held never exceeds ``HELD`` words by much."""
    # Byte by byte: A-Z to a-z, all other ASCII to a space; the bytes of other characters stay.
    table = bytes(b | 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 32 for b in range(256))
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def counts() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, documents) in held.items():
            terms = list(n)
            for at in range(0, len(terms), _ROWS):
                part = terms[at : at + _ROWS]
                names = [pa.array([x] * len(part), pa.string()) for x in (lang, source)]
                numbers = [pa.array([c[t] for t in part], pa.int64()) for c in (n, documents)]
                yield pa.RecordBatch.from_arrays([*names, pa.array(part, pa.binary()).cast(pa.string()), *numbers], _COUNTED)
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
            words = text.translate(table).split()
            n, documents = held.setdefault((lang, source), (Counter(), Counter()))
            n.update(words)
            documents.update(set(words))
            if len(n) > _ROWS and sum(len(c) for c, _ in held.values()) > HELD:
                yield from counts()
        if sum(len(c) for c, _ in held.values()) > HELD:
            yield from counts()
    yield from counts()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents): occurrences and documents of every term, by source."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*_GROUP, "text")]
    counted = docs.select(*named[:2], named[2].cast("binary").alias("text")).mapInArrow(_count_words, "lang string, source string, term string, n long, documents long")
    return counted.groupBy(*_GROUP, "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def _gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Places in ``long`` where the entries of ``short`` are or would be; both are sorted."""
    places, at = [np.zeros(0, dtype=np.int64)], 0
    for start in range(0, len(short), STRIPE):
        stripe = short[start : start + STRIPE]
        end, step = at, 1
        while end < len(long) and long[end] < stripe[-1]:
            end, step = end + step, step * 2
        places.append(at + np.searchsorted(long[at : end + 1], stripe))
        at = int(places[-1][-1])
    return np.concatenate(places)


def price(first: tuple, second: tuple, totals: tuple[int, int]) -> tuple[int, int]:
    """(words that either source has, their summed cost) of two sorted (ids, counts) pairs."""
    if len(first[0]) > len(second[0]):
        first, second, totals = second, first, totals[::-1]
    (ids, counts), (others, other_counts) = first, second
    places = _gallop(ids, others)
    both = places < len(others)
    both[both] = others[places[both]] == ids[both]
    alone = np.ones(len(others), dtype=bool)
    alone[places[both]] = False
    mine, theirs = _share(counts, totals[0]), _share(other_counts, totals[1])
    none = [_share(np.int64(0), np.int64(total)) for total in totals]
    cost = np.abs(mine[both] - theirs[places[both]]).sum()
    cost += np.abs(mine[~both] - none[1]).sum() + np.abs(theirs[alone] - none[0]).sum()
    return len(ids) + int(alone.sum()), int(cost)


def _price_range(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """One range of two sources; a side without words there has no row."""
    none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

    def arrays(frame: pd.DataFrame) -> tuple:
        return tuple(np.asarray(frame[c].iloc[0], dtype=np.int64) for c in ("words", "counts")) if len(frame) else none

    row = (left if len(left) else right).iloc[:1]
    totals = (int(row["total_a"].iloc[0]), int(row["total_b"].iloc[0]))
    seen, cost = price(arrays(left), arrays(right), totals)
    return row[["lang", "a", "b"]].assign(seen=seen, cost=cost)


class SourceAudit:
    """Counts of the kept words of every source, each computed once and stored."""

    def __init__(self, docs: DataFrame, min_documents: int = MIN_DOCUMENTS):
        counts = stored(word_counts(docs), "sources-counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("lang_n"))
        kept = stored(kept.where(F.col("documents") >= min_documents), "sources-kept")
        ids = OrderedRanges(kept.select("lang", "term", "lang_n"), ["lang", "term"]).numbered("id")
        self.used = stored(counts.select(*_GROUP, "term", "n").join(ids, ["lang", "term"]), "sources-used")
        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        sums = self.used.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
        named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in _GROUP]
        groups = docs.select(*named).distinct().join(sums, _GROUP, "left").join(langs, "lang", "left")
        zero = F.lit(0).cast("long")
        added = 5 * F.coalesce("kept", zero)
        self.groups = stored(
            groups.select(
                *_GROUP,
                F.coalesce("kept", zero).alias("kept"),
                (F.coalesce("total", zero) + added).alias("total"),
                (F.coalesce("lang_total", zero) + added).alias("lang_total"),
            ),
            "sources-groups",
        )

    def pairs(self) -> DataFrame:
        """(lang, a, b, cost) of every unordered pair of sources of a language, a before b."""
        a = self.groups.select("lang", "kept", F.col("source").alias("a"), F.col("total").alias("total_a"))
        b = self.groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
        pairs = a.join(b, "lang").where("a < b")
        of_range = [*_GROUP, (F.col("id") / RANGE).cast("long").alias("range")]
        arrays = (
            self.used.groupBy(*of_range)
            .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("e"))
            .select(*_GROUP, "range", F.col("e.id").alias("words"), F.col("e.n").alias("counts"))
        )
        arrays = stored(arrays, "sources-arrays")
        columns = ["lang", "a", "b", "range", "words", "counts", "total_a", "total_b"]
        # toDF gives each side columns of its own, so that the two can be told apart.
        sides = [
            arrays.withColumnRenamed("source", side)
            .join(pairs.drop("kept"), ["lang", side])
            .select(*columns)
            .toDF(*columns)
            .groupBy("lang", "a", "b", "range")
            for side in ("a", "b")
        ]
        ranges = sides[0].cogroup(sides[1]).applyInPandas(_price_range, _PRICED)
        priced = ranges.groupBy("lang", "a", "b").agg(F.sum("seen").alias("seen"), F.sum("cost").alias("cost"))
        zero = F.lit(0).cast("long")
        absent = F.col("kept") - F.coalesce("seen", zero)
        none = [_share_column("0", total) for total in ("total_a", "total_b")]
        cost = F.coalesce("cost", zero) + absent * F.abs(none[0] - none[1])
        return pairs.join(priced, ["lang", "a", "b"], "left").select(
            "lang", "a", "b", F.when(F.col("kept") > 0, cost).otherwise(zero).alias("cost")
        )

    def terms(self) -> DataFrame:
        """(lang, source, term, value) of the terms that a source uses more than its language."""
        rows = self.used.join(self.groups, _GROUP)
        more = _share_column("n", "total") - _share_column("lang_n", "lang_total")
        return rows.select(*_GROUP, "term", more.alias("value")).where("value > 0")


def audit_sources(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Ranked costs to the other sources (part ``pair``) and ranked overused terms (part ``term``)."""
    audit = SourceAudit(docs, min_documents)
    pairs = stored(audit.pairs(), "sources-pairs")
    ways = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")]
    each_way = pairs.select("lang", F.explode(F.array(*ways)).alias("p"), "cost")
    order = Window.partitionBy(*_GROUP).orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    ranked_pairs = each_way.select(
        "lang", "p.source", F.lit("pair").alias("part"), "p.item", F.col("cost").alias("value")
    ).withColumn("rank", rank)
    ranked_terms = (
        audit.terms()
        .select(*_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value")
        .withColumn("rank", rank)
        .where(F.col("rank") <= top_terms)
    )
    return ranked_pairs.unionByName(ranked_terms)


def op13_sources(spark, directory: str) -> DataFrame:
    return audit_sources(table(spark, directory, "documents"))


OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term
    HAVING count(DISTINCT row) >= {MIN_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    k.n AS lang_n, l.v, l.total AS lang_total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
    FROM g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS MATERIALIZED (SELECT lang, source, term, n,
    CAST(1 + 1000000000 * (n::HUGEINT + 5) // (total + 5 * v) AS BIGINT) AS p,
    CAST(1 + 1000000000 * (lang_n::HUGEINT + 5) // (lang_total + 5 * v) AS BIGINT) AS q FROM cells),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y
    ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER)
    AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""

QUERIES = {"op13_sources": op13_sources}
SQL = {"op13_sources": OP13_SQL}
