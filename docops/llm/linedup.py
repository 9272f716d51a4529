"""Repeated runs of lines deleted by a suffix array over line ids, built by prefix doubling.

Lines get ranks in an order of their own; doubling ranks the suffixes of all documents by
their first 2, 4, ... lines until the ranks cover ``min_lines``. Suffixes of equal rank are
then the longest-common-prefix intervals of at least that length. The first suffix of an
interval, in order of document and line, stays; the runs of the others are deleted. A
suffix that is alone at some depth is left out of all deeper ones. With ``min_words`` shorter
runs of more words than that are repeats too; ranks then grow by one line, so that every
length below ``min_lines`` is looked at. The pipeline asks for that, the query op3_linedup does not.

Only DataFrame functions are used. Ranks are numbered in ordered ranges, and a line with a
third of all rows is only met in counts and in joins that can be split.

* Lines end at newlines and must be equal to the byte. Lines without a word are never deleted
  and do not count as part of a run. Runs do not cross documents; they may overlap.
* Null text has no line and stays null. A document that loses all its lines keeps an empty text.
* Rows that repeat id and text are one document: they get the same result. Rows with one id
  and different texts are told apart, in the order of a hash of the text; null ids come first.
* An empty table gives an empty result. Other columns are kept, whatever their names; only
  ``n_lines`` and ``n_removed`` give way to the operator's own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docops.llm.common import WORD, set_aside, stored, table, word_count
from docops.plans.skew import OrderedRanges

MIN_LINES = 3
#: With this rule, runs of fewer lines but more words than this are deleted too.
MIN_WORDS = 50
_KEY = ["_doc", "_text"]


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the id, never null, and the hash of the text that name a document."""
    return docs.withColumns(
        {
            "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
            "_text": F.xxhash64("text"),
        }
    )


def _lines(text: str = "text") -> Column:
    """Lines that have a word, with their place among all lines."""
    split = F.split(F.col(text), "\n")
    numbered = F.transform(split, lambda line, i: F.struct(i.alias("place"), line.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(WORD))


def _ranked(groups: DataFrame, order: list[str]) -> DataFrame:
    """Dense ranks of distinct rows in ``order``; no task sorts more than a range of them."""
    return OrderedRanges(groups, order).numbered("_rank")


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """(_doc, _text, start, lines): maximal runs of later copies, counted among lines with a word."""
    documents = _keyed(docs.select("doc_id", "text")).where("text IS NOT NULL")
    lines = documents.select(*_KEY, F.posexplode(_lines()).alias("_pos", "_line"))
    # Two hashes with different seeds stand for a line: 128 bits.
    ids = [F.xxhash64(F.col("_line.line")).alias("_a"), F.xxhash64(F.lit(1), F.col("_line.line")).alias("_b")]
    # Words of the whole window, and of its last line.
    size = [] if min_words is None else ["_words", "_last"]
    words = [word_count(F.col("_line.line")).alias(c) for c in size]
    # Rows that repeat a document must not make their own lines repeat: one occurrence counts.
    pairs = stored(lines.select(*_KEY, "_pos", *ids, *words).distinct(), "linedup-lines")
    depth, found = 1, []
    while True:
        at = F.struct(*_KEY, "_pos")
        groups = pairs.groupBy("_a", "_b").agg(F.count("*").alias("_n"), F.min(at).alias("_first"))
        groups = stored(groups.where("_n > 1"), "linedup-groups")
        if size or depth >= min_lines:
            long = pairs if depth >= min_lines else pairs.where(F.col("_words") > min_words)
            later = long.join(groups, ["_a", "_b"]).where(F.struct(*_KEY, "_pos") != F.col("_first"))
            found.append(later.select(*_KEY, "_pos", (F.col("_pos") + depth).alias("_end")))
        if depth >= min_lines:
            break
        ranks = _ranked(groups.select("_a", "_b"), ["_a", "_b"])
        ranked = pairs.join(stored(ranks, "linedup-ranks"), ["_a", "_b"]).select(*_KEY, "_pos", "_rank", *size)
        step = 1 if size else min(depth, min_lines - depth)
        order = Window.partitionBy(*_KEY).orderBy("_pos")
        last = F.lead("_last").over(order) if size else None
        # Positions ascend, so the row ``step`` further on is that position or there is none.
        pairs = ranked.select(
            *_KEY,
            "_pos",
            F.col("_rank").alias("_a"),
            F.lead("_rank", step).over(order).alias("_b"),
            F.lead("_pos", step).over(order).alias("_next"),
            *([(F.col("_words") + last).alias("_words"), last.alias("_last")] if size else []),
        ).where(F.col("_next") == F.col("_pos") + step)
        pairs = stored(pairs.drop("_next"), "linedup-pairs")
        depth += step
    # Copies that overlap or follow each other at once make one run.
    order = Window.partitionBy(*_KEY).orderBy("_pos", "_end")
    reached = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = reduce(DataFrame.unionByName, found)
    runs = runs.withColumn("_new", F.when(F.col("_pos") <= reached, 0).otherwise(1))
    runs = runs.withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy(*_KEY, "_run").agg(
        F.min("_pos").alias("start"), (F.max("_end") - F.min("_pos")).alias("lines")
    ).drop("_run")


def delete_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """``docs`` with later copies of repeated runs cut from ``text``, and n_lines and n_removed."""
    given = docs.drop("n_lines", "n_removed")
    docs, back = set_aside(given, ("doc_id", "text"))
    runs = repeated_runs(docs, min_lines, min_words).groupBy(*_KEY).agg(F.collect_list(F.struct("start", "lines")).alias("_runs"))
    runs = stored(runs, "linedup-runs")
    # Always a merge join: the side that grows with the corpus is never broadcast.
    rows = _keyed(docs).join(runs.hint("merge"), _KEY, "left")
    gone = F.flatten(F.transform("_runs", lambda r: F.sequence(r["start"], r["start"] + r["lines"] - 1)))
    # Bound in a one-element array, so that the text is split once and not for each line.
    places = F.transform(F.array(_lines()), lambda all_: F.transform(gone, lambda i: all_[i]["place"]))[0]
    rows = rows.withColumn("_gone", F.when(F.col("_runs").isNotNull(), places))
    split = F.array(F.struct(F.split("text", "\n").alias("all"), F.col("_gone").alias("gone")))
    kept = F.transform(
        split,
        lambda s: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(s["all"]) - 1), s["gone"]), lambda i: s["all"][i]
            ),
            "\n",
        ),
    )[0]
    return rows.select(
        *[
            F.when(F.col("_gone").isNull(), column).otherwise(kept).alias("text") if name == "text" else column
            for column, name in zip(back, given.columns)
        ],
        F.coalesce(F.size(_lines()), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def op3_linedup(spark, directory: str) -> DataFrame:
    rows = delete_repeats(table(spark, directory, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def linedup_sql(min_lines: int = MIN_LINES) -> str:
    """DuckDB SQL: every window of ``min_lines`` lines compared, for tables without repeated ids."""
    window = " || chr(10) || ".join(
        f"lead(line, {i}) OVER (PARTITION BY doc_id ORDER BY pos)" if i else "line" for i in range(min_lines)
    )
    return f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL),
placed AS (SELECT doc_id, unnest(range(0, len(s))) AS place, unnest(s) AS line FROM split),
lines AS (SELECT doc_id, place, line, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS pos FROM placed
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
windows AS (SELECT doc_id, pos, {window} AS w FROM lines),
later AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS k
    FROM windows WHERE w IS NOT NULL) WHERE k > 1),
gone AS (SELECT DISTINCT l.doc_id, l.place FROM later r, range({min_lines}) t(j), lines l
    WHERE l.doc_id = r.doc_id AND l.pos = r.pos + j),
kept AS (SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.place) AS text FROM placed p
    ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id)
SELECT d.doc_id, (SELECT count(*) FROM lines l WHERE l.doc_id = d.doc_id) AS n_lines,
    (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed,
    CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS kept_md5
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id"""


QUERIES = {"op3_linedup": op3_linedup}
SQL = {"op3_linedup": linedup_sql()}
