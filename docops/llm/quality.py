"""Document quality learned from preference pairs by the Bradley-Terry model.

Every labelled good document should be preferred to every bad one. All labelled rows are
dealt into cells, in the order of a hash: each row of the larger kind meets ``PARTNERS`` rows
of the other, and those take part equally often. A linear score is fitted by logistic loss
on the differences of all features that meet, by Newton steps that are sums over the cells.
The threshold is the exact quantile of the scores of all labelled rows, at the share of bad
labels; scores are shifted so that it lies at ``CUT``.

* Features come from the text alone: never from labels, language, source or id.
* Null text counts as empty; empty texts get the score of their features like others.
* A document labelled more than once counts with its mean label; even votes and null labels
  teach nothing. Labels without a document, and documents without id, teach nothing.
* Without labels of both kinds there are no pairs, and every score is ``UNTAUGHT``.
* Repeated rows are scored each on their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.llm.common import set_aside, stored, table, words
from docops.plans.skew import OrderedRanges

#: Rows of each kind in a cell, and cells that are stored as one row.
PARTNERS = 8
CELLS = 64
#: Sums are added as whole multiples of this, so that their order does not matter.
QUANTUM = 2.0**-52
RIDGE = 1e-3
CUT = 0.7
UNTAUGHT = 0.75
SEED = 5
OWN = ("held_out", "score", "predicted")

#: Characters whose share of the text is a feature; each is also judged by its square root.
CLASSES = {
    "capitals": r"\p{Lu}",
    "digits": r"[0-9]",
    "symbols": r"[#*$%&<>=_~^@\\/+{}\[\]]",
    "bars": r"\|",
    "marks": r"[!?]",
    "stops": r"[.,;:]",
    "lines": r"\n",
}


def features(text: Column) -> Column:
    """Array of doubles from one text: shares of characters, repetition, lengths."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    found = words(text)

    def rest(w: Column) -> list[Column]:
        count = F.size(w).cast("double")
        some = F.greatest(count, F.lit(1.0))
        distinct = F.size(F.array_distinct(w)).cast("double")
        return [
            F.log1p(count),
            F.pow(F.log1p(count), 2) / 10,
            1 / (1 + count),
            F.log1p(distinct) / F.log1p(some),
            distinct / some,
            F.length(text) / some / 10,
        ]

    shares = [F.regexp_count(text, F.lit(p)) / size for p in CLASSES.values()]
    roots = [F.sqrt(s) for s in shares]
    # Words are kept in a one-element array so that they are split only once.
    tail = F.transform(F.array(found), lambda w: F.array(*rest(w)))[0]
    return F.concat(F.array(*shares, *roots), tail)


def pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, gradient and curvature of all pairs of ``good`` and ``bad`` within each cell, in one array.

    Both are (cells, rows, features); a row of nan is none.
    """
    some = ~np.isnan(good[:, :, None, 0] + bad[:, None, :, 0])
    good, bad = np.nan_to_num(good), np.nan_to_num(bad)
    p = 1 / (1 + np.exp(-np.clip((good @ w)[:, :, None] - (bad @ w)[:, None, :], -30, 30)))
    miss, bend = (1 - p) * some, p * (1 - p) * some
    gradient = np.einsum("ci,cif->f", miss.sum(2), good) - np.einsum("cj,cjf->f", miss.sum(1), bad)
    cross = np.tensordot(good, bend @ bad, ([0, 1], [0, 1]))
    curve = np.tensordot(good * bend.sum(2)[:, :, None], good, ([0, 1], [0, 1])) - cross - cross.T
    curve += np.tensordot(bad * bend.sum(1)[:, :, None], bad, ([0, 1], [0, 1]))
    return np.concatenate([[some.sum()], gradient, curve.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Weights of least logistic loss, from ``pair_sums`` at given weights."""
    w = np.zeros(width)
    for _ in range(30):  # the ridge keeps separable pairs finite
        found = sums(w)
        found = found[1:] / found[0]
        gradient = found[:width] - RIDGE * w
        curve = found[width:].reshape(width, width) + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Weights, with the shift last, of the Bradley-Terry model on all pairs of two sets in memory."""
    everything = np.concatenate([good, bad])
    mean, scale = everything.mean(axis=0), everything.std(axis=0)
    scale[scale == 0] = 1
    w = newton(lambda w: pair_sums(good[None] / scale, bad[None] / scale, w), len(scale)) / scale
    return np.append(w, -(mean @ w))


def dealt(taught: DataFrame, counts: dict[int, int]) -> DataFrame:
    """All rows of ``taught`` (label, _f, _h, doc_id) in cells: (slots, labels, values), ``CELLS`` cells a row."""
    more = max(counts, key=counts.get)
    slots = -(-counts[more] // PARTNERS) * PARTNERS

    def kind(label: int) -> DataFrame:
        rows = taught.where(F.col("label") == label).select("label", "_f", "_h", "doc_id")
        slot = F.col("_n") - 1
        if label != more:  # as often as there are places
            slot = F.explode(F.sequence(slot, F.lit(slots - 1).cast("long"), F.lit(counts[label]).cast("long")))
        return OrderedRanges(rows, ["_h", "doc_id"]).numbered("_n").select(slot.alias("slot"), "label", "_f")

    block = F.floor(F.col("slot") / (PARTNERS * CELLS)).alias("block")
    rows = F.sort_array(F.collect_list(F.struct("slot", "label", "_f"))).alias("rows")
    blocks = kind(0).unionByName(kind(1)).groupBy(block).agg(rows)
    return blocks.select(
        F.col("rows.slot").alias("slots"), F.col("rows.label").alias("labels"), F.flatten("rows._f").alias("values")
    )


def _summed(w: np.ndarray, scale: np.ndarray):
    """Blocks of cells to the sums of this task, in whole quanta as text."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                slots, labels, values = (batch.column(i)[row].values.to_numpy() for i in range(3))
                cells = np.full((2, CELLS, PARTNERS, len(w)), np.nan)
                cell, place = np.divmod(slots % (CELLS * PARTNERS), PARTNERS)
                cells[labels, cell, place] = values.reshape(len(slots), -1) / scale
                found = [int(x) for x in np.rint(pair_sums(cells[1], cells[0], w) / QUANTUM)]
                total = found if total is None else [a + b for a, b in zip(total, found)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[str(x) for x in total]])], ["sums"])

    return summed


def learned(taught: DataFrame, counts: dict[int, int]) -> np.ndarray:
    """Weights of the Bradley-Terry model on all rows of ``taught``; only sums come to the driver."""
    width = taught.select(F.size("_f")).first()[0]
    spread = taught.select(*[F.stddev_pop(F.col("_f")[i]) for i in range(width)]).first()
    # Rounded, as the last digits depend on the order of the rows.
    scale = np.array([float(f"{x:.9g}") for x in spread])
    scale[scale < 1e-12] = 1
    cells = stored(dealt(taught, counts), "quality-cells")

    def sums(w: np.ndarray) -> np.ndarray:
        parts = [[int(x) for x in r["sums"]] for r in cells.mapInArrow(_summed(w, scale), "sums array<string>").collect()]
        return np.array([float(sum(column)) for column in zip(*parts)]) * QUANTUM

    return newton(sums, width) / scale


def labelled(docs: DataFrame, labels: DataFrame, quality: str = "quality") -> DataFrame:
    """(doc_id, label) with label 0 or 1, from the rows that may be learned from."""
    taught = labels.where(F.col("doc_id").isNotNull() & F.col(quality).isNotNull() & ~held_out())
    mean = taught.groupBy("doc_id").agg(F.avg(quality).alias("mean"))
    return mean.where("mean != 0.5").select("doc_id", (F.col("mean") > 0.5).cast("int").alias("label"))


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without their texts, with held_out, score and predicted.

    The texts are read once. Only sums, counts and cut points come to the driver.
    """
    docs, back = set_aside(docs.drop(*OWN), ("doc_id", "text"))
    kept = [c for c in docs.columns if c != "text"]
    rows = stored(docs.select(*kept, features(F.col("text")).alias("_f")), "quality-features")
    rows = rows.withColumn("score", _score(rows, labels))
    return rows.select(
        *[column for column, name in zip(back, docs.columns) if name != "text"],
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted good, with their own columns.

    Scores are computed again on the way out instead of shuffling texts to them.
    """
    rows = stored(docs.select("doc_id", features(F.col("text")).alias("_f")), "quality-features")
    safe, back = set_aside(docs, ("doc_id", "text"))
    scored = safe.withColumn("_f", features(F.col("text")))
    return scored.where(_score(rows, labels) >= CUT).select(*back)


def _score(rows: DataFrame, labels: DataFrame) -> Column:
    taught = rows.select("doc_id", "_f").join(labelled(rows, labels), "doc_id")
    taught = stored(taught.withColumn("_h", F.xxhash64("doc_id", "_f")), "quality-taught")
    counts = {r["label"]: r["count"] for r in taught.groupBy("label").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return F.lit(UNTAUGHT)
    weights = F.array(*[F.lit(float(x)) for x in learned(taught, counts)])
    products = F.zip_with("_f", weights, lambda a, b: a * b)
    line = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    # Halfway between the neighbours of the quantile.
    ranked = OrderedRanges(taught.select(line.alias("_v"), "_h"), ["_v", "_h"])
    threshold = ranked.rows_between(counts[0] - 1, counts[0] + 1, "_at").agg(F.avg("_v")).first()[0]
    return 1 / (1 + F.exp(-(line + F.lit(float(np.log(CUT / (1 - CUT)) - threshold)))))


def op5_quality(spark, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, directory, "labels")).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op5_quality": op5_quality}
SQL: dict[str, str] = {}
