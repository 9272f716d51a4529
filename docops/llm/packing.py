"""Packing documents into token-budget batches inside length buckets of least padding.

Every document is padded to the width of its bucket, the largest length in it. A
dynamic programme over the histogram of all lengths chooses the bucket borders for
which the padding of the whole corpus is smallest. Inside a bucket the documents
are put in a fixed random order and cut into batches of ``budget // width`` places.

* Null text counts as empty; empty documents are packed like others, with padding only.
* A document longer than the budget gets a batch of its own, so none is dropped.
* Repeated rows are packed each on their own; rows without id come first in order.
* An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docops.llm.common import stored, table, word_count

BUCKETS = 8
BUDGET = 16_384
#: Lengths below 2**EXACT_BITS are told apart; longer ones to one part in 2**(EXACT_BITS - 1),
#: so that the histogram has at most 4,096 bins for each doubling whatever the corpus.
EXACT_BITS = 13
#: Aimed-at rows of a block, and the most hexadecimal digits that name one.
BLOCK_ROWS = 256
BLOCK_DIGITS = 4


def _bin(length: str) -> str:
    step = f"shiftleft(CAST(1 AS BIGINT), greatest(0, length(bin({length})) - {EXACT_BITS}))"
    return f"(({length} + {step} - 1) div {step}) * {step}"


def best_widths(widths: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """The bucket widths, ascending, that make total padding smallest.

    ``widths`` are the ascending lengths of the histogram, ``sums`` the tokens in each
    bin. The cost of a bucket fulfils the quadrangle inequality, so the best split
    moves right with the end and each layer is found by divide and conquer. Among
    equally good splits the one furthest left is taken.
    """
    bins = len(widths)
    if not bins:
        return []
    before = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(sums)])

    def cost(first, last):
        return widths[last - 1] * (before[last] - before[first]) - (tokens[last] - tokens[first])

    layers = min(buckets, bins)
    ends = np.arange(1, bins + 1)
    best = np.concatenate([[0], cost(0, ends)])
    splits = []
    for layer in range(2, layers + 1):
        current, split = np.zeros(bins + 1, dtype=np.int64), np.zeros(bins + 1, dtype=np.int64)
        todo = [(layer, bins, layer - 1, bins - 1)]
        while todo:
            low, high, left, right = todo.pop()
            if low > high:
                continue
            end = (low + high) // 2
            starts = np.arange(left, min(right, end - 1) + 1)
            totals = best[starts] + cost(starts, end)
            at = int(np.argmin(totals))
            current[end], split[end] = totals[at], starts[at]
            todo += [(low, end - 1, left, starts[at]), (end + 1, high, starts[at], right)]
        best = current
        splits.append(split)
    chosen, end = [], bins
    for split in reversed([np.zeros(bins + 1, dtype=np.int64), *splits]):
        chosen.append(int(widths[end - 1]))
        end = int(split[end])
    return chosen[::-1]


def pack_lengths(lengths: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Packs rows of (doc_id, n_tokens): adds bucket, width, batch, slot and padding.

    Only the histogram, bounded by ``EXACT_BITS``, comes to the driver. Places are
    numbered in blocks of the random order, so no bucket is sorted in one task.
    """
    binned = lengths.withColumn("_bin", F.expr(_bin("n_tokens")))
    histogram = (
        binned.groupBy("_bin")
        .agg(F.max("n_tokens").alias("w"), F.count("*").alias("n"), F.sum("n_tokens").alias("s"))
        .toPandas()
        .sort_values("w")
    )
    widths = best_widths(*(histogram[c].to_numpy(dtype=np.int64) for c in ("w", "n", "s")), buckets)
    rows = int(histogram["n"].sum())
    digits = min(BLOCK_DIGITS, max(0, math.ceil(math.log(max(rows, 1) / BLOCK_ROWS, 16))))
    bucket, width = F.lit(max(len(widths) - 1, 0)), F.lit(widths[-1] if widths else 0).cast("long")
    for i in range(len(widths) - 2, -1, -1):
        inside = F.col("n_tokens") <= widths[i]
        bucket = F.when(inside, i).otherwise(bucket)
        width = F.when(inside, F.lit(widths[i]).cast("long")).otherwise(width)
    key = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    placed = lengths.select(
        "doc_id", "n_tokens", bucket.alias("bucket"), width.alias("width"), key.alias("_key")
    ).withColumn("_block", F.substring("_key", 1, digits))
    sizes = placed.groupBy("bucket", "_block").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("bucket").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(
        Window.partitionBy("bucket", "_block").orderBy("_key", "doc_id", F.col("n_tokens").desc())
    )
    place = F.col("_before") + F.col("_inside") - 1
    capacity = F.greatest(F.lit(1), F.expr(f"{int(budget)} div greatest(1, width)"))
    return (
        placed.withColumn("_inside", inside)
        .join(offsets, ["bucket", "_block"])
        .select(
            "doc_id",
            "n_tokens",
            "bucket",
            "width",
            F.floor(place / capacity).cast("long").alias("batch"),
            (place % capacity).cast("long").alias("slot"),
            (F.col("width") - F.col("n_tokens")).alias("padding"),
        )
    )


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Packs documents by their number of words; the texts are read once."""
    lengths = docs.select("doc_id", word_count("text").alias("n_tokens"))
    return pack_lengths(stored(lengths, "packing"), buckets, budget)


def op1_packing(spark, directory: str) -> DataFrame:
    return pack(table(spark, directory, "documents"))


def packing_sql(buckets: int = BUCKETS, budget: int = BUDGET, source: str = "documents") -> str:
    """DuckDB SQL for ``pack``: the same programme layer by layer, every split tried."""
    step = f"(CAST(1 AS BIGINT) << greatest(0, length(bin(n_tokens)) - {EXACT_BITS}))"
    layers = [
        "f1 AS MATERIALIZED (SELECT e.j, e.w * e.c - e.s AS f, 0 AS i FROM ends e)",
    ]
    for k in range(2, buckets + 1):
        layers.append(
            f"f{k} AS MATERIALIZED (SELECT j, min(t) AS f, CAST(min(i) FILTER (t = best) AS BIGINT) AS i FROM ("
            f"SELECT e.j, p.j AS i, p.f + e.w * (e.c - q.c) - (e.s - q.s) AS t, "
            f"min(p.f + e.w * (e.c - q.c) - (e.s - q.s)) OVER (PARTITION BY e.j) AS best "
            f"FROM ends e JOIN f{k - 1} p ON p.j < e.j JOIN ends q ON q.j = p.j) GROUP BY j)"
        )
    backs = ["b{0} AS (SELECT max(j) AS j FROM ends)".format(buckets)]
    for k in range(buckets, 1, -1):
        backs.append(
            f"b{k - 1} AS (SELECT coalesce((SELECT f.i FROM f{k} f WHERE f.j = b.j AND "
            f"(SELECT count(*) FROM ends) >= {k}), b.j) AS j FROM b{k} b)"
        )
    chosen = " UNION ".join(f"SELECT j FROM b{k}" for k in range(1, buckets + 1))
    return f"""
WITH sized AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT)
        AS n_tokens FROM {source}),
bins AS (SELECT max(n_tokens) AS w, count(*) AS n, sum(n_tokens) AS s FROM sized
    GROUP BY ((n_tokens + {step} - 1) // {step}) * {step}),
ends AS MATERIALIZED (SELECT row_number() OVER (ORDER BY w) AS j, w, CAST(sum(n) OVER (ORDER BY w) AS BIGINT) AS c,
    CAST(sum(s) OVER (ORDER BY w) AS BIGINT) AS s FROM bins),
{", ".join(layers)},
{", ".join(backs)},
cuts AS (SELECT e.w AS width, row_number() OVER (ORDER BY e.w) - 1 AS bucket
    FROM ends e WHERE e.j IN ({chosen})),
placed AS (SELECT doc_id, n_tokens, (SELECT min(width) FROM cuts WHERE width >= n_tokens) AS width FROM sized),
ranked AS (SELECT p.doc_id, p.n_tokens, c.bucket, p.width, row_number() OVER (PARTITION BY c.bucket
    ORDER BY coalesce(md5(CAST(doc_id AS VARCHAR)), ''), doc_id NULLS FIRST, n_tokens DESC) - 1 AS place,
    greatest(1, {budget} // greatest(1, p.width)) AS capacity FROM placed p JOIN cuts c USING (width))
SELECT doc_id, n_tokens, CAST(bucket AS INTEGER) AS bucket, width, CAST(place // capacity AS BIGINT) AS batch,
    CAST(place % capacity AS BIGINT) AS slot, width - n_tokens AS padding FROM ranked"""


QUERIES = {"op1_packing": op1_packing}
SQL = {"op1_packing": packing_sql()}
