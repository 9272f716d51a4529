"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.session import scratch_path

#: A word is a run of characters other than space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """The words of a text in order; an empty array for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: str | Column) -> Column:
    return F.size(words(text)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read again.

    Cuts the lineage without tying it to an executor, and keeps later steps from
    reading the texts again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def set_aside(docs: DataFrame, used: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``used`` renamed, and what selects them by their own names.

    So no column of a caller can meet one that an operator makes for itself.
    """
    safe = [c if c in used else f"aside{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*safe), [F.col(s).alias(c) for s, c in zip(safe, docs.columns)]


def sample_by_hash(rows: DataFrame, keys: list[str], size: int, count: int) -> DataFrame:
    """``size`` of the ``count`` rows by a hash of ``keys``; all, if there are no more.

    Rows are thinned by the hash before they are ordered, so tasks do not each send
    ``size`` rows on when there are many tasks.
    """
    scale = 1 << 30
    share = min(scale, scale * 3 * size // (2 * max(count, 1)) + 1)
    thinned = rows.where(F.pmod(F.xxhash64(*keys), F.lit(scale)) < share)
    return thinned.orderBy(F.xxhash64(*keys), *keys).limit(size)


def whole_quanta(values: np.ndarray, scale: int, small: int) -> np.ndarray:
    """floor(scale * x), exact for every finite x; ``scale`` is a power of two.

    64-bit numbers if all are below ``small``, else Python's integers.
    """
    scaled = np.floor(values * float(scale))
    if np.abs(scaled).max(initial=0) < small:
        return scaled.astype(np.int64)
    whole = [[(int(n) * scale) // int(d) for n, d in (float(x).as_integer_ratio() for x in row)] for row in values]
    return np.array(whole, dtype=object).reshape(values.shape)
