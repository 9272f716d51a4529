"""The corpus pipeline: quality, line dedup, near-dedup, mixing and packing, one after the other.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
between stages the rows are written as Parquet below the shared folder. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docops.llm.common import set_aside, stored, table
from docops.llm.linedup import MIN_WORDS, delete_repeats
from docops.llm.mixing import mix
from docops.llm.packing import pack
from docops.llm.quality import good_documents
from docops.llm.simhash import one_of_each


#: Columns that a stage reads; all others pass through it under names that meet no other.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Callable) -> Callable:
    """``stage`` that returns the columns of its ``docs``, whatever their names."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        safe, back = set_aside(docs, COLUMNS)
        return stage(spark, safe, sf_dir).select(*back)

    return run_stage


@keeps_columns
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking learned from the labels predicts to be good."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


@keeps_columns
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of three lines or of over 50 words go, and documents that lose all lines so."""
    rows = delete_repeats(docs, min_words=MIN_WORDS).where("n_removed = 0 OR n_removed < n_lines")
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", length.cast("long")).select(*docs.columns)


@keeps_columns
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, by the operator's own shingles and bits."""
    return one_of_each(docs)


@keeps_columns
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    rows = mix(docs).where("copies > 0").withColumn("copies", F.expr("explode(sequence(1, int(copies)))"))
    return rows.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document of the mix in a bucket of least padding and a token-budget batch."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: Learning and near-duplicate groups have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
