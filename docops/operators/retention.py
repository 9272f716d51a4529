"""Retention over dated indices: which to keep, which to delete."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docops.functions.names import NAME_PATTERN, base_of, suffix_of
from docops.operators.catalog import OPEN, drop_indices
from docops.plans.skew import local_frame

# Defaults of a retention policy, results, and what happens to a candidate.
DELTA = 2
MIN_TO_KEEP = 2
NONE, SUCCESS = "NONE", "SUCCESS"
KEEP, DROP = "keep", "delete"


@dataclass(frozen=True)
class Retention:
    """Keep at least ``min_to_keep`` indices; drop those ``delta`` or more behind the current one.

    The distance is the difference of the numeric suffixes, not of dates.
    """

    base: str
    full: str
    delta: int = DELTA
    min_to_keep: int = MIN_TO_KEEP
    enabled: bool = True

    def applies(self) -> bool:
        return self.enabled and self.base != self.full and not (self.delta == 0 and self.min_to_keep == 0)


_POLICY = "base string, full string, delta long, min_to_keep long, current long"


def _policies(spark: SparkSession, rules: list[Retention], pattern: str) -> DataFrame:
    rows = [(r.base, r.full, r.delta, r.min_to_keep, None) for r in rules if r.applies()]
    return local_frame(spark, rows, _POLICY).withColumn("current", suffix_of(F.col("full"), pattern))


def plan_retention(catalog: DataFrame, rules: list[Retention], pattern: str = NAME_PATTERN) -> DataFrame:
    """Candidates with their fate: ``base, index, action``; one that any rule deletes is deleted.

    Candidates are open indices of the base other than the current one. In text
    order they are deleted while far enough behind and while at least
    ``min_to_keep`` would have been left before the step, counting no other index.
    """
    policies = F.broadcast(_policies(catalog.sparkSession, rules, pattern))  # one row per rule
    candidates = (
        catalog.where(F.col("state") == OPEN)
        .select("index", base_of(F.col("index"), pattern).alias("base"),
                suffix_of(F.col("index"), pattern).alias("number"))
        .where(F.col("number").isNotNull())
        .join(policies, "base")
        .where(F.col("index") != F.col("full"))
    )
    behind = (F.col("delta") == 0) | ((F.col("delta") > 0) & (F.col("current") - F.col("number") >= F.col("delta")))
    eligible = F.coalesce(behind, F.lit(False)) & F.col("current").isNotNull()
    of_base = Window.partitionBy("base", "full")  # a rule; two rules on one base do not mix
    ranked = (
        candidates.withColumn("_eligible", eligible)
        .withColumn("_n", F.count("*").over(of_base))
        .withColumn("_rank", F.sum(F.col("_eligible").cast("long")).over(of_base.orderBy("index")))
    )
    spared = (F.col("min_to_keep") > 0) & (F.col("_n") <= F.col("min_to_keep"))
    deleted = F.col("_eligible") & ~spared & (F.col("_rank") <= F.col("_n") - F.col("min_to_keep") + 1)
    fate = F.when(F.bool_or(deleted), DROP).otherwise(KEEP)
    return ranked.groupBy("base", "index").agg(fate.alias("action"))


def retention_result(planned: DataFrame, rules: list[Retention]) -> DataFrame:
    """Per base: NONE without candidates, else SUCCESS, with the numbers of candidates and deletions."""
    spark = planned.sparkSession
    bases = local_frame(spark, [(r.base,) for r in rules], "base string").distinct()
    counts = planned.groupBy("base").agg(
        F.count("*").alias("candidates"), F.count_if(F.col("action") == DROP).alias("deleted")
    )
    return bases.join(counts, "base", "left").select(
        "base",
        F.when(F.col("candidates").isNull(), NONE).otherwise(SUCCESS).alias("state"),
        F.coalesce("candidates", F.lit(0)).cast("long").alias("candidates"),
        F.coalesce("deleted", F.lit(0)).cast("long").alias("deleted"),
    )


def apply_retention(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """The rows that remain after the planned deletions."""
    return drop_indices(docs, planned.where(F.col("action") == DROP))
