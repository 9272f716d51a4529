"""Reports on bulk writes and searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docops.functions.formats import fmt_doc_speed, fmt_duration_words, fmt_size, fmt_speed
from docops.operators.changelog import OK
from docops.plans.skew import number_rows


def bulk_report(judged: DataFrame, writer: str, size: str, millis: str) -> DataFrame:
    """Per writer: submitted, succeeded, failed, bytes, elapsed time and rates.

    ``millis`` is when an operation was sent; the elapsed time is its span. A
    writer without any elapsed time has no rates.
    """
    counted = judged.groupBy(writer).agg(
        F.count("*").alias("submitted"),
        F.count_if(F.col("outcome") == OK).alias("succeeded"),
        F.count_if(F.col("outcome") != OK).alias("failed"),
        F.sum(size).alias("bytes"),
        (F.max(millis) - F.min(millis)).alias("elapsed"),
    )
    span = F.nullif(F.col("elapsed"), F.lit(0).cast("long"))
    return counted.select(
        "*",
        (F.col("succeeded") * F.lit(1000.0) / span).alias("docs_per_second"),
        (F.col("bytes") * F.lit(1000.0) / span).alias("bytes_per_second"),
        (F.col("bytes") / (F.col("succeeded") + F.lit(1.0))).alias("mean_bytes"),
    )


def describe_bulk_report(report: DataFrame) -> DataFrame:
    """The report with its numbers as text."""
    return report.select(
        "*",
        fmt_duration_words(F.col("elapsed"), True, True).alias("elapsed_text"),
        fmt_size(F.col("bytes")).alias("bytes_text"),
        fmt_size(F.col("mean_bytes"), whole=False).alias("mean_text"),
        fmt_doc_speed(F.col("docs_per_second"), whole=False).alias("docs_speed_text"),
        fmt_speed(F.col("bytes_per_second"), whole=False).alias("bytes_speed_text"),
    )


def throughput_blocks(
    requests: DataFrame, writer: str, seq: str, took: str, size: str, block: int, hot_rows: int | None = None
) -> DataFrame:
    """Per writer and complete block of ``block`` requests: time, size and throughput statistics.

    ``delta`` compares with the writer's block before. Each block is also handed to
    its successor by number, so the comparison needs no ordered scan per writer.
    """
    numbered = number_rows(requests.select(writer, seq, took, size), [writer], seq, "_position", hot_rows)
    stats = (
        numbered.withColumn("block", F.call_function("div", F.col("_position") - 1, F.lit(block).cast("long")))
        .groupBy(writer, "block")
        .agg(
            F.count("*").alias("_n"),
            F.avg(took).alias("avg_took"),
            F.min(took).alias("min_took"),
            F.max(took).alias("max_took"),
            F.avg(size).alias("avg_size"),
            F.min(size).alias("min_size"),
            F.max(size).alias("max_size"),
        )
        .where(F.col("_n") == block)
        .drop("_n")
        .withColumn("throughput", F.col("avg_size") / F.nullif(F.col("avg_took"), F.lit(0.0)))
    )
    values = [c for c in stats.columns if c not in (writer, "block")]
    own = F.struct(F.col("block").alias("at"), F.struct(*values).alias("own"), _nothing().alias("before"))
    nxt = F.struct(
        (F.col("block") + 1).alias("at"),
        F.lit(None).cast(_struct_type(stats, values)).alias("own"),
        F.col("throughput").alias("before"),
    )
    paired = (
        stats.select(writer, F.inline(F.array(own, nxt)))
        .groupBy(writer, "at")
        .agg(F.max("own").alias("own"), F.max("before").alias("before"))
        .where(F.col("own").isNotNull())
        .select(writer, F.col("at").alias("block"), "own.*", "before")
    )
    delta = F.coalesce(F.col("throughput") - F.col("before"), F.lit(0.0))
    return paired.withColumn("delta", delta).withColumn(
        "delta_percent", F.col("delta") * 100 / F.nullif(F.col("throughput"), F.lit(0.0))
    ).drop("before")


def _nothing() -> Column:
    return F.lit(None).cast("double")


def _struct_type(df: DataFrame, names: list[str]) -> str:
    return "struct<" + ",".join(f"{n}:{df.schema[n].dataType.simpleString()}" for n in names) + ">"


def search_report(queries: DataFrame) -> DataFrame:
    """Outcomes of a query log (``failed_shards, timed_out, hits``) by one rule for every kind of query.

    A query counts once: failed before timed out before empty before succeeded.
    """
    outcome = (
        F.when(F.col("failed_shards") > 0, "failed")
        .when(F.col("timed_out"), "timeout")
        .when(F.col("hits") == 0, "empty")
        .otherwise("succeeded")
    )
    kinds = ("succeeded", "empty", "failed", "timeout")
    return queries.select(outcome.alias("outcome")).agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("outcome") == kind).alias(kind) for kind in kinds],
    )
