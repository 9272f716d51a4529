"""Streaming ingest: an operation stream applied to a change table, flush by flush."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docops.operators.changelog import (
    DELETE,
    INDEX,
    KEY,
    OK,
    OPERATION,
    BulkFailedError,
    apply_changes,
    hot_documents,
    outcomes,
)
from docops.plans.skew import checked_broadcast, join_summary, local_frame
from docops.streaming.changes import BASE, ChangeTable, read_or_empty

# Time between flushes, and the outcome of an operation that came too late.
FLUSH_INTERVAL = "30 seconds"
LATE = "late"

_COUNTS = ("submitted", "succeeded", "failed", "late")
_METRICS = "batch long, submitted long, succeeded long, failed long, late long"
_JUDGED = "seq long, index string, id string, op string, outcome string, flush long"


def flush_trigger(interval: str | None = FLUSH_INTERVAL, drain: bool = False) -> dict:
    """Trigger options: flush by time, or drain everything that is there and stop."""
    return {"availableNow": True} if drain else {"processingTime": interval}


def operation_stream(
    spark: SparkSession, path: str, schema: StructType, files: int | None = None, volume: int | None = None
) -> DataFrame:
    """Operations arriving as Parquet files; a flush takes up to ``files`` files or about ``volume`` bytes.

    Files are taken whole, so a flush is larger than ``volume`` only by a file that is
    larger by itself.
    """
    if files is not None and volume is not None:
        raise ValueError("a flush is limited by files or by bytes, not by both")
    reader = spark.readStream.schema(schema)
    for option, limit in (("maxFilesPerTrigger", files), ("maxBytesPerTrigger", volume)):
        reader = reader if limit is None else reader.option(option, limit)
    return reader.parquet(path)


class BulkIngest:
    """Applies batches of ``seq, index, id, op, source`` to the change table below ``root``.

    Within a flush ``seq`` decides. An operation at or below the last applied
    ``seq`` of its key is late: it is counted and dropped. A flush counts once its metrics
    are written, which is the last thing it does.
    """

    def __init__(self, spark: SparkSession, root: str, fail_on_error: bool = True, checkpoint: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.table = ChangeTable(spark, root)
        self.fail_on_error = fail_on_error
        self.checkpoint = checkpoint or f"{self.root}/checkpoint"

    def flush(self, ops: DataFrame, batch: int) -> None:
        """Applies one batch; repeating it writes the same rows again."""
        kept = []

        def keep(df: DataFrame) -> DataFrame:
            kept.append(df.persist())
            return kept[-1]

        try:
            self._flush(keep(ops.select(*OPERATION)), batch, keep)
        finally:
            for df in kept:
                df.unpersist()

    def _flush(self, ops: DataFrame, batch: int, keep: Callable[[DataFrame], DataFrame]) -> None:
        keys = checked_broadcast(ops.select(*KEY).distinct())
        # Both are used by the search for hot keys, the outcomes and the new states: joined once.
        before = keep(self.table.state(batch, keys))
        marked = keep(
            join_summary(ops, before, KEY, ["last_seq"]).withColumn(
                "late", F.coalesce(F.col("seq") <= F.col("last_seq"), F.lit(False))
            )
        )
        base = before.select(
            F.col("last_seq").alias("seq"),
            *KEY,
            F.when(F.col("deleted"), DELETE).otherwise(INDEX).alias("op"),
            "source",
            F.lit(True).alias("stored"),
        )
        fresh = marked.where(~F.col("late")).select(*OPERATION, F.lit(False).alias("stored"))
        rows = base.unionByName(fresh)
        hot = hot_documents(rows)
        counts = self._judge(outcomes(rows, hot=hot).where(~F.col("stored")), marked, batch)
        if self.fail_on_error and counts["failed"]:
            raise BulkFailedError(f"bulk failed: flush = {batch}, n = {counts['failed']}")
        self.table.append(apply_changes(rows, keep_deleted=True, hot=hot), batch)
        metrics = local_frame(self.spark, [(batch, *counts.values())], _METRICS)
        metrics.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/metrics/flush={batch}")

    def _judge(self, judged: DataFrame, marked: DataFrame, batch: int) -> dict[str, int]:
        """Writes the outcome of every operation of the flush; they are counted as they are written."""
        columns = ["seq", *KEY, "op", "outcome"]
        late = marked.where("late").withColumn("outcome", F.lit(LATE)).select(*columns)
        counted = Observation(f"flush {batch}")
        outcome = F.col("outcome")
        rows = judged.select(*columns).unionByName(late).observe(
            counted,
            F.count(F.lit(1)).alias("submitted"),
            F.count_if(outcome == OK).alias("succeeded"),
            F.count_if(~outcome.isin(OK, LATE)).alias("failed"),
            F.count_if(outcome == LATE).alias("late"),
        )
        rows.write.mode("overwrite").parquet(f"{self.root}/outcomes/flush={batch}")
        # Nothing is observed where Spark can tell beforehand that there is no row.
        return {name: counted.get.get(name, 0) for name in _COUNTS}

    def flushed(self) -> int:
        """The number after that of the last flush that is complete."""
        last = self.metrics().agg(F.max("batch")).first()[0]
        return BASE + 1 if last is None else last + 1

    def documents(self) -> DataFrame:
        """The live documents after the last complete flush."""
        return self.table.state(self.flushed()).where(~F.col("deleted")).select("index", "id", "last_seq", "source")

    def metrics(self) -> DataFrame:
        """One row per flush: submitted, succeeded, failed, late."""
        return read_or_empty(self.spark, f"{self.root}/metrics", f"{_METRICS}, flush long").drop("flush")

    def judged(self) -> DataFrame:
        """Every operation with its outcome and flush, those of a flush that was stopped too."""
        return read_or_empty(self.spark, f"{self.root}/outcomes", _JUDGED)

    def folded(self, root: str) -> BulkIngest:
        """Folds the table into a new one at ``root`` and goes on there, from the same place in the stream.

        Run it between flushes; the old table stays as it is.
        """
        self.table.fold(root, self.flushed())
        return BulkIngest(self.spark, root, self.fail_on_error, self.checkpoint)

    def start(self, ops: DataFrame, interval: str | None = FLUSH_INTERVAL, drain: bool = False) -> StreamingQuery:
        """Starts the stream; progress and flushes survive a restart with the same checkpoint."""
        return (
            ops.writeStream.foreachBatch(self.flush)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**flush_trigger(interval, drain))
            .start()
        )
