"""The document table a stream maintains: plain Parquet, appended by flush.

``root/changes/flush=N`` holds the state after flush N of every key the flush named, and
nothing else. The state of a key is its row of the greatest flush: one grouped read. A
flush that is repeated writes its directory again. ``fold`` is a batch job that writes the
newest state of every key as the base of a new table, from which a stream goes on.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docops.plans.skew import local_frame

STATE = "index string, id string, last_seq long, deleted boolean, source map<string,string>"
#: The flush number of a folded table's base; those of a stream begin at 0.
BASE = -1


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``; no rows if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_frame(spark, [], schema)


class ChangeTable:
    """Keys and their states below ``root``; deleted keys stay as rows, so that late operations show."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def changes(self) -> DataFrame:
        """All rows of all flushes, with the number of the flush."""
        return read_or_empty(self.spark, f"{self.root}/changes", f"{STATE}, flush long")

    def append(self, rows: DataFrame, flush: int) -> None:
        """Writes the states after ``flush``; sorted, so that a reader of few keys skips row groups."""
        ordered = rows.select("index", "id", "last_seq", "deleted", "source").sortWithinPartitions("index", "id")
        ordered.write.mode("overwrite").parquet(f"{self.root}/changes/flush={flush}")

    def state(self, below: int, keys: DataFrame | None = None) -> DataFrame:
        """The newest state before flush ``below`` of all keys, or of those in ``keys``."""
        rows = self.changes().where(F.col("flush") < below)
        if keys is not None:
            same = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("index", "id")]
            rows = rows.alias("r").join(keys.alias("k"), same, "left_semi")
        newest = F.max_by(F.struct("last_seq", "deleted", "source"), "flush").alias("state")
        return rows.groupBy("index", "id").agg(newest).select("index", "id", "state.*")

    def fold(self, path: str, below: int) -> ChangeTable:
        """A new table at ``path`` whose base is the state before flush ``below``, one row for each key."""
        folded = ChangeTable(self.spark, path)
        folded.append(self.state(below), BASE)
        return folded
