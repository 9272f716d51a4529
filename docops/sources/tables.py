"""Document tables on disk: one partition per index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docops.functions.names import DATE_SUFFIX, dated_name
from docops.operators.keyed import ids_of


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def route(df: DataFrame, base: str, timestamp: str, pattern: str = DATE_SUFFIX) -> DataFrame:
    """Adds ``index``, the dated index each row belongs to."""
    return df.withColumn("index", dated_name(df, base, timestamp, pattern))


def write_routed(df: DataFrame, path: str, mode: str = "append") -> None:
    """Writes one directory per index.

    Rebalancing gathers an index into full-size files and still splits an index
    that is too large for one task.
    """
    df.hint("rebalance", "index").write.mode(mode).partitionBy("index").parquet(path)


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("index", F.col("index").cast("string"))


def write_keyed(df: DataFrame, path: str, key: str, files: int, group_bytes: int = 16 << 20, mode: str = "append") -> None:
    """Writes ``df`` for reads by ``key``: ordered ranges, sorted, with a Bloom filter for each row group.

    A read of a few keys then takes only the row groups that hold them. Smaller groups
    are skipped more finely and cost more metadata.
    """
    ordered = df.repartitionByRange(files, key).sortWithinPartitions(key)
    ordered.write.mode(mode).option(f"parquet.bloom.filter.enabled#{key}", "true").option(
        "parquet.block.size", str(group_bytes)
    ).parquet(path)


def file_counts(table: DataFrame) -> DataFrame:
    """Rows and data files per index of a routed table."""
    return (
        table.select("index", F.input_file_name().alias("file"))
        .groupBy("index", "file")
        .agg(F.count("*").alias("n"))
        .groupBy("index")
        .agg(F.sum("n").alias("docs"), F.count("*").alias("files"))
    )


def compact(table: DataFrame, index: str, path: str, files: int, enabled: bool = True) -> bool:
    """Rewrites one index of ``table`` into at most ``files`` files below a new ``path``, rows unchanged.

    Only that index is read. The caller swaps the new directory in. Does nothing
    unless the index definition allows it.
    """
    if not enabled:
        return False
    chosen = table.where(F.col("index") == index)
    chosen.repartition(files).write.mode("errorifexists").partitionBy("index").parquet(path)
    return True


def with_auto_id(df: DataFrame, seq: str, source: str) -> DataFrame:
    """Fills a missing id with a hash of the operation, so a retried task makes the same id."""
    generated = F.sha2(F.concat_ws("|", F.col(seq).cast("string"), F.col(source)), 256)
    return df.withColumn("id", F.coalesce("id", generated))


def dump_ids(docs: DataFrame, path: str, predicate: Column | None = None) -> None:
    """Writes the matching ids as text, one per line."""
    ids_of(docs, predicate).write.mode("errorifexists").text(path)
