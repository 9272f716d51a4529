"""Connected components by contraction, for links that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docops.llm.common import stored


def _mapped(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by its parent where it has one."""
    side = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    joined = rows.join(side, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_parent", column)).select(*rows.columns)


def _compressed(parents: DataFrame) -> DataFrame:
    """``parents`` with every node pointing at the root of its tree, by pointer doubling."""
    while True:
        moved = _mapped(parents.withColumn("old", F.col("parent")), "parent", parents)
        parents = stored(moved, "graph-parents")
        if not parents.where("parent <> old").limit(1).count():
            return parents.drop("old")
        parents = parents.drop("old")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), but not for roots themselves.

    In each round every node joins its smallest neighbour if that is smaller, the trees are
    compressed, and the links are rewritten between their roots. Each round at least
    halves the nodes that still have links. A node with very many links is only met in
    minima, which are combined before the shuffle, and in joins that can be split.
    """
    spark = links.sparkSession
    rest = stored(links.where("a <> b").select("a", "b").distinct(), "graph-links")
    found = spark.createDataFrame([], "node long, parent long")
    first = True
    while rest.limit(1).count():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        parents = _compressed(stored(least.where("parent < node"), "graph-parents"))
        found = parents if first else stored(_mapped(found, "parent", parents).unionByName(parents), "graph-found")
        first = False
        moved = _mapped(_mapped(rest, "a", parents), "b", parents).where("a <> b")
        rest = stored(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph-links")
    return found.select("node", F.col("parent").alias("root"))
