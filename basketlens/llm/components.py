"""Connected components as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import stored


def _least(pairs: DataFrame, name: str) -> DataFrame:
    """(x, m): the smallest y of every x. Stored, so that the join back to the
    pairs is one of two plain shuffles, which Spark splits where an x is hot."""
    return stored(pairs.groupBy("x").agg(F.min("y").alias("m")), name)


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link at most and no root has a link itself."""
    ends = links.select(F.col("x").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("y").alias("k"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per_node = ends.groupBy("k").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return per_node.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b: long): root is the smallest
    node of its component.

    Alternates the large star (larger neighbours point to the smallest neighbour)
    and the small star (smaller neighbours do) until every component is one star;
    the number of rounds grows with the logarithm of the longest path.
    """
    links = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
                   .distinct(), "links")
    while not _settled(links):
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        large = both.join(_least(both, "least"), "x").filter("y > x").select(
            F.col("y").alias("x"), F.least("x", "m").alias("y"))
        large = stored(large.distinct(), "large-star")
        small = large.join(_least(large, "least"), "x")
        links = stored(small.select(F.explode(F.array(
            F.struct(F.col("x"), F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y"))))
            .alias("e")).select("e.x", "e.y").filter("x != y").distinct(), "links")
    roots = links.select(F.col("y").alias("node")).distinct()
    return links.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(
        roots.withColumn("root", F.col("node")))
