"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parlance.llm.storage import one_row, stored


def _state(edges: DataFrame) -> tuple:
    return one_row(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Nodes with an edge and the smallest node of their component: ``node``, ``label``.

    ``edges`` has the columns ``a`` and ``b``. Each step sends the neighbours of
    a node to the smallest of them; a fixed point is a star per component. The
    steps need about the logarithm of a component's diameter, whatever its size,
    and use aggregates and joins only, so a node with very many edges is not
    gathered anywhere.
    """
    star = stored(spark, edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = _state(star)
    while before[0]:
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = stored(spark, small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "components")
        after = _state(star)
        if after == before:
            break
        before = after
    roots = star.select(F.col("b").alias("node")).distinct()
    return star.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label")))
