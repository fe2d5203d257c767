"""Connected components of a table of links, by alternating large-star and small-star steps in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlens.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u``, ``v``) but the roots, the least node of each component.

    Each step is stored, so lineage stays short.  A step joins one row per node to its links, which Spark can
    split; nothing is collected.
    """
    edges = materialize(edges.filter("u <> v").distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("out")))
        wrong = ends.groupBy("n").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
        if wrong.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("least") == 0))).isEmpty():  # every component is a star
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
