"""Connected components of a graph given as edges, by alternating large and
small stars: every node ends up linked to the smallest node of its component."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpuslab.session import drop_table, scratch_path


def _hang(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    return pairs.join(smallest, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour.

    The smallest neighbour is a combinable minimum, so a node with very many
    neighbours is not gathered; the join back is an equi-join that adaptive
    execution splits where it is skewed.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _hang(both, smallest).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = _hang(edges, smallest).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.union(smallest.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node that
    is not itself a root. ``edges`` has two columns of one type; loops and
    repeats are ignored. Each round is a written table, read by the next."""
    spark = edges.sparkSession
    left, right = edges.columns
    current = (
        edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).filter("a > b").distinct()
    )
    seen = kept = None
    while True:
        path = scratch_path(spark, "stars")
        (current if kept is None else _small_star(_large_star(current))).write.parquet(path)
        current = spark.read.parquet(path)
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if kept is not None:
            drop_table(kept)
        if tuple(state) == seen or not state["n"]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, kept = tuple(state), path
