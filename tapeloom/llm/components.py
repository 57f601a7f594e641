"""Connected components of a graph given as an edge table, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.session import materialize


def _toward_smallest(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    smallest = both.groupBy("node").agg(F.least(F.min("low"), F.col("node")).alias("root"))
    return (
        both.filter(F.col("low") > F.col("node"))
        .join(smallest, "node")
        .select(F.col("low").alias("node"), F.col("root").alias("low"))
        .distinct()
    )


def _fold_smaller(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and itself, move to the smallest of them."""
    smallest = edges.groupBy("node").agg(F.min("low").alias("root"))
    moved = edges.join(smallest, "node").filter(F.col("low") > F.col("root"))
    return (
        moved.select(F.col("low").alias("node"), F.col("root").alias("low"))
        .union(smallest.select("node", F.col("root").alias("low")))
        .distinct()
    )


def connected(spark: SparkSession, edges: DataFrame, left: str, right: str) -> DataFrame:
    """`node`, `root` for every node of an edge, `root` being the smallest node of its component.

    Edges are rewired until each component is a star around its smallest node. A node with very many
    edges is only ever a join key next to a one-row side, or an aggregate with map-side combine. Loops
    and repeated edges do not matter, nodes must not be null; no edge gives an empty table.
    """
    ordered = edges.select(
        F.greatest(left, right).alias("node"), F.least(left, right).alias("low")
    ).filter("node <> low")
    current, before = materialize(spark, ordered.distinct(), "edges"), None
    while True:
        after = current.agg(F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
        if after == before or after[0] == 0:
            break
        before = after
        current = materialize(spark, _fold_smaller(_toward_smallest(current)), "edges")
    stars = current.select("node", F.col("low").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root")).distinct()
