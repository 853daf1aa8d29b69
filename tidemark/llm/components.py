"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that has an edge; root is the smallest node reachable.

    ``edges`` has two columns of one ordered type. Loops, repeats and either direction are
    allowed; edges with a null are ignored; no edges give no rows. Every round reads and
    writes edge tables only, checkpointed in the shared folder, so lost executors cost one
    round; neighbours are never gathered into one row.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    current = (
        edges.where(a != b)
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
        .checkpoint()
    )
    seen = None
    while True:
        current = _small_star(_large_star(current)).checkpoint()
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    linked = both.where("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").where("b > m")
    moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
