"""Connected components of links between long ids, as alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each id onto its smallest one."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("w")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of each id, and the id, onto the smallest of them; u > v throughout."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = edges.join(least, F.col("u") == F.col("w")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, root) for each id that a link (u, v) holds; the root is the smallest id of the component.

    Ends when every id hangs directly on a root, that is, when no id is both above and below.
    """
    edges = links.where(F.col("u") != F.col("v"))
    edges = checkpoint(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(MOST_ROUNDS):
        edges = checkpoint(_small_star(_large_star(edges)))
        parents = edges.groupBy("u").agg(F.count("*").alias("n"))
        crowded = parents.where(F.col("n") > 1).select("u")
        chained = edges.join(edges.select(F.col("u").alias("x")), F.col("v") == F.col("x"), "left_semi").select("u")
        if crowded.union(chained).isEmpty():
            roots = edges.select(F.col("v").alias("id")).distinct().withColumn("root", F.col("id"))
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(roots)
    raise RuntimeError("the components did not settle")
