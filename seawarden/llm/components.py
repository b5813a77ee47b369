"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawarden.session import shared_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    joined = both.join(least, F.col("u") == F.col("m_u")).where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; edges go from large to small."""
    least = edges.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
    joined = edges.join(least, F.col("u") == F.col("m_u"))
    moved = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("m_u").alias("u"), F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none: then each star is a component."""
    hanging = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    holding = edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    each = hanging.union(holding).groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return each.where("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node reachable) of every node in links (a, b), both long.

    Alternating stars (Kiveris et al., 2014) until only stars are left: every round is two joins on node ids
    with minima taken before the shuffle, so that a node with very many links is dealt with in parallel. Rounds
    are stored, which cuts the lineage. Every edge keeps a node and its smallest neighbour so far in one star, so
    stars hang on the smallest node of their component.
    """
    spark = links.sparkSession
    work = shared_folder(spark, "components")
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    turn = 0
    while True:
        edges.write.parquet(f"{work}/{turn}")
        edges = spark.read.parquet(f"{work}/{turn}")
        if _are_stars(edges):
            break
        turn += 1
        edges = _small_star(_large_star(edges))
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
