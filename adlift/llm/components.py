"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlift.llm.frames import written


def _met(edges: DataFrame) -> DataFrame:
    """The different edges (a, b), with the smallest b of their a as ``least``: one exchange by a, no join."""
    around = Window.partitionBy("a").orderBy("b", F.desc("moved"))
    seen = edges.withColumns({"least": F.first("b").over(around), "before": F.lag("b").over(around)})
    return seen.where("before is null or before < b")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    ways = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba")]
    both = edges.select(F.explode(F.array(*ways)).alias("way")).select("way.*", F.lit(False).alias("moved"))
    smallest = F.least("a", "least")
    return _met(both).where("b > a").select(
        F.col("b").alias("a"), smallest.alias("b"), (smallest != F.col("a")).alias("moved")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; edges are from larger to smaller nodes."""
    own = F.col("b") == F.col("least")
    return _met(edges).select(
        F.when(own, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"), (F.col("moved") | ~own).alias("moved")
    )


def forest(links: DataFrame) -> DataFrame:
    """(a, b): every node of the links (a, b) but the smallest of its component, with that smallest one.

    Each round is written to the shared folder and says itself whether it moved
    an edge; rounds grow with the logarithm of the longest chain. A round never
    adds edges. Null ends and links of a node to itself say nothing.
    """
    edges = links.where(F.col("a") != F.col("b")).select("a", "b")
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        if not edges.agg(F.max("moved")).first()[0]:
            return edges.select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component is named by its smallest node."""
    named = forest(links).select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.unionByName(named.select(F.col("component").alias("node"), "component").distinct())
