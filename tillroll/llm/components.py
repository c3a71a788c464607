"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.workspace import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), "m")
    return others.unionByName(least).select("u", F.col("m").alias("v"))


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    mixed = (F.sum((h % 1_000_003).cast("decimal(38,0)")), F.sum((h % 998_244_353).cast("decimal(38,0)")))
    return tuple(edges.agg(F.count(F.lit(1)), *mixed).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node reachable.

    ``edges`` has long columns u and v. Each round writes its edges to the shared folder;
    the number of rounds grows with the logarithm of the graph. Null ends and self links
    are ignored.
    """
    clean = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stage(clean.distinct(), "edges")
    before, same = None, _digest(now)
    while before != same and same[0]:
        before = same
        now = stage(_small_star(_large_star(now).distinct()).where("u <> v").distinct(), "edges")
        same = _digest(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
