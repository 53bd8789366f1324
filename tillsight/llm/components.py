"""Connected components of a graph in tables, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage


def _stars(edges: DataFrame) -> bool:
    """Whether every upper node has one edge and no lower node is an upper one: then nothing is left to hang."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("low")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("low").alias("low")).filter("up + low > 1").count() == 0


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Nodes that have an edge, with the smallest node they can reach: node, root.

    Each round hangs the larger neighbours of a node, then the smaller ones,
    under the smallest known; it ends when only stars are left. Rounds are written
    tables, so neither lineage nor executors have to last.
    """
    known = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    known = stage(known, "edges")
    for _ in range(most_rounds):
        if _stars(known):
            break
        both = known.unionByName(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        least = stage(least, "least")  # both sides of the joins are then plain shuffles, which split a hot node
        large = both.join(least, both.u == least.c).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "edges")
        least = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        least = stage(least, "least")
        hung = large.join(least, large.u == least.c).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        known = stage(hung.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = known.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return known.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
