"""Connected components of undirected links, in DataFrames: alternating large-star and small-star rounds.

Only minima by node are aggregated, so a hub's links are pre-aggregated before they move. Each round is written to the
shared folder; rounds end when the links are stars. Nothing comes to the driver but that answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonalith.session import drop_staged, staged


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of links (a, b): comp is the smallest node that can be reached. Self-links count for nothing else."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = staged(edges, "edges")
    for _ in range(most_rounds):
        # Large star: every neighbour above u hangs on the least of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: u and its lower neighbours hang on the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = staged(small.where("u > v").distinct(), "edges")
        drop_staged(edges)
        edges = new
        # Done when every node hangs on one other, and that one on none.
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("root")))
        if ends.groupBy("x").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where("child + root > 1").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
