"""Connected components of a graph given as edges, by alternating stars.

Each round does two steps. Large star: every node links its larger neighbours
to the smallest node around it. Small star: every node links its smaller
neighbours and itself to the smallest of them. Edges never grow in number and
end as one star per component around its smallest node, after a number of
rounds that grows like the square of the log of the longest path at worst.

A step is an aggregate (combined on the map side, so a hub's edges meet as one
row per task) and an equi-join. The aggregate is written out first: the join is
then between two plain shuffles, which adaptive execution splits for a hub.
Each round is written to the shared checkpoint folder. Nothing is collected but one
count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u").where("v > u AND v <> m")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge arrives with u > v.
    least = _least(edges)
    joined = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge that is not its component's
    smallest node; ``root`` is that smallest node."""
    up = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct().checkpoint()
    state = None
    while True:
        mark = up.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            return up.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(mark)
        up = _small_star(_large_star(up)).checkpoint()
