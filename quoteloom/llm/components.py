"""Connected components of a graph given as edges, by alternating large and small stars.

Each round is two aggregations and two joins over the edges.  Minima are combined before
they are shuffled and joins leave hot nodes to Spark to split, so a node with very many
neighbours is no hot task.  Rounds grow with the logarithm of a component's size.  Each
round's edges are written to the shared folder and read back, which cuts the lineage; those of
the round before are removed then, and only the last ones stay for the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.shared import Landing


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least of u and all its neighbours."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down)
    return linked.select(
        F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
        F.col("m").alias("v"),
    ).union(linked.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of an edge to another node; component is its least node.

    Edges with a null end and loops are ignored; repeated edges count once.
    """
    now = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v").distinct()
    landing = Landing(edges.sparkSession)
    now = landing.land(now, "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        older, landing = landing, Landing(edges.sparkSession)
        now = landing.land(_small_star(_large_star(now).distinct()).where("u != v").distinct(), "edges")
        older.clear()
