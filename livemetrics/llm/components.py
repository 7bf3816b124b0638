"""Connected components of an edge list, by alternating large-star and small-star rounds.

Every round is two partially aggregated minima joined back to the edges; no neighbour list
is ever gathered, so a hub with many links is only a repeated join key (AQE splits it).
Rounds are written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.llm.common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star round over edges (u, v), u > v."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    j = both.join(low, "u")
    out = j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    else:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Undirected edges (u, v) to (id, component): the smallest id reachable, for every id that
    has an edge to another one."""
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "edges")
    while True:
        new = written(_star(_star(e, small=False), small=True), "edges")
        # stable once every node points straight at a root and no root points on
        n = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        o = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        e = new
        if tuple(n) == tuple(o):
            break
    star = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("id"), "component").distinct())
