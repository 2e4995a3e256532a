"""Connected components by alternating large-star and small-star steps.

Both steps are an aggregation (the smallest neighbour, combined map-side) and a join back,
over edges that are written to the shared folder after each round; the join deals a vertex
with very many neighbours to several tasks. A few numbers a round come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.common import discard, materialize, salted_join


def _with_least(e: DataFrame, total: int, hot: int) -> DataFrame:
    """(u, v, m): each edge with the smallest neighbour of its u."""
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return salted_join(e, least, "u", "n", total, hot).select("u", "v", "m")


def _large_star(e: DataFrame, total: int, hot: int) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_least(both, 2 * total, hot).select("u", "v", F.least("u", "m").alias("m"))
    return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame, total: int, hot: int) -> DataFrame:
    joined = _with_least(e, total, hot)
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(joined.where("v = m").select("u", "v")).distinct()


def _at_rest(e: DataFrame) -> bool:
    """Whether all edges form stars: no vertex has two roots, and no root has one."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("root"))
    ends = ends.unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    seen = ends.groupBy("x").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    return seen.where("child > 1 OR (child = 1 AND root = 1)").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, hot: int = 50_000) -> DataFrame:
    """(id, component) of each vertex of the edges, component: the smallest id it reaches.

    A vertex that is alone, or only linked with itself, gives no row. Nulls give none, and no
    edges no rows. Edges of earlier components may be given as (id, component) pairs, which
    are stars already. ``hot``: the neighbours from which on a vertex is dealt to several tasks.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("x"), F.col(b).alias("y"))
    e = materialize(e.where("x <> y").select("u", "v").distinct(), "edges")
    for _ in range(max_rounds):
        if _at_rest(e):
            break
        total = e.count()  # never grows from round to round
        last, e = e, materialize(_small_star(_large_star(e, total, hot), total, hot), "edges")
        discard(last)
    else:
        raise RuntimeError(f"components did not rest after {max_rounds} rounds")
    # at rest every vertex points at the root of its star
    out = e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
    out.scratch_path = e.scratch_path  # discarding it discards its edges
    return out
