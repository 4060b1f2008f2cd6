"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lectern.llm.common import checkpoint, narrow

#: Edges that a task writes, and least number of tasks; fewer tasks write fewer shuffle files where edges are few.
TASK_EDGES, LEAST_TASKS = 50_000, 8


def _stars(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One large-star or small-star step over edges (u, v), written by at most so many tasks; both steps keep the components."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").coalesce(tasks).distinct().coalesce(tasks)


def _state(edges: DataFrame) -> Row:
    """The number of edges and a hash of their set."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """(node, component) for every node of undirected edges (u, v); a component is named by its least node.

    Self-loops and repeated edges don't matter; edges with a null end are left out. The number of rounds grows with the
    logarithm of the longest path. No component is ever gathered in one task: a node's neighbours are only aggregated to
    their minimum, and the join back can be split by Spark where a node has very many. ``tasks`` bounds the tasks of
    the first and last step, where the caller knows that there are few edges.
    """
    edges = narrow(edges, tasks).select("u", "v").where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    edges = narrow(checkpoint(narrow(edges, tasks)), tasks)
    state, now = None, _state(edges)
    while now != state:
        tasks = max(LEAST_TASKS, -(-now[0] // TASK_EDGES))
        edges = checkpoint(_stars(_stars(edges.coalesce(tasks), True, tasks), False, tasks))
        state, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(narrow(roots, tasks))
