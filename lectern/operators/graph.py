"""Reachability over edges by frontier joins, and projections to typed nodes and edges."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``. Where it is unset, a local session gets a folder of its own; on a cluster that would be no shared one, and is refused."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """The rows in a reliable checkpoint: lineage ends here, and every later use sees the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def reachable(edges: DataFrame, seeds: DataFrame, undirected: bool = False) -> DataFrame:
    """(node, depth) of all nodes that seeds (node) reach over edges (src, dst); seeds have depth 0. Cycles are fine.

    Each round joins only the newest nodes and writes only what it found; the loop ends when there is nothing new.
    """
    edges = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL")
    edges = kept((edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if undirected else edges).distinct().repartition("src"))
    frontier = kept(seeds.select("node").where("node IS NOT NULL").distinct().withColumn("depth", F.lit(0)))
    seen, depth = frontier, 0
    while not frontier.isEmpty():
        depth += 1
        found = frontier.join(edges, frontier["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct()
        frontier = kept(found.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)))
        seen = seen.unionByName(frontier)
    return seen


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected edges (src, dst); a component is named by its least node. Names spread to neighbours, and to what those are named by, until none changes."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    both = kept(both)
    named = kept(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("src")).alias("component")))
    while True:
        of = named.select(F.col("node").alias("dst"), F.col("component").alias("_near"))
        near = both.join(of, "dst").groupBy(F.col("src").alias("node")).agg(F.min("_near").alias("_near"))
        jump = named.select(F.col("node").alias("component"), F.col("component").alias("_far"))
        moved = named.join(near, "node").join(jump, "component", "left").select("node", F.least("component", "_near", "_far").alias("component"), (F.least("component", "_near", "_far") < F.col("component")).alias("_moved"))
        named = kept(moved)
        if named.where("_moved").isEmpty():
            return named.drop("_moved")
        named = named.drop("_moved")


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (src, kind, dst) of which an end is no node (node_id)."""
    ends = edges.select("src", "kind", "dst", F.explode(F.array("src", "dst")).alias("node_id"))
    return ends.join(nodes.select("node_id"), "node_id", "left_anti").select("src", "kind", "dst", F.col("node_id").alias("missing"))
