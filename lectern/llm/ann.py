"""Approximate nearest neighbours by cosine: NN-descent builds a neighbour graph, greedy search walks it.

Equal vectors become one node, which keeps its smallest ids, so a vector that a third of all rows share is one node too.
The graph starts from blocks of nodes with like random-projection codes. Each round of NN-descent gathers a node's neighbours and
reverse neighbours with their vectors, compares them with each other ("neighbours of neighbours"), and sends each pair that
beats what either side has to a merge that keeps the best. Vectors travel as one byte a component; only
scores that are returned are computed from the original vectors, in double precision.

Queries keep a beam of nodes; each round expands the best unexpanded ones along the graph's edges, by joins, until every node of each beam has been expanded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import checkpoint, read_table, tidy

#: Neighbours of a node in the graph, rounds of NN-descent, and projection orders that the first graph comes from.
NEIGHBOURS, ROUNDS, ORDERS = 32, 4, 3
#: Share of replaced edges at which rounds end.
SETTLED = 0.01
#: Nodes of a block that are compared with each other for the first graph.
BLOCK = 512
#: Nodes that a query keeps, and that it expands in a round.
BEAM, EXPAND = 160, 56
#: Nodes that queries which aren't indexed start from; a bounded sample that is broadcast.
SEEDS = 256


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null nor empty, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nodes_of(df: DataFrame, id_col: str, vector_col: str, members: int) -> DataFrame:
    """Distinct usable vectors: ``node`` (the smallest id), ``vector``, and ``members``, the smallest ids that have it.

    Of rows with the same id, the least vector counts; null ids take no part.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    first = Window.partitionBy("vector").orderBy("id")
    ranked = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= members)
    return ranked.groupBy("vector").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("members"))


def _quantised(vectors: np.ndarray) -> np.ndarray:
    v = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(v).max(axis=1, keepdims=True)
    return np.concatenate([np.rint(v / scale * 127).astype(np.int8), np.frombuffer((scale / 127).astype("<f4").tobytes(), np.int8).reshape(-1, 4)], axis=1)


def _unpacked(packed: pa.Array) -> np.ndarray:
    """Float vectors from packed bytes."""
    rows = np.frombuffer(b"".join(packed.to_pylist()), np.int8).reshape(len(packed), -1)
    return rows[:, :-4].astype(np.float32) * np.frombuffer(np.ascontiguousarray(rows[:, -4:]).tobytes(), "<f4")[:, None]


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    return np.asarray(column.flatten(), dtype).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def with_codes(nodes: DataFrame, orders: int = ORDERS, seed: int = 7) -> DataFrame:
    """The nodes, each with its packed vector and one code of 24 random-projection signs for each order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("vector"))
            planes = np.random.default_rng(seed).standard_normal((v.shape[1], 24 * orders))
            bits = (v @ planes > 0).reshape(len(v), orders, 24)
            # In Gray order, codes that differ in one bit can stand side by side.
            ordered = np.bitwise_xor.accumulate(bits, axis=2)
            codes = ordered @ (1 << np.arange(23, -1, -1))
            packed = pa.array([r.tobytes() for r in _quantised(v)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed, pa.array(list(codes.astype(np.int64)), pa.list_(pa.int64()))], names=[*batch.schema.names, "packed", "codes"])

    rows = nodes.select("node", "vector", "members")
    of = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"node long, vector {of}, members array<long>, packed binary, codes array<long>")


def _top_edges(u: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct edges, the best k of each u."""
    order = np.lexsort((-s, v, u))
    u, v, s = u[order], v[order], s[order]
    new = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))[: len(u)]
    u, v, s = u[new], v[new], s[new]
    order = np.lexsort((v, -s, u))
    u, v, s = u[order], v[order], s[order]
    starts = np.flatnonzero(np.append(True, u[1:] != u[:-1])[: len(u)])
    place = np.arange(len(u)) - np.repeat(starts, np.diff(np.append(starts, len(u))))
    best = place < k
    return u[best], v[best], s[best]


_EDGES = "u long, v long, s double"


def _edge_batch(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], names=["u", "v", "s"])


def block_edges(coded: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """Each node's best k within its blocks: in each order, nodes that follow each other by code form blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders = np.asarray(batch.column("order"))
            bounds = [0, *(np.flatnonzero(orders[1:] != orders[:-1]) + 1), len(orders)]
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                for at in range(begin, end, block):
                    part = batch.slice(at, min(block, end - at))
                    ids, v = np.asarray(part.column("node")), _unpacked(part.column("packed"))
                    s = v @ v.T
                    np.fill_diagonal(s, -2)
                    m = min(k, len(ids) - 1)
                    if m < 1:
                        continue
                    near = np.argpartition(-s, m - 1, axis=1)[:, :m]
                    yield _edge_batch(np.repeat(ids, m), ids[near].ravel(), np.take_along_axis(s, near, 1).ravel().astype(float))

    dealt = coded.select("node", "packed", F.posexplode("codes").alias("order", "code")).repartitionByRange("order", "code", "node")
    return dealt.sortWithinPartitions("order", "code", "node").select("order", "node", "packed").mapInArrow(tidy(run), _EDGES)


def best_edges(edges: DataFrame, k: int) -> DataFrame:
    """Distinct edges (u, v, s, old), the best k of each u, ties to the smaller v; ``old`` if any of the equal edges was."""
    best = Window.partitionBy("u").orderBy(F.col("s").desc(), "v")
    # Dealt by u once, which serves the grouping by (u, v) and the window.
    distinct = edges.repartition("u").groupBy("u", "v").agg(F.max("s").alias("s"), F.max("old").alias("old"))
    return distinct.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")


def both_ways(edges: DataFrame, k: int) -> DataFrame:
    """Each edge as (u, v), and turned round as (v, u) if it is among the best k that lead to v."""
    into = Window.partitionBy("v").orderBy(F.col("s").desc(), "u")
    placed = edges.select("u", "v", F.row_number().over(into).alias("place"))
    way = lambda a, b: F.struct(F.col(a).alias("u"), F.col(b).alias("v"))
    return placed.select(F.explode(F.when(F.col("place") <= k, F.array(way("u", "v"), way("v", "u"))).otherwise(F.array(way("u", "v")))).alias("e")).select("e.*")


def descend(edges: DataFrame, coded: DataFrame, k: int) -> DataFrame:
    """One round of NN-descent. Of a node's reverse neighbours the k best take part, as in the published algorithm's sampling, so a node's gathering is bounded by 2k."""
    worst = edges.groupBy(F.col("u").alias("v")).agg(F.when(F.count(F.lit(1)) >= k, F.min("s")).otherwise(F.lit(-2.0)).alias("kth"))
    known = coded.select(F.col("node").alias("v"), "packed").join(worst, "v")
    # A neighbour both ways counts once; dealt by v for this and for the join.
    around = both_ways(edges, k).repartition("v").dropDuplicates(["u", "v"])
    gathered = around.join(known, "v").groupBy("u").agg(F.collect_list(F.struct("v", "kth", "packed")).alias("near")).select("near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column("near")
            flat = near.flatten()
            if not len(flat):
                continue
            ids, kth, vectors = np.asarray(flat.field("v")), np.asarray(flat.field("kth")), _unpacked(flat.field("packed"))
            edges_of = np.asarray(near.offsets) - near.offsets[0].as_py()
            us, vs, ss = [], [], []
            for a, b in zip(edges_of[:-1], edges_of[1:], strict=True):
                s = vectors[a:b] @ vectors[a:b].T
                np.fill_diagonal(s, -3)
                i, j = np.nonzero(s > kth[a:b, None])
                us.append(ids[a + i])
                vs.append(ids[a + j])
                ss.append(s[i, j])
            yield _edge_batch(*_top_edges(np.concatenate(us), np.concatenate(vs), np.concatenate(ss).astype(float), k))

    found = gathered.mapInArrow(tidy(run), _EDGES).withColumn("old", F.lit(False))
    return best_edges(edges.withColumn("old", F.lit(True)).unionByName(found), k)


def build_graph(coded: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """Edges (u, v, s, old) from each node of ``with_codes`` to about its k nearest. No nodes, no edges.

    Rounds end, as in the published algorithm, when a round replaces no more than the share ``settled`` of the edges.
    """
    edges = checkpoint(best_edges(block_edges(coded, k).withColumn("old", F.lit(False)), k))
    for _ in range(rounds):
        edges = checkpoint(descend(edges, coded, k))
        total, new = edges.agg(F.count(F.lit(1)), F.count_if(~F.col("old"))).first()
        if new <= settled * total:
            break
    return edges


def seed_nodes(nodes: DataFrame, seeds: int = SEEDS) -> tuple[np.ndarray, np.ndarray]:
    """A bounded sample of nodes, those with the least hash, and their vectors."""
    got = nodes.select("node", "vector").orderBy(F.xxhash64("node"), "node").limit(seeds).collect()
    return np.array([r["node"] for r in got], np.int64), np.array([r["vector"] for r in got], np.float64).reshape(len(got), len(got[0]["vector"]) if got else 0)


def _cosines(rows: DataFrame, left: str, right: str, vectors: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """query_id, node and ``score``, the cosine of two columns that ``vectors`` turns into matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = vectors(batch.column(left)), vectors(batch.column(right))
            s = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("node"), pa.array(s.astype(float))], names=["query_id", "node", "score"])

    return rows.select("query_id", "node", left, right).mapInArrow(tidy(run), "query_id long, node long, score double")


def search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """Greedy search for each query (query_id, q): the beam's nodes with their scores, from the original vectors in double precision.

    A query starts from the sampled seeds that are nearest to it; if its id is given in ``home`` as an indexed node, from that node too.
    A query's packed vector travels to the nodes that it is compared with, not theirs to it. Beams only get better and hold each node
    once, so the rounds come to an end.
    """
    seed_ids, seed_vectors = seed_nodes(nodes)
    shared = queries.sparkSession.sparkContext.broadcast((seed_ids, seed_vectors))

    def nearest_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shared.value
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            q = _matrix(batch.column("q"))
            s = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).T
            m = min(4, len(ids))
            near = np.argpartition(-s, m - 1, axis=1)[:, :m]
            packed = pa.array([r.tobytes() for r in _quantised(q)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("home"), packed, pa.array(list(ids[near]), pa.list_(pa.int64()))], names=["query_id", "home", "packed_q", "seeds"])

    asked = checkpoint(queries.select("query_id", "q", "home").mapInArrow(tidy(nearest_seeds), "query_id long, home long, packed_q binary, seeds array<long>"))
    start = asked.select("query_id", "packed_q", F.explode(F.array_distinct(F.array_compact(F.array_append("seeds", F.col("home"))))).alias("node"))
    packed = nodes.select("node", "packed")
    links = checkpoint(both_ways(edges, 2 * NEIGHBOURS).groupBy(F.col("u").alias("node")).agg(F.collect_set("v").alias("links")))
    best, undone = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "node"), Window.partitionBy("query_id", "done").orderBy(F.col("score").desc(), "node")

    def merged(pairs: DataFrame, old: DataFrame | None) -> DataFrame:
        """The best of the old beam and of the pairs (query_id, packed_q, node); those to expand next have packed_q."""
        # Dealt by one key each, which serves the grouping by both, the join and the windows.
        fresh = pairs.repartition("node").dropDuplicates(["query_id", "node"]).join(packed, "node")
        rows = _cosines(fresh, "packed_q", "packed", _unpacked).withColumn("done", F.lit(False))
        if old is not None:
            rows = rows.unionByName(old.select("query_id", "node", "score", (F.col("done") | F.col("packed_q").isNotNull()).alias("done")))
        rows = rows.repartition("query_id").groupBy("query_id", "node").agg(F.max("score").alias("score"), F.max("done").alias("done"))
        rows = rows.withColumn("place", F.row_number().over(best)).where(F.col("place") <= beam).withColumn("turn", F.row_number().over(undone))
        next_ones = ~F.col("done") & (F.col("turn") <= expand)
        return checkpoint(rows.join(asked.select("query_id", "packed_q"), "query_id").select("query_id", "node", "score", "done", F.when(next_ones, F.col("packed_q")).alias("packed_q")))

    state = merged(start, None)
    while not state.where("packed_q IS NOT NULL").isEmpty():
        reached = state.where("packed_q IS NOT NULL").select("query_id", "packed_q", "node").join(links, "node").select("query_id", "packed_q", F.explode("links").alias("node"))
        state = merged(reached, state)
    pairs = state.select("query_id", "node").join(nodes.select("node", "vector"), "node").join(queries.select("query_id", "q"), "query_id")
    return _cosines(pairs, "q", "vector", _matrix)


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 5) -> DataFrame:
    """The ``top`` nearest other rows found for each row that is a query: query_id, rank, id and score.

    Largest cosine first, ties to the smaller id. Vectors that aren't ``usable`` take no part, on either side, nor do those of another length than most
    usable ones have (the longer on a tie). Equal query vectors are searched for once. With fewer other rows than ``top``, all of them come. An empty
    table gives no rows; further columns are ignored.
    """
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), is_query.alias("is_query")).where(usable(F.col("vector")))
    usual = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    rows = rows.where(F.size("vector") == (usual["length"] if usual else 0))
    nodes = checkpoint(with_codes(nodes_of(rows, "vec_id", "vector", top + 1)))
    edges = build_graph(nodes)
    asked = checkpoint(rows.where("is_query AND vec_id IS NOT NULL").groupBy(F.col("vec_id").cast("long").alias("asked_id")).agg(F.min("vector").alias("q")))
    distinct = checkpoint(asked.groupBy("q").agg(F.min("asked_id").alias("query_id")))
    queries = checkpoint(distinct.join(nodes.select(F.col("vector").alias("q"), F.col("node").alias("home")), "q", "left"))
    found = search(queries, nodes, edges)
    # One more than wanted, as the asking row is among them.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    expanded = found.join(nodes.select("node", "members"), "node").select("query_id", "score", F.explode("members").alias("vec_id"))
    best = expanded.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1).drop("place")
    of_asked = best.join(asked.join(distinct, "q").select("query_id", "asked_id"), "query_id").where("vec_id <> asked_id")
    ranked = of_asked.withColumn("rank", F.row_number().over(Window.partitionBy("asked_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= top).select(F.col("asked_id").alias("query_id"), "rank", F.col("vec_id").alias(id_col), "score")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
