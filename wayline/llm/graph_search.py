"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Vectors are hashed into shards of bounded size. In a shard, points enter a directed graph
in blocks: a greedy beam search from the point nearest the mean proposes neighbours,
relaxed pruning keeps a proposed edge only if no kept neighbour is nearer to its end by
the factor ``ALPHA``, and the reverse edges are added and pruned alike. Graphs are written
as one row per node. A query runs a beam search in every shard; distances of what it finds
are computed in double precision and the best of all shards merged.

Equal vectors are one node, which holds the smallest ids of its rows: as many as a result
can list, and one more for the query's own.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component
take no part, neither as query nor as candidate; vectors of different length are in
different shards and never compared; rows of a null id take no part; of rows repeated in
id and vector one counts; a query never finds its own id; with fewer candidates all are
returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayline.llm.text import narrow
from wayline.scratch import stored

SHARD = 8192
DEGREE = 32
BEAM = 64
ALPHA = 1.2
BLOCK = 512
QUERIES = 2048
NEIGHBOURS = 10

NODES = "shard bigint, node int, entry int, vector array<double>, ids array<bigint>, edges array<int>"


def usable(vector) -> F.Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


class Graph:
    """Out-edges of points held as arrays; -1 pads a row."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE) -> None:
        self.points = points
        self.edges = np.full((len(points), degree), -1, dtype=np.int32)
        self.entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of many queries side by side: node numbers and squared distances, nearest first."""
        n, count = len(self.points), len(queries)
        ids = np.full((count, beam), -1, dtype=np.int64)
        dist = np.full((count, beam), np.inf)
        done = np.ones((count, beam), dtype=bool)
        ids[:, 0], dist[:, 0], done[:, 0] = self.entry, ((queries - self.points[self.entry]) ** 2).sum(axis=1), False
        seen = np.zeros((count, n), dtype=bool)
        seen[:, self.entry] = True
        live = np.arange(count)
        while len(live):
            pick = np.where(done[live], np.inf, dist[live]).argmin(axis=1)
            done[live, pick] = True
            near = self.edges[ids[live, pick]]
            new = (near >= 0) & ~seen[live[:, None], near]
            row, col = np.nonzero(new)
            target = near[row, col]
            seen[live[row], target] = True
            step = np.full(near.shape, np.inf)
            delta = self.points[target] - queries[live[row]]
            step[row, col] = np.einsum("ij,ij->i", delta, delta)
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_dist = np.concatenate([dist[live], step], axis=1)
            all_done = np.concatenate([done[live], np.zeros(near.shape, dtype=bool)], axis=1)
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, axis=1)
            dist[live] = np.take_along_axis(all_dist, best, axis=1)
            done[live] = np.take_along_axis(all_done, best, axis=1) | ~np.isfinite(dist[live])
            live = live[~done[live].all(axis=1)]
        return ids, dist

    def prune(self, point: int, proposed: np.ndarray, alpha: float) -> None:
        """Keep edges to proposed nodes, nearest first, that no kept neighbour makes needless."""
        proposed = np.unique(proposed[(proposed >= 0) & (proposed != point)])
        if not len(proposed):
            return
        vectors = self.points[proposed]
        own = ((vectors - self.points[point]) ** 2).sum(axis=1)
        order = np.argsort(own, kind="stable")
        proposed, vectors, own = proposed[order], vectors[order], own[order]
        square = (vectors**2).sum(axis=1)
        between = square[:, None] + square[None, :] - 2 * vectors @ vectors.T
        alive, kept = np.ones(len(proposed), dtype=bool), []
        for i in range(len(proposed)):
            if alive[i]:
                kept.append(i)
                if len(kept) == self.edges.shape[1]:
                    break
                alive &= alpha * alpha * between[i] > own
        self.edges[point] = -1
        self.edges[point, : len(kept)] = proposed[kept]

    def insert(self, rows: np.ndarray, beam: int, alpha: float) -> None:
        """Find and prune the edges of a block of points, then those that lead back to them."""
        found, _ = self.search(self.points[rows], beam)
        back: dict[int, list[int]] = {}
        for point, near in zip(rows.tolist(), found):
            self.prune(point, np.concatenate([near, self.edges[point]]), alpha)
            for other in self.edges[point].tolist():
                if other >= 0:
                    back.setdefault(other, []).append(point)
        for other, points in back.items():
            held = self.edges[other]
            new = np.setdiff1d(points, held)
            free = np.flatnonzero(held < 0)
            if len(new) <= len(free):
                held[free[: len(new)]] = new
            else:
                self.prune(other, np.concatenate([held, new]), alpha)


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 3) -> Graph:
    """Two passes over the points in random order, the first without relaxation."""
    graph = Graph(points, degree)
    order = np.random.default_rng(seed).permutation(len(points))
    for factor in (1.0, alpha):
        start, size = 0, 1 if factor == 1.0 else BLOCK
        while start < len(order):
            graph.insert(order[start : start + size], beam, factor)
            # Early blocks are small, since their points cannot find each other.
            start, size = start + size, min(BLOCK, max(size, start + size))
    return graph


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("least", kind="stable")
    points = np.array(rows["vector"].tolist(), dtype=np.float64)
    graph = build(points)
    return pd.DataFrame({
        "shard": rows["shard"].to_numpy(), "node": np.arange(len(rows), dtype=np.int32),
        "entry": np.full(len(rows), graph.entry, dtype=np.int32), "vector": list(points), "ids": rows["ids"].tolist(),
        "edges": list(graph.edges),
    })


def vectors_of(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    rows = narrow(table, id_column, vector_column).select(
        F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))


def build_index(vectors: DataFrame, k: int = NEIGHBOURS, shard_size: int = SHARD) -> DataFrame:
    """Graphs of all shards, one row per node, written to the shared folder.

    Rows of equal vectors first keep their ``k + 1`` smallest ids, ranked in two steps, so
    that a vector many rows share is trimmed before its rows meet.
    """
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    few = Window.partitionBy("vector", "part").orderBy("vec_id")
    first = vectors.distinct().withColumn("part", spread).withColumn("rank", F.row_number().over(few)).where(F.col("rank") <= k + 1)
    last = Window.partitionBy("vector").orderBy("vec_id")
    short = first.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k + 1)
    nodes = short.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = stored(nodes.withColumn("least", F.col("ids")[0]).withColumn("dims", F.size("vector")), "vectors")
    counts = nodes.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / shard_size).alias("shards"))
    place = F.pmod(F.xxhash64(F.lit(17), "least"), F.col("shards")) + F.col("dims").cast("bigint") * (1 << 32)
    sharded = nodes.join(F.broadcast(counts), "dims").withColumn("shard", place)
    return stored(sharded.select("shard", "least", "vector", "ids").groupBy("shard").applyInPandas(_build_shard, NODES), "graph")


def _search_shard(k: int, beam: int) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, queries: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(queries) or not len(nodes):
            return empty
        nodes = nodes.sort_values("node")
        graph = Graph.__new__(Graph)
        graph.points = np.array(nodes["vector"].tolist(), dtype=np.float64)
        graph.edges = np.array(nodes["edges"].tolist(), dtype=np.int32)
        graph.entry = int(nodes["entry"].iloc[0])
        members = nodes["ids"].tolist()
        points = np.array(queries["vector"].tolist(), dtype=np.float64)
        found, _ = graph.search(points, min(beam, len(nodes)))
        out: list[tuple] = []
        for query, point, near in zip(queries["query_id"].tolist(), points, found):
            near = near[near >= 0]
            exact = np.sqrt(((graph.points[near] - point) ** 2).sum(axis=1))
            best: list[tuple[float, int]] = []
            for at in np.argsort(exact, kind="stable"):
                if len(best) >= k and exact[at] > best[k - 1][0]:
                    break
                best += [(float(exact[at]), int(i)) for i in members[near[at]] if i != query]
                best.sort()
            out += [(query, i, score) for score, i in best[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty

    return run


def search(queries: DataFrame, index: DataFrame, k: int = NEIGHBOURS, beam: int = BEAM) -> DataFrame:
    """The ``k`` nearest rows of each query (``query_id, vector``) over all shards.

    Queries go to each shard of their dimension in blocks; a shard and a block fit a task
    by their size parameters.
    """
    blocks = F.pmod(F.xxhash64("query_id"), F.lit(max(1, queries.count() // QUERIES)))
    shards = stored(index.select("shard").distinct(), "shards").withColumn("dims", F.expr("shard div 4294967296"))
    blocked = queries.withColumn("block", blocks).withColumn("dims", F.size("vector").cast("bigint"))
    per_shard = stored(blocked.join(shards, "dims").select("shard", "block", "query_id", "vector"), "shard_queries")
    wanted = per_shard.select(F.col("shard").alias("of"), F.col("block").alias("for_block")).distinct()
    copies = index.join(wanted, F.col("shard") == F.col("of")).withColumnRenamed("for_block", "block")
    found = per_shard.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block")).applyInPandas(
        _search_shard(k, beam), "query_id bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(table: DataFrame, every: int = 100, k: int = NEIGHBOURS) -> DataFrame:
    """Index all rows, then search for those whose id is divisible by ``every``."""
    vectors = vectors_of(table)
    queries = vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    return search(queries.dropDuplicates(["query_id", "vector"]), build_index(vectors, k), k)
