"""Approximate nearest neighbours on robust-pruned directed graphs, one for each shard.

Equal vectors are one node. Nodes are dealt to shards of bounded size by a hash; each shard's
graph is grown point by point: a greedy search proposes neighbours, pruning with a relaxed
distance keeps diverse edges, and reverse edges are pruned the same way. Queries visit every
shard with a beam search, in blocks; a shard's index is stored, so it is built once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Nodes of a shard, queries of a block (means of hash-dealt groups).
SHARD_ROWS, QUERY_ROWS = 10_000, 4_096
DEGREE, BUILD_BEAM, RELAX = 28, 32, 1.2
#: A list may outgrow DEGREE by this factor before it is pruned.
SLACK = 1.3
BEAM = 160


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = x - q
    return np.einsum("ij,ij->i", d, d)


def beam_search(x: np.ndarray, graph: list[np.ndarray], start: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes met by a best-first search that keeps ``beam`` nearest, with squared distances, nearest first."""
    seen = np.zeros(len(x), bool)
    seen[start] = True
    d = float(_distances(x[start : start + 1], q)[0])
    todo, best = [(d, start)], [(-d, start)]
    found, dist = [np.array([start])], [np.array([d], x.dtype)]
    while todo:
        d, node = heapq.heappop(todo)
        if len(best) >= beam and d > -best[0][0]:
            break
        near = graph[node]
        near = near[~seen[near]]
        if not len(near):
            continue
        seen[near] = True
        ds = _distances(x[near], q)
        found.append(near)
        dist.append(ds)
        if len(best) >= beam:
            close = ds < -best[0][0]
            near, ds = near[close], ds[close]
        for a, b in zip(ds.tolist(), near.tolist()):
            heapq.heappush(todo, (a, b))
            heapq.heappush(best, (-a, b))
            if len(best) > beam:
                heapq.heappop(best)
    nodes, dist = np.concatenate(found), np.concatenate(dist)
    order = np.argsort(dist, kind="stable")
    return nodes[order], dist[order]


def robust_prune(x: np.ndarray, nodes: np.ndarray, dist: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Of candidates ordered by distance, those not much nearer to a kept one than to the point."""
    v = x[nodes]
    size = np.einsum("ij,ij->i", v, v)
    shadows = relax * relax * (size[:, None] + size - 2 * (v @ v.T)) <= dist  # of each node, those it stands before
    kept, alive = [], np.ones(len(nodes), bool)
    for i in range(len(nodes)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            alive &= ~shadows[i]
    return nodes[kept]


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> tuple[int, list[np.ndarray]]:
    """Entry point (the point nearest the mean) and each point's out-neighbours."""
    n = len(x)
    start = int(np.argmin(_distances(x, x.mean(axis=0))))
    graph: list[np.ndarray] = [np.zeros(0, np.int64)] * n
    limit = int(degree * SLACK)

    def pruned(p: int, others: np.ndarray) -> np.ndarray:
        d = _distances(x[others], x[p])
        order = np.argsort(d, kind="stable")
        return robust_prune(x, others[order], d[order], degree, relax)

    for p in np.random.default_rng(n).permutation(n):
        if p == start:
            continue
        nodes, dist = beam_search(x, graph, start, x[p], beam)
        close = nodes[: 2 * beam]
        graph[p] = robust_prune(x, close, dist[: 2 * beam], degree, relax)
        for v in graph[p]:
            grown = np.append(graph[v], p)
            graph[v] = pruned(v, grown) if len(grown) > limit else grown
    return start, graph


def _valid(vector: str):
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, k: int = 10, query_every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose id ``query_every`` divides.

    A row is no neighbour of its own query; equal vectors are neighbours at distance zero,
    ties going to the smaller id. Vectors that are null, zero or hold a null or non-finite
    component take no part; a query meets vectors of its own length only. Rows that repeat an
    id count as one, with the smallest of their vectors.
    """
    spark = vectors.sparkSession
    rows = (
        vectors.where(F.col(id_col).isNotNull() & _valid(vector_col))
        .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("vec"))
        .groupBy("vec_id")
        .agg(F.min("vec").alias("vec"))
    )
    # the first k + 1 rows of each vector: enough when one of them is the query itself
    order = Window.partitionBy("vec").orderBy("vec_id")
    firsts = rows.select("vec_id", "vec", F.first("vec_id").over(order).alias("node"), F.row_number().over(order).alias("n")).where(F.col("n") <= k + 1)
    firsts = common.stored(firsts, "firsts")
    members = firsts.select("node", "vec_id")
    nodes = firsts.where("n = 1").select("node", "vec")
    queries = rows.where(F.col("vec_id") % query_every == 0).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query"))

    counts = nodes.agg(F.count("*").alias("n")).first()["n"]
    shards = max(1, -(-counts // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(frames)
        for _, pdf in pd.concat(rows).sort_values("node").groupby("dim") if rows else ():
            start, graph = build_graph(np.stack(pdf["vec"].to_numpy()).astype(np.float32))
            pdf = pdf.assign(place=np.arange(len(pdf)), start=start)
            yield pdf.assign(edges=[g.tolist() for g in graph])[["shard", "dim", "place", "start", "node", "vec", "edges"]]

    dealt = nodes.select("node", "vec", F.pmod(F.xxhash64("node"), F.lit(shards)).alias("shard"), F.size("vec").alias("dim"))
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int"))  # a task for each shard
    index = dealt.mapInPandas(build, "shard long, dim int, place long, start long, node long, vec array<double>, edges array<long>")
    index = common.stored(index, "index")

    def search(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(asked):
            shard = shard.sort_values("place")
            exact = np.stack(shard["vec"].to_numpy())
            x, ids = exact.astype(np.float32), shard["node"].to_numpy()
            graph, start = [np.asarray(e, np.int64) for e in shard["edges"]], int(shard["start"].iloc[0])
            for query_id, q in zip(asked["query_id"], asked["query"]):
                q = np.asarray(q)
                found = beam_search(x, graph, start, q.astype(np.float32), beam)[0][: 2 * k + 2]
                d = exact[found] - q
                score = np.sqrt((d * d).sum(axis=1))
                best = np.lexsort((ids[found], score))[: k + 1]
                out += [(query_id, ids[found[b]], score[b]) for b in best]
        return pd.DataFrame(out, columns=["query_id", "node", "score"])

    every_block = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = (
        queries.withColumn("dim", F.size("query"))
        .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    )
    keys = ["shard", "dim", "block"]
    found = every_block.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, node long, score double")
    best_nodes = Window.partitionBy("query_id").orderBy("score", "node")
    found = found.withColumn("r", F.row_number().over(best_nodes)).where(F.col("r") <= k + 1).drop("r")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.join(members, "node")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
