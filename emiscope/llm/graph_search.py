"""Nearest neighbours by inner product over robust-pruned directed graphs, one per shard.

Vectors of length ``|x|`` get one more component, ``sqrt(M^2 - |x|^2)`` with the largest length
``M``; the Euclidean neighbours of ``(q, 0)`` are then those of largest inner product.

A shard's graph grows by batches. A greedy beam search on the graph so far proposes candidates
for a new vector. Robust pruning keeps the nearest candidate and drops all others that are
closer to it, by a factor, than to the new vector, then goes on with the rest: the kept edges
point in different directions. Edges back are added and pruned likewise. Queries walk each
shard's graph with a beam; their nearest of all shards are merged.

Equal vectors are one node with their smallest ids, as many as an answer can hold: further
copies would stand behind those at the same score. Vectors that ``vectors.usable`` leaves out
neither ask nor answer; only vectors of equal length are compared. Of rows with a repeated id
each different vector counts. Fewer candidates than asked for give fewer rows. Labels and other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emiscope.llm import vectors as V
from emiscope.session import write_through

NEAREST = 20
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
RELAXED = 1.2
#: Nodes of a shard; the number of shards grows with the data.
SHARD = 8192
#: Queries that walk a graph together.
QUERIES = 256
QUERY_BLOCK = 2048
_EXPAND = 4


def _distances(points: np.ndarray, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own rows of ``points``."""
    found = points[rows]
    return np.einsum("qrd,qrd->qr", found, found) - 2 * np.einsum("qrd,qd->qr", found, queries) + (queries**2).sum(1)[:, None]


def beam_search(points: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes found and their squared distances, nearest first; -1 and infinity where there are fewer."""
    n, count = len(queries), len(points)
    ids = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf, np.float32)
    open_ = np.zeros((n, beam), bool)
    ids[:, 0], open_[:, 0] = start, True
    far[:, 0] = _distances(points, np.full((n, 1), start), queries)[:, 0]
    seen = np.zeros((n, count + 1), bool)  # the last column stands for "no node"
    seen[:, start] = seen[:, -1] = True
    active = np.arange(n)
    while len(active):
        waiting = np.where(open_[active], far[active], np.inf)
        pick = np.argpartition(waiting, min(_EXPAND, beam - 1), axis=1)[:, :_EXPAND]
        use = np.take_along_axis(waiting, pick, 1) < np.inf
        nodes = np.where(use, np.take_along_axis(ids[active], pick, 1), -1)
        rows = active[:, None]
        open_[rows, pick] = False
        next_ = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(active), -1)
        next_ = np.sort(next_, axis=1)
        next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = -1
        next_[seen[rows, next_]] = -1
        seen[rows, next_] = True
        known = next_ >= 0
        reach = np.where(known, _distances(points, next_, queries[active]), np.inf).astype(np.float32)
        all_far = np.concatenate([far[active], reach], axis=1)
        keep = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        far[active] = np.take_along_axis(all_far, keep, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], next_], axis=1), keep, 1)
        open_[active] = np.take_along_axis(np.concatenate([open_[active], known], axis=1), keep, 1)
        active = active[(open_[active] & (far[active] < np.inf)).any(axis=1)]
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """Up to ``degree`` neighbours of each of ``own`` out of its ``candidates`` (-1: none)."""
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    candidates[candidates == own[:, None]] = -1
    far = np.where(candidates >= 0, _distances(points, candidates, points[own]), np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = np.take_along_axis(candidates, order, 1), np.take_along_axis(far, order, 1)
    found = points[candidates]
    length = np.einsum("qcd,qcd->qc", found, found)
    between = length[:, :, None] + length[:, None, :] - 2 * found @ found.transpose(0, 2, 1)
    kept = np.full((len(own), degree), -1)
    left = far < np.inf
    row = np.arange(len(own))
    for k in range(degree):
        some = left.any(axis=1)
        if not some.any():
            break
        nearest = left.argmax(axis=1)  # candidates stand nearest first
        kept[some, k] = candidates[row, nearest][some]
        left &= relaxed * relaxed * between[row, nearest] > far
        left[row, nearest] = False
    return kept


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED) -> tuple[np.ndarray, int]:
    """Neighbours of every point, and the point that walks begin at."""
    n = len(points)
    graph = np.full((n + 1, degree), -1)  # the last row stands for "no node"
    start = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(n).permutation(n)
    order = order[order != start]
    at = 0
    while at < n - 1:
        new = order[at : at + max(1, min(QUERIES, at))]
        at += len(new)
        proposed, _ = beam_search(points, graph, start, points[new], beam)
        # Points of one batch propose one another's neighbours through the edges back.
        graph[new] = robust_prune(points, new, proposed, degree, relaxed)
        source = np.repeat(new, degree)
        target = graph[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, sizes = np.unique(target, return_index=True, return_counts=True)
        taken = (graph[nodes] >= 0).sum(axis=1)
        for k in np.flatnonzero(taken + sizes <= degree):
            graph[nodes[k], taken[k] : taken[k] + sizes[k]] = source[first[k] : first[k] + sizes[k]]
        full = np.flatnonzero(taken + sizes > degree)
        for group in np.array_split(full, -(-len(full) // 64)) if len(full) else []:
            width = int(sizes[group].max())
            more = first[group][:, None] + np.arange(width)
            given = np.where(np.arange(width) < sizes[group][:, None], source[np.minimum(more, len(source) - 1)], -1)
            own = nodes[group]
            graph[own] = robust_prune(points, own, np.concatenate([graph[own], given], axis=1), degree, relaxed)
    return graph, start


def _lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Points whose Euclidean order around a query is that of inner products."""
    rows = rows / longest
    rest = np.sqrt(np.maximum(1 - (rows**2).sum(1), 0))
    return np.concatenate([rows, rest[:, None]], axis=1).astype(np.float32)


def build_index(embeddings: DataFrame, nearest: int = NEAREST, shard: int = SHARD) -> DataFrame:
    """One row per shard: ids of its nodes' copies, vectors, neighbours and the start node."""
    kind = V.kind_of(embeddings)
    rows = V.usable(embeddings).select("vec_id", "vector", F.octet_length("vector").alias("size")).distinct()
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("k", F.row_number().over(first)).where(F.col("k") <= nearest + 1)
    nodes = few.groupBy("size", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = write_through(nodes, "graph_nodes")
    shards = nodes.groupBy("size").agg(F.count("*").alias("n"))

    def built(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rows = V.matrix(frame["vector"], kind)
        longest = float(np.sqrt((rows**2).sum(1)).max())
        graph, start = build_graph(_lifted(rows, longest))
        return pd.DataFrame(
            {
                "size": [key[0]],
                "shard": [key[1]],
                "ids": [[list(i) for i in frame["ids"]]],
                "vectors": [rows.astype(kind).tobytes()],
                "graph": [graph.astype(np.int32).tobytes()],
                "start": [start],
            }
        )

    spread = nodes.join(F.broadcast(shards) if shards.count() < 10_000 else shards, "size").select(
        "size", F.pmod(F.xxhash64("vector"), F.greatest(F.ceil(F.col("n") / shard), F.lit(1))).alias("shard"), "ids", "vector"
    )
    index = spread.groupBy("size", "shard").applyInPandas(
        built, "size long, shard long, ids array<array<long>>, vectors binary, graph binary, start int"
    )
    return write_through(index, "graph_index")


def search(embeddings: DataFrame, index: DataFrame, asks: Column, nearest: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of every row of ``embeddings`` that ``asks``."""
    kind = V.kind_of(embeddings)
    asking = V.usable(embeddings.where(asks)).select("vec_id", "vector", F.octet_length("vector").alias("size")).distinct()
    asking = write_through(asking, "queries")
    total = asking.count()
    asking = asking.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(-(-max(total, 1) // QUERY_BLOCK))))

    def gathered(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"size": [key[0]], "query_ids": [frame["vec_id"].tolist()], "queries": [b"".join(frame["vector"])]})

    blocks = asking.groupBy("size", "block").applyInPandas(gathered, "size long, query_ids array<long>, queries binary")

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                rows = np.frombuffer(row.vectors, kind).reshape(len(row.ids), -1).astype(np.float64)
                points = _lifted(rows, float(np.sqrt((rows**2).sum(1)).max()))
                graph = np.frombuffer(row.graph, np.int32).reshape(len(rows) + 1, -1)
                queries = np.frombuffer(row.queries, kind).reshape(len(row.query_ids), -1).astype(np.float64)
                for at in range(0, len(queries), QUERIES):
                    part = queries[at : at + QUERIES]
                    length = np.sqrt((part**2).sum(1, keepdims=True))
                    lifted = np.concatenate([part / length, np.zeros((len(part), 1))], axis=1).astype(np.float32)
                    found, _ = beam_search(points, graph, int(row.start), lifted, SEARCH_BEAM)
                    out = []
                    for query, vector, nodes in zip(row.query_ids[at : at + QUERIES], part, found):
                        nodes = nodes[nodes >= 0]
                        scores = (rows[nodes] * vector).sum(1)
                        each = [(-s, i) for s, n in zip(scores.tolist(), nodes) for i in row.ids[n] if i != query]
                        out += [(query, i, -s) for s, i in sorted(each)[:nearest]]
                    yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    # Every block of queries goes to every shard of its vector length.
    shards = index.groupBy("size").agg(F.collect_list("shard").alias("shards"))
    dealt = blocks.join(shards, "size").withColumn("shard", F.explode("shards")).drop("shards")
    met = dealt.join(index, ["size", "shard"]).mapInPandas(walk, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    met = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
