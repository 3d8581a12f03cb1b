"""Approximate nearest neighbours on robust-pruned directed graphs, one for each shard.

Shards hold a bounded number of vectors, dealt by a hash of the id. In a shard, greedy beam searches on
the growing graph propose neighbours of each vector; relaxed pruning drops a proposal that lies much closer to
a kept neighbour than to the vector itself, so that edges stay few and diverse. Each query then searches every shard
with a wider beam; blocks of queries meet shards, and the best of all shards are ranked by exact cosines.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bagminhash import kept

SHARD_ROWS = 4_096
ROUNDING = 1e-5
QUERY_ROWS = 1_024
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
EXPANDED = 4
RELAXED = 1.2
BUILD_BATCH = 256


def greedy(unit: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries in step: ids (-1: none) and cosines of the best ``beam`` vectors met, best first."""
    n, m = len(unit), len(queries)
    ids = np.full((m, beam), -1, dtype=np.int64)
    near = np.full((m, beam), -np.inf, dtype=np.float32)
    ids[:, 0], near[:, 0] = start, queries @ unit[start]
    opened = np.zeros((m, beam), dtype=bool)
    met = np.zeros((m, n), dtype=bool)
    met[:, start] = True
    rows = np.arange(m)
    while len(rows):
        waiting = ~opened[rows] & (ids[rows] >= 0)
        rows, waiting = rows[waiting.any(axis=1)], waiting[waiting.any(axis=1)]
        if not len(rows):
            break
        rank = np.cumsum(waiting, axis=1)
        take = waiting & (rank <= EXPANDED)
        opened[rows] |= take
        r, c = np.nonzero(take)
        to = edges[ids[rows[r], c]]
        flat = np.unique((rows[r][:, None] * n + to)[to >= 0])
        flat = flat[~met.reshape(-1)[flat]]
        met.reshape(-1)[flat] = True
        q, v = np.divmod(flat, n)
        close = np.einsum("ij,ij->i", queries[q], unit[v])
        first = np.searchsorted(q, rows)
        width = np.searchsorted(q, rows, side="right") - first
        most = int(width.max(initial=0))
        if not most:
            continue
        more_ids = np.full((len(rows), most), -1, dtype=np.int64)
        more_near = np.full((len(rows), most), -np.inf, dtype=np.float32)
        inside = np.arange(most) < width[:, None]
        more_ids[inside], more_near[inside] = v, close
        all_ids = np.concatenate([ids[rows], more_ids], axis=1)
        all_near = np.concatenate([near[rows], more_near], axis=1)
        all_opened = np.concatenate([opened[rows], ~inside], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[rows], near[rows] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_near, order, 1)
        opened[rows] = np.take_along_axis(all_opened, order, 1)
    return ids, near


def prune(unit: np.ndarray, points: np.ndarray, proposed: np.ndarray, relaxed: float) -> np.ndarray:
    """Up to DEGREE diverse neighbours of each point from its proposals (-1: none); distances are 1 - cosine."""
    proposed = np.where(proposed == points[:, None], -1, proposed)
    proposed = np.sort(proposed, axis=1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
    vectors = unit[proposed]
    far = 1 - np.einsum("ijk,ik->ij", vectors, unit[points])
    far[proposed < 0] = np.inf
    between = 1 - np.matmul(vectors, vectors.transpose(0, 2, 1))
    out = np.full((len(points), DEGREE), -1, dtype=np.int32)
    left, rows = far.copy(), np.arange(len(points))
    for i in range(DEGREE):
        best = left.argmin(axis=1)
        ok = np.isfinite(left[rows, best])
        if not ok.any():
            break
        out[ok, i] = proposed[ok, best[ok]]
        covered = relaxed**2 * between[rows, best] <= far
        covered[rows, best] = True
        left[covered & ok[:, None]] = np.inf
    return out


def build(unit: np.ndarray) -> tuple[np.ndarray, int]:
    """The edges of a shard's graph (-1: none) and the vector where searches start."""
    n = len(unit)
    random = np.random.default_rng(n)
    edges = np.full((n, DEGREE), -1, dtype=np.int32)
    if n > 1:
        some = random.integers(0, n - 1, size=(n, min(DEGREE, n - 1)))
        edges[:, :some.shape[1]] = some + (some >= np.arange(n)[:, None])
    start = int((unit @ unit.mean(axis=0)).argmax())
    for relaxed in (1.0, RELAXED):
        order = random.permutation(n)
        for low in range(0, n, BUILD_BATCH):
            points = order[low:low + BUILD_BATCH]
            ids, _ = greedy(unit, edges, start, unit[points], BUILD_BEAM)
            edges[points] = prune(unit, points, np.concatenate([ids, edges[points]], axis=1), relaxed)
            source = np.repeat(points, DEGREE)
            target = edges[points].reshape(-1)
            source, target = source[target >= 0], target[target >= 0]
            sort = np.argsort(target, kind="stable")
            source, target = source[sort], target[sort]
            changed, first, count = np.unique(target, return_index=True, return_counts=True)
            back = np.full((len(changed), int(count.max(initial=1))), -1, dtype=np.int64)
            back[np.arange(back.shape[1]) < count[:, None]] = source
            for part in range(0, len(changed), BUILD_BATCH):
                own = changed[part:part + BUILD_BATCH]
                edges[own] = prune(unit, own, np.concatenate([edges[own], back[part:part + BUILD_BATCH]], axis=1), relaxed)
    return edges, start


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, in double precision."""
    a, b = in_range(a), in_range(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def in_range(rows: np.ndarray) -> np.ndarray:
    """Rows of very large or small components times a power of two, which leaves their cosines as they are."""
    _, size = np.frexp(np.abs(rows).max(axis=1, initial=0.0))
    return np.ldexp(rows, -np.where(np.abs(size) > 400, size, 0)[:, None])


def directions(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in single precision."""
    rows = in_range(rows)
    return (rows / np.sqrt((rows * rows).sum(axis=1))[:, None]).astype(np.float32)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct row, and the number of each row's distinct row."""
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel()
    _, first, at = np.unique(whole, return_index=True, return_inverse=True)
    return first, at


def usable(embedding: Column) -> Column:
    """Not null, not empty, all components finite and at least one of them not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def make_shards(vectors: DataFrame, shards: int) -> DataFrame:
    """One row for each (dim, shard): directions with their edges, the distinct vectors of each, and the ids that hold each of them."""

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        matrix = np.stack([np.asarray(v, dtype=np.float64) for v in part["embedding"]])
        first, at = _distinct(matrix)
        unit = directions(matrix[first])
        nodes, node = _distinct(unit)
        edges, start = build(np.ascontiguousarray(unit[nodes]))
        # Distinct vectors by node, and ids by distinct vector in that order.
        order = np.argsort(node, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        sort = np.argsort(place[at], kind="stable")
        return pd.DataFrame([{
            "dim": part["dim"].iloc[0], "shard": part["shard"].iloc[0], "units": unit[nodes].tobytes(), "edges": edges.tobytes(), "start": start,
            "vectors": matrix[first][order].tobytes(), "nodes": np.cumsum(np.bincount(node)).tobytes(),
            "ids": part["vec_id"].to_numpy(dtype=np.int64)[sort].tobytes(), "ends": np.cumsum(np.bincount(place[at])).tobytes(),
        }])

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInPandas(one, "dim int, shard int, units binary, edges binary, start int, vectors binary, nodes binary, ids binary, ends binary")


def search_shards(index: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """The k nearest (query_id, vec_id, score) that each query finds in each shard."""

    def one(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(shard) and len(block):
            row, dim = shard.iloc[0], int(shard["dim"].iloc[0])
            vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, dim)
            edges = np.frombuffer(row["edges"], dtype=np.int32).reshape(-1, DEGREE)
            ids, ends, nodes = (np.frombuffer(row[n], dtype=np.int64) for n in ("ids", "ends", "nodes"))
            unit = np.frombuffer(row["units"], dtype=np.float32).reshape(-1, dim)
            exact = np.stack([np.asarray(v, dtype=np.float64) for v in block["embedding"]])
            asked = directions(exact)
            best, _ = greedy(unit, edges, int(row["start"]), asked, SEARCH_BEAM)
            for query, vector, single, beam in zip(block["vec_id"].tolist(), exact, asked, best, strict=True):
                beam = beam[beam >= 0]
                rough = unit[beam] @ single
                # Whatever lies within rounding of the (k + 1)-th is ranked exactly, with all vectors of its direction.
                near = beam[rough >= np.sort(rough)[::-1][min(k, len(rough) - 1)] - ROUNDING]
                near = np.concatenate([np.arange(nodes[v - 1] if v else 0, nodes[v]) for v in near.tolist()])
                score = cosines(np.broadcast_to(vector, (len(near), dim)), vectors[near])
                here = [(-s, i) for s, v in zip(score.tolist(), near.tolist(), strict=True)
                        for i in ids[ends[v - 1] if v else 0:ends[v]][:k + 1].tolist() if i != query]
                for s, i in sorted(here)[:k]:
                    found["query_id"].append(query)
                    found["vec_id"].append(i)
                    found["score"].append(-s)
        return pd.DataFrame(found).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    blocks = max(1, math.ceil(queries.count() / QUERY_ROWS))
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int"))
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["dim", "shard", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(one, "query_id long, vec_id long, score double")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The k nearest vectors that each query finds, by cosine; ties go to the smaller vec_id.

    Returns query_id, rank (from 1), vec_id and score (cosine of the original vectors in double precision). Vectors
    that are null, empty, zero or hold a null or non-finite component take no part, nor do rows without vec_id; rows that
    share a vec_id count as one, with the smallest of their vectors. A query meets vectors of its own length only
    and never itself; with fewer than k candidates all are returned. Other columns are not looked at.
    """
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = kept(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding")), "vectors")
    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))
    index = kept(make_shards(rows, shards), "graphs")
    found = search_shards(index, rows.where(is_query), shards, k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
