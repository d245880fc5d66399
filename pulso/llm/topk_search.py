"""Exact top-k inner products by multi-resolution segment statistics.

A vector is summed up at several resolutions by the mean m and deviation s of 1, 2, 4, ...
equal segments of length l. For two vectors, sum l*((m-m')^2 + (s-s')^2) over the segments is a lower bound of their squared distance
(and grows towards it with the resolution), so (|q|^2 + |x|^2 - bound) / 2 is an upper bound
of their inner product. Every query walks from coarse to fine: candidates whose upper bound is below the
k-th best exact score known so far are dropped, the threshold is raised with the exact scores of the most promising
survivors, and what is left after the finest level is computed exactly.

Work is a grid of (chunk of vectors, block of queries) of bounded size, each cell one group; cells return at most k rows a query, and the
best k over all chunks are ranked at the end.

Defined results: vectors that are NULL or hold NULL or non-finite components take no part, nor do rows
without id; exact repeats of a row count once; if an id repeats with other vectors, its best score counts and a
query id is searched with each of its vectors; vectors of other lengths are no candidates; with fewer than k
candidates all are returned; an empty table gives an empty result. Only ``vec_id`` and ``embedding`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

CHUNK_ROWS = 8192
QUERY_ROWS = 2048
SCALE = 256


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * component) of every usable vector, exact repeats once."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
            .dropDuplicates(["vec_id", "v"]))


def segment_levels(x: np.ndarray) -> list[np.ndarray]:
    """Per level, a row of sqrt(l)*mean and sqrt(l)*deviation of each segment: products of such rows are the upper bounds."""
    dim, levels, parts = x.shape[1], [], 1
    squares = x * x
    while parts < dim:
        cuts = np.unique(np.linspace(0, dim, parts + 1).astype(int))
        size = np.diff(cuts)
        mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
        var = np.maximum(np.add.reduceat(squares, cuts[:-1], axis=1) / size - mean * mean, 0.0)
        levels.append(np.hstack([mean * np.sqrt(size), np.sqrt(var * size)]))
        parts *= 2
    return levels


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point only where that is exact."""
    small = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(len(q), 1) < 2.0 ** 52
    return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64) if small else x @ q


def _kth(ids: np.ndarray, scores: np.ndarray, k: int) -> float:
    """The k-th best score over different ids, -inf with fewer."""
    order = np.argsort(-scores, kind="stable")
    _, first = np.unique(ids[order], return_index=True)
    best = scores[order][np.sort(first)]
    return float(best[k - 1]) if len(best) >= k else -np.inf


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score): the k best of one block, ties to the smaller id."""
    xf, qf = x.astype(np.float64), queries.astype(np.float64)
    x_levels, q_levels = segment_levels(xf), segment_levels(qf)
    norms = np.sqrt((xf * xf).sum(axis=1))
    out = []
    for i, own in enumerate(query_ids):
        alive = np.flatnonzero(ids != own)
        slack = 1e-9 * (np.sqrt((qf[i] * qf[i]).sum()) * norms.max(initial=0.0) + 1.0)
        threshold = -np.inf
        for xl, ql in zip(x_levels, q_levels):
            bound = xl[alive] @ ql[i]
            keep = bound >= threshold - slack
            alive, bound = alive[keep], bound[keep]
            if len(alive) > 4 * k:
                hopeful = alive[np.argpartition(-bound, 2 * k)[:2 * k]]
                threshold = max(threshold, _kth(ids[hopeful], _exact(x[hopeful], queries[i]), k))
        scores = _exact(x[alive], queries[i])
        order = np.lexsort((ids[alive], -scores))
        seen: set[int] = set()
        for j in order.tolist():
            if len(seen) == k:
                break
            name = int(ids[alive[j]])
            if name not in seen:
                seen.add(name)
                out.append((int(own), name, int(scores[j])))
    return out


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = col.combine_chunks().flatten()
    return np.asarray(flat, np.int64).reshape(len(col), dim)


def topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every row for which ``is_query`` holds."""
    rows = materialize(quantised(vectors, scale).withColumn("dim", F.size("v")), "topk-vectors")
    n, nq = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    chunks, blocks = max(1, -(-n // CHUNK_ROWS)), max(1, -(-nq // QUERY_ROWS))
    spread = lambda salt, m: F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    data = rows.withColumn("chunk", spread("chunk", chunks)).withColumn("block", every(blocks))
    queries = rows.filter(is_query).withColumn("block", spread("block", blocks)).withColumn("chunk", every(chunks))

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            dim = key[2].as_py()
            found = search_block(left["vec_id"].to_numpy(), _matrix(left["v"], dim), right["vec_id"].to_numpy(), _matrix(right["v"], dim), k)
        cols = np.array(found, np.int64).reshape(-1, 3)
        return pa.table({c: cols[:, j] for j, c in enumerate(("query_id", "vec_id", "score"))})

    keys, cols = ("chunk", "block", "dim"), ("chunk", "block", "dim", "vec_id", "v")
    near = (data.select(*cols).groupBy(*keys).cogroup(queries.select(*cols).groupBy(*keys))
            .applyInArrow(cell, "query_id long, vec_id long, score long"))
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
