"""Approximate nearest neighbours by cosine: stable projections, kd-tree, chi-square stopping.

Unit vectors are projected to ``PLANES`` dimensions by a Gaussian matrix. For a
pair at distance d, (projected distance / d)**2 then follows a chi-square law with
``PLANES`` degrees of freedom. Each shard holds a kd-tree of its projections. A query
visits leaves in order of their projected distance and verifies their points on
the original vectors until the next leaf is so far that a point nearer than the
k-th best found would lie there with probability below 1 - ``SURE``:
    leaf distance**2 > quantile(SURE) * (k-th best distance)**2
Every row is indexed; nothing is fitted, the matrix comes from a fixed seed.

``PLANES`` and ``SURE`` are set by measured recall and share of points verified: on directions
without any structure (64 independent components, the hardest case) 12 planes at 0.98 verify
three quarters of all points for a recall of 0.985, 32 planes at 0.93 a third for 0.93.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeframe.llm.vectors import searched

PLANES, SURE, LEAF, SEED = 32, 0.93, 48, 20
_TINY = 1e-9


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile for an even number of degrees of freedom, by bisection of the closed form."""
    def below(x):
        term = total = 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def planes(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, PLANES))


def unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt((matrix * matrix).sum(1))[:, None]


class Tree:
    """kd-tree of a shard: points in leaf order, with each leaf's box of projections."""

    def __init__(self, data: bytes, size: int):
        n, leaves = np.frombuffer(data, np.int64, 2)
        parts, at = [], 16
        for kind, shape in ((np.int64, (n,)), (np.float64, (n, size)), (np.float64, (n, PLANES)), (np.int64, (leaves + 1,)), (np.float64, (leaves, PLANES)), (np.float64, (leaves, PLANES))):
            count = int(np.prod(shape))
            parts.append(np.frombuffer(data, kind, count, at).reshape(shape))
            at += 8 * count
        self.ids, self.vectors, self.points, self.edges, self.low, self.high = parts
        self.norms = np.sqrt((self.vectors * self.vectors).sum(1))

    @staticmethod
    def build(ids: np.ndarray, matrix: np.ndarray) -> bytes:
        good = (matrix != 0).any(1)
        ids, matrix = ids[good], matrix[good]
        points = unit(matrix) @ planes(matrix.shape[1])
        order, edges = [], [0]

        def split(rows):
            spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(1)
            if len(rows) <= LEAF or not spread.max() > 0:  # equal points stay together
                if len(rows):
                    order.append(rows)
                    edges.append(edges[-1] + len(rows))
                return
            axis = int(spread.argmax())
            by = rows[np.argsort(points[rows, axis], kind="stable")]
            split(by[: len(by) // 2])
            split(by[len(by) // 2:])

        split(np.arange(len(ids)))
        order = np.concatenate(order) if order else np.zeros(0, np.int64)
        points = points[order]
        low = np.array([points[a:b].min(0) for a, b in zip(edges, edges[1:], strict=False)]).reshape(-1, PLANES)
        high = np.array([points[a:b].max(0) for a, b in zip(edges, edges[1:], strict=False)]).reshape(-1, PLANES)
        parts = (np.array([len(ids), len(edges) - 1]), ids[order], matrix[order], points, np.array(edges), low, high)
        return b"".join(np.ascontiguousarray(x).tobytes() for x in parts)

    def cosine(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Row by row, so equal vectors get equal values."""
        return (self.vectors[rows] * query).sum(1) / (self.norms[rows] * np.sqrt((query * query).sum()))

    def nearest(self, query_id: int, query: np.ndarray, projected: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of the k nearest found, and how many points were verified."""
        gap = np.maximum(self.low - projected, 0) + np.maximum(projected - self.high, 0)
        far = (gap * gap).sum(1)
        order = np.argsort(far, kind="stable")
        rows, score = np.zeros(0, np.int64), np.zeros(0)
        reach, at, step, verified = np.inf, 0, 1, 0
        while at < len(order) and far[order[at]] <= reach:
            leaves = order[at: at + step]
            leaves = leaves[far[leaves] <= reach]
            at, step = at + step, step * 2
            new = np.concatenate([np.arange(self.edges[x], self.edges[x + 1]) for x in leaves])
            new = new[self.ids[new] != query_id]
            if reach < np.inf:
                d = self.points[new] - projected
                new = new[(d * d).sum(1) <= reach]
            verified += len(new)
            if len(new):
                rows, score = np.concatenate((rows, new)), np.concatenate((score, self.cosine(new, query)))
                best = np.lexsort((self.ids[rows], -score))[:k]
                rows, score = rows[best], score[best]
            if len(rows) == k:
                reach = limit * max(0.0, 2 - 2 * score[-1]) + _TINY
        return rows, score, verified


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score (cosine, double): the k nearest found per query, ties to the smaller vec_id.

    ``vectors``: vec_id, embedding (other columns are ignored). Queries are rows with ``is_query``, candidates all
    rows of as many components but the query's own. Rows without id or vector, with NULL or non-finite components, and zero
    vectors take no part; repeated ids count once; a query without candidates has no rows."""
    limit = chi_square_quantile(sure, PLANES)

    def search(data, ids, matrix):
        good = (matrix != 0).any(1)
        ids, matrix = ids[good], matrix[good]
        tree = Tree(data, matrix.shape[1])
        projected = unit(matrix) @ planes(matrix.shape[1])
        found = [tree.nearest(int(i), q, p, k, limit) for i, q, p in zip(ids, matrix, projected, strict=True)]
        counts = [len(r) for r, *_ in found]
        rows = np.concatenate([r for r, *_ in found]) if found else np.zeros(0, np.int64)
        score = np.concatenate([s for _, s, _ in found]) if found else np.zeros(0)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), pa.array(tree.ids[rows]), pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"])

    hits = searched(vectors, is_query, Tree.build, search, k, "neighbours", "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
