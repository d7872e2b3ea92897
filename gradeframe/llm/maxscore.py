"""Exact top-k by inner product: MaxScore over shards of dimension-ordered postings.

Terms are the dimensions, with signed integer weights. For a query and a shard a
term's bound is the most it can add to a score there. Terms are taken by falling
bound; the non-essential ones are the tail whose bounds together stay below the
threshold (the k-th best score known), so a vector that gains nothing from the
essential terms cannot enter. Postings of the essential terms are traversed, then
the others are probed, a few terms at a time, for vectors that are still
competitive. Each shard returns its best k, and the shards are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeframe.llm.vectors import searched

SCALE = 256
#: Vectors of each strongest term that give the first threshold; terms probed at a time.
SEEDS, STRONGEST, PROBE = 16, 6, 8


class Shard:
    """Postings of a shard: weights by dimension, each dimension's extremes and strongest vectors."""

    def __init__(self, data: bytes, size: int):
        n = len(data) // (8 + 8 * size)
        self.ids = np.frombuffer(data, np.int64, n)
        self.weights = np.frombuffer(data, np.int64, n * size, 8 * n).reshape(size, n)
        self.n = n
        self.most, self.least = self.weights.max(1).astype(float), self.weights.min(1).astype(float)
        self.postings = self.weights.astype(float)
        heads = min(SEEDS, n)
        self.high = np.argpartition(-self.weights, heads - 1, axis=1)[:, :heads]
        self.low = np.argpartition(self.weights, heads - 1, axis=1)[:, :heads]

    @staticmethod
    def build(ids: np.ndarray, matrix: np.ndarray) -> bytes:
        return ids.tobytes() + np.ascontiguousarray(np.floor(SCALE * matrix).astype(np.int64).T).tobytes()

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        return query @ self.weights[:, rows]

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the best k vectors other than the query's own; ties to smaller ids."""
        q = query.astype(float)
        bound = np.maximum(q * self.most, q * self.least).clip(0)
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)  # rest[i]: bounds of terms i and after
        slack = 2.0**-40 * (np.abs(q) * np.maximum(np.abs(self.most), np.abs(self.least))).sum()  # rounding of sums
        strongest = order[:STRONGEST]
        seeds = np.unique(np.concatenate([self.high[d] if q[d] > 0 else self.low[d] for d in strongest]))
        seeds = seeds[self.ids[seeds] != query_id]
        threshold = np.sort(self.exact(seeds, query))[-k] - slack if len(seeds) >= k else -np.inf
        # Essential: the shortest head of the terms whose tail stays below the threshold.
        essential = int(np.searchsorted(-rest, -threshold, "right")) if threshold > 0 else len(order)
        essential = min(max(essential, 1), len(order))
        head = order[:essential]
        partial = q[head] @ self.postings[head]
        rows = np.flatnonzero(partial + rest[essential] >= threshold)
        partial = partial[rows]
        for i in range(essential, len(order), PROBE):
            terms = order[i: i + PROBE]
            partial = partial + q[terms] @ self.postings[np.ix_(terms, rows)]
            competitive = partial + rest[i + len(terms)] >= threshold
            rows, partial = rows[competitive], partial[competitive]
        rows = rows[self.ids[rows] != query_id]
        score = self.exact(rows, query)
        best = np.lexsort((self.ids[rows], -score))[:k]
        return rows[best], score[best]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of integer vectors floor(256 * x) per query.

    ``vectors``: vec_id, embedding (other columns are ignored). Queries are rows with ``is_query``, candidates all
    rows of as many components but the query's own, ties go to the smaller vec_id. Rows without id or vector, or with
    NULL or non-finite components, take no part; repeated ids count once; a query without candidates has no rows."""

    def search(data, ids, matrix):
        shard = Shard(data, matrix.shape[1])
        queries = np.floor(SCALE * matrix).astype(np.int64)
        found = [shard.top(int(i), q, k) for i, q in zip(ids, queries, strict=True)]
        counts = [len(r) for r, _ in found]
        rows = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
        score = np.concatenate([s for _, s in found]) if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), pa.array(shard.ids[rows]), pa.array(score)], names=["query_id", "vec_id", "score"])

    hits = searched(vectors, is_query, Shard.build, search, k, "maxscore", "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
