"""Vectors packed into shards, and blocks of queries paired with every shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm.common import mix64, stored

#: Rows of a shard and queries of a block, on average, and blocks that a shard meets in one place.
SHARD_ROWS, BLOCK_QUERIES, BLOCKS = 8192, 512, 16


def rows_of(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the usable vectors of a batch, one entry per number of components.

    A row without id, a NULL or empty vector, and one that holds a NULL or non-finite component are left out."""
    ids, vectors = batch.column("vec_id"), batch.column("embedding")
    usable = ids.is_valid().to_numpy(False) & vectors.is_valid().to_numpy(False)
    flat = vectors.flatten() if isinstance(vectors, (pa.ListArray, pa.LargeListArray)) else vectors.values
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL reads as NaN
    length = np.where(vectors.is_valid().to_numpy(False), vectors.value_lengths().fill_null(0).to_numpy(False), 0)
    first = np.concatenate(([0], np.cumsum(length)[:-1])) if len(length) else length
    keys = ids.fill_null(0).to_numpy(False)
    out = []
    for n in np.unique(length[usable & (length > 0)]).tolist():
        rows = np.flatnonzero(usable & (length == n))
        matrix = values[first[rows][:, None] + np.arange(n)]
        good = np.isfinite(matrix).all(1)
        out.append((keys[rows][good].astype(np.int64), matrix[good]))
    return out


def packed(vectors: DataFrame, groups: int, salt: int, build: Callable, label: str) -> DataFrame:
    """Table (size, grp, data): vectors (vec_id, embedding) dealt by a hash of vec_id to ``groups``
    groups of each vector size, where ``build(ids, matrix)`` makes a group's bytes.

    Repeated ids count once (of differing vectors the one that is least component by component)."""

    def deal(batches):
        for batch in batches:
            for ids, matrix in rows_of(batch):
                group = (mix64(ids.view(np.uint64) + np.uint64(salt)) % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                ids, matrix, group = ids[order], matrix[order], group[order]
                edges = np.flatnonzero(np.diff(group, prepend=-1))
                ends = np.append(edges[1:], len(group))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(edges), matrix.shape[1], np.int32)), pa.array(group[edges]),
                    pa.array([ids[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
                    pa.array([matrix[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
                ], names=["size", "grp", "ids", "matrix"])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        size, group = int(rows["size"].iloc[0]), int(rows["grp"].iloc[0])
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in rows["ids"]])
        matrix = np.concatenate([np.frombuffer(x).reshape(-1, size) for x in rows["matrix"]])
        order = np.lexsort((*matrix.T[::-1], ids))
        ids, matrix = ids[order], matrix[order]
        once = np.diff(ids, prepend=ids[:1] - 1) != 0
        return pd.DataFrame({"size": [size], "grp": [group], "data": [build(ids[once], matrix[once])]})

    chunks = vectors.select("vec_id", "embedding").mapInArrow(deal, "size int, grp bigint, ids binary, matrix binary")
    return stored(chunks.groupBy("size", "grp").applyInPandas(gather, "size int, grp bigint, data binary"), label)


def searched(vectors: DataFrame, is_query, build: Callable, search: Callable, k: int, label: str, schema: str) -> DataFrame:
    """Rows of ``search(shard bytes, query ids, query matrix)`` for every block of queries and every shard.

    Blocks and shards are bounded, a pair of them is a task's row; both sides are
    dealt by an equi-join, nothing is broadcast: Spark's size check would take the queries' table as
    stored, not its copies for every shard, and gather those on the driver. A shard is sent once per
    ``BLOCKS`` blocks (as many queries as it has rows), the smaller blocks once per shard."""
    n, queries = vectors.count(), vectors.where(is_query)
    shards, blocks = -(-n // SHARD_ROWS) or 1, -(-queries.count() // BLOCK_QUERIES) or 1
    index = packed(vectors, shards, 1, build, f"{label}-index")
    asked = packed(queries, blocks, 2, lambda ids, matrix: ids.tobytes() + matrix.tobytes(), f"{label}-queries")
    rounds = -(-blocks // BLOCKS)
    left = index.select("size", F.col("grp").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"), "data")
    right = asked.select("size", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.floor(F.col("grp") / BLOCKS).cast("int").alias("round"), F.col("data").alias("queries"))
    pairs = left.hint("merge").join(right, ["size", "shard", "round"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                size, blob = batch.column("size")[r].as_py(), batch.column("queries")[r].as_py()
                m = len(blob) // (8 + 8 * size)
                ids, matrix = np.frombuffer(blob, np.int64, m), np.frombuffer(blob, np.float64, m * size, 8 * m).reshape(m, size)
                yield search(batch.column("data")[r].as_py(), ids, matrix)

    return pairs.select("size", "data", "queries").mapInArrow(run, schema)
