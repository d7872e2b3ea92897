"""Logistic regression on hashed sparse features, trained by FTRL-proximal updates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm.common import crc_rest, texts_of

#: Labelled rows that a model is fitted on at most (the smallest hashes of doc_id).
TRAINING_ROWS = 12_000


class Ftrl:
    """Per-coordinate FTRL-proximal for the logistic loss; ``weights()`` is the current model."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)

    def update(self, index: np.ndarray, value: np.ndarray, label: float) -> None:
        """One example; ``index`` without repeats."""
        z, n = self.z[index], self.n[index]
        w = self._weights(z, n)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        grown = n + g * g
        self.z[index] = z + g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[index] = grown


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def training_rows(docs: DataFrame, labels: DataFrame, target: str, modulus: int, held_out: int, limit: int = TRAINING_ROWS) -> DataFrame:
    """(text, label, place): at most ``limit`` labelled documents outside the held-out remainder.

    Rows are taken by a hash of doc_id, so a rerun takes the same; NULL labels and ids take no part."""
    usable = labels.where(F.col(target).isNotNull() & (crc_rest(F.col("doc_id"), modulus) != held_out))
    place = F.xxhash64(F.col("doc_id").cast("bigint"))
    taken = usable.groupBy("doc_id").agg(F.max(target).cast("double").alias("label")).orderBy(place, "doc_id").limit(limit)
    # At most `limit` ids: a bounded broadcast instead of a shuffle of all texts.
    return docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "label", place.alias("place"))


def fit(rows: DataFrame, features, size: int, epochs: int, **parameters) -> np.ndarray:
    """Weights (float32) fitted on a bounded sample in one task, in the order of ``place``.

    ``features(texts)`` yields (index, value) per text. No rows: all weights zero."""

    def run(batches):
        model, seen = Ftrl(size, **parameters), []
        for batch in batches:
            for x, label in zip(features(texts_of(batch.column("text"))), batch.column("label").to_pylist(), strict=True):
                seen.append((*x, label))
                model.update(*seen[-1])
        for epoch in range(1, epochs):
            for k in np.random.default_rng(epoch).permutation(len(seen)):
                model.update(*seen[k])
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype("<f4").tobytes()], pa.binary())], names=["weights"])

    ordered = rows.repartition(1).sortWithinPartitions("place", "text", "label")
    found = ordered.mapInArrow(run, "weights binary").first()
    return np.frombuffer(found["weights"], "<f4") if found else np.zeros(size, "<f4")
