"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL updates.

An n-gram is a run of one or two words, or of one to three word shapes (letters
by case, digits and marks, runs collapsed: ``Aa.``, ``A!``, ``a#``), where a
shape bigram also says whether the word repeats. A feature's value is its
share of the text's n-grams times ``SCALE``, so a score is a sparse dot product: the
mean weight of the n-grams of the whole text, whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm import ftrl
from gradeframe.llm.common import _powers, crc_rest, mix64, slices, text_slices, word_spans

BITS = 18
SCALE = 30.0
THRESHOLD = 0.7
MODULUS, HELD_OUT = 4, 2

_LOWER, _UPPER, _DIGIT = 1, 2, 3
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = _LOWER, _UPPER, _DIGIT, _LOWER
_SALT = mix64(np.arange(900, 910, dtype=np.uint64))


def shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's shape."""
    kind = _CLASS[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)  # Latin-1 capitals: 0xC3 0x80 to 0xC3 0x9E
    capital = lead[buf[lead + 1] < 0x9F]
    kind[capital] = kind[capital + 1] = _UPPER
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1]).astype(bool)
    keep = np.diff(kind, prepend=kind[:1] + 1) != 0
    keep[starts] = True
    at = np.flatnonzero(keep & inside)
    first = np.searchsorted(at, starts)
    power, inverse = _powers(len(at))
    return mix64(np.add.reduceat((kind[at].astype(np.uint64) + np.uint64(1)) * power[: len(at)], first) * inverse[first])


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all n-grams of several texts, ordered by text in each kind."""
    buf, _, starts, ends, text, words = word_spans(texts)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shape = shapes(buf, starts, ends)
    same2 = text[1:] == text[:-1]
    same3 = same2[1:] & same2[:-1]
    repeats = (words[1:] == words[:-1]).astype(np.uint64)
    pair = shape[:-1] * np.uint64(3) + shape[1:] * np.uint64(7) + repeats
    kinds = [
        (text, words),
        (text, shape),
        (text[1:][same2], (words[:-1] * np.uint64(3) + words[1:] * np.uint64(5))[same2]),
        (text[1:][same2], pair[same2]),
        (text[2:][same3], (pair[:-1] * np.uint64(9) + shape[2:] * np.uint64(11))[same3]),
    ]
    out = [(t, (mix64(h ^ _SALT[k]) >> np.uint64(64 - BITS)).astype(np.int64)) for k, (t, h) in enumerate(kinds)]
    return np.concatenate([t for t, _ in out]), np.concatenate([f for _, f in out])


def features(texts: list[str]):
    """(index, value) per text; index 0 is the constant."""
    data = [t.encode("utf-8", "replace") for t in texts]
    for a, b in slices([len(t) for t in data]):
        text, feature = ngrams(data[a:b])
        order = np.argsort(text, kind="stable")
        text, feature = text[order], feature[order]
        edges = np.searchsorted(text, np.arange(b - a + 1))
        for i in range(b - a):
            index, count = np.unique(feature[edges[i]: edges[i + 1]], return_counts=True)
            value = count * (SCALE / max(1, count.sum()))
            keep = index > 0
            yield np.concatenate(([0], index[keep])), np.concatenate(([1.0], value[keep]))


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    rows = ftrl.training_rows(docs, labels, "quality", MODULUS, HELD_OUT)
    return ftrl.fit(rows, features, 1 << BITS, epochs=3, alpha=0.3, beta=1.0, l1=0.02, l2=0.001)


def score_column(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    out = []
    for a, b, texts in text_slices(column):
        text, feature = ngrams([t.encode("utf-8", "replace") for t in texts])
        total = np.bincount(text, np.where(feature > 0, weights[feature], 0), b - a)
        out.append(weights[0] + SCALE * total / np.maximum(1, np.bincount(text, minlength=b - a)))
    return ftrl.logistic(np.concatenate(out)) if out else np.zeros(0)


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with score (double) and predicted (int); a column of these names is replaced."""
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(rest).schema) + ", score double"

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(score_column(batch.column("text"), weights))], names=[*rest, "score"])

    return docs.select(rest).mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows that are not held out and score every document.

    ``docs``: doc_id, text and any others (kept); ``labels``: doc_id, quality. Adds score (0 to 1, higher:
    label 1 likelier), predicted (1 if score >= 0.7) and held_out (crc32 of the
    id modulo 4 is 2; NULL for a NULL id). Only the text is scored: a NULL or
    empty text gets the score of the constant, repeated rows equal scores. No
    documents, no rows; no labels, a score of 0.5 everywhere.
    """
    return scored(docs, train(docs, labels)).withColumn("held_out", crc_rest(F.col("doc_id"), MODULUS) == HELD_OUT)
