"""The quality classifier against a plain one: n-grams counted in a dict, FTRL coordinate by coordinate, dot products term by term."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gradeframe.llm import ftrl, quality
from gradeframe.llm.common import mix64, word_spans

SMALL = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1
PARAMETERS = {"alpha": 0.3, "beta": 1.0, "l1": 0.02, "l2": 0.001}


def mixed(x):
    return int(mix64(np.array([x & MASK], np.uint64))[0])


def plain_features(text):
    """{feature: value} of a text; 0 is the constant."""
    words = text.encode().split()
    word, shape = [], []
    for w in words:
        buf, _, starts, ends, _, hashes = word_spans([w])
        word.append(int(hashes[0]))
        shape.append(int(quality.shapes(buf, starts, ends)[0]))
    pair = [shape[i] * 3 + shape[i + 1] * 7 + (word[i] == word[i + 1]) for i in range(len(words) - 1)]
    kinds = [word, shape, [word[i] * 3 + word[i + 1] * 5 for i in range(len(words) - 1)], pair,
             [pair[i] * 9 + shape[i + 2] * 11 for i in range(len(words) - 2)]]
    count = Counter(mixed((h & MASK) ^ int(quality._SALT[k])) >> (64 - quality.BITS) for k, some in enumerate(kinds) for h in some)
    total = max(1, sum(count.values()))
    return {0: 1.0, **{f: n * quality.SCALE / total for f, n in count.items() if f > 0}}


def plain_ftrl(examples, epochs, alpha, beta, l1, l2):
    z, n = Counter(), Counter()

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for epoch in range(epochs):
        order = range(len(examples)) if not epoch else np.random.default_rng(epoch).permutation(len(examples)).tolist()
        for k in order:
            x, label = examples[k]
            w = {i: weight(i) for i in x}
            g = 1 / (1 + math.exp(-min(35.0, max(-35.0, sum(w[i] * v for i, v in x.items()))))) - label
            for i, v in x.items():
                grown = n[i] + (g * v) ** 2
                z[i] += g * v - (math.sqrt(grown) - math.sqrt(n[i])) / alpha * w[i]
                n[i] = grown
    return {i: weight(i) for i in z if weight(i)}


TEXTS = ["", "One", "one two  TWO\ttwo Two. 12-34 été ÀÉ x1!", "a a a a b", "Hello, World! Hello, World! http://x.y/z?q=1 ÿ ß 日本"]


@pytest.mark.parametrize("text", TEXTS)
def test_features(text):
    (index, value), = quality.features([text])
    got = dict(zip(index.tolist(), value.tolist(), strict=True))
    assert got.keys() == plain_features(text).keys() and all(got[i] == pytest.approx(v) for i, v in plain_features(text).items())


def test_every_score_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    place = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in known], "doc_id bigint").selectExpr("doc_id", "xxhash64(doc_id)").collect()}
    learned = sorted((i for i in known if i in texts), key=lambda i: place[i])
    assert 20 <= len(learned) <= ftrl.TRAINING_ROWS
    x = {i: plain_features(t) for i, t in texts.items()}
    weights = plain_ftrl([(x[i], known[i]) for i in learned], 3, **PARAMETERS)
    want = {i: 1 / (1 + math.exp(-sum(weights.get(f, 0.0) * v for f, v in own.items()))) for i, own in x.items()}
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[i]["score"] - p) < 1e-3 for i, p in want.items())
    assert all(got[i]["predicted"] == (p >= 0.7) for i, p in want.items() if abs(p - 0.7) > 1e-3)
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in want)
