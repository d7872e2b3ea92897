"""The pipeline's stages against what each operator says of its input."""

import re

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from gradeframe.llm import simhash

D = "/root/testdata/sf0.01"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / str(k))
        stage(spark, docs, D).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages(steps):
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "source_mixing", "best_fit_packing"]
    for frame in steps[1:-1]:
        assert frame.columns == steps[0].columns and frame.dtypes == steps[0].dtypes


def test_quality_keeps_clean_documents(spark, steps):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in steps[1].select("doc_id").collect()}
    good, bad = ([i for i, q in labels.items() if q == want] for want in (1, 0))
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.03 * len(bad)
    texts = {r["doc_id"]: tuple(r) for r in steps[0].collect()}
    assert all(texts[r["doc_id"]] == tuple(r) for r in steps[1].collect())


def test_one_document_of_each_group_stays(steps):
    rows = steps[1].collect()
    prints = np.array([simhash.fingerprint(r["text"], 4) for r in rows], np.uint64)
    label = np.array([r["doc_id"] for r in rows])
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    while True:
        low = np.array([label[near[i]].min() for i in range(len(rows))])
        if (low == label).all():
            break
        label = low
    kept = steps[2].collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(label.tolist()))
    texts = {r["doc_id"]: tuple(r) for r in rows}
    assert all(texts[r["doc_id"]] == tuple(r) for r in kept)


def test_passages_stay_once(steps):
    before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in steps[2:4])

    def shared(texts, n=50):
        seen, count = {}, 0
        for i, t in texts.items():
            w = t.split()
            for k in range(len(w) - n + 1):
                count += seen.setdefault(hash(tuple(w[k: k + n])), i) != i
        return count

    assert shared(before) > 0 and shared(after) <= 0.05 * shared(before)
    for i, text in after.items():  # words go, none are made
        w = iter(before[i].split())
        assert all(x in w for x in text.split())
    assert all(r["n_chars"] == len(r["text"]) for r in steps[3].collect() if r["text"] != before[r["doc_id"]])


def test_mix_meets_the_weights(steps):
    source = {r["doc_id"]: r["source"] for r in steps[3].collect()}
    sizes, taken, per_doc = {}, {}, {}
    for r in steps[3].collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    for r in steps[4].collect():
        assert source[r["doc_id"]] == r["source"] and r["n_chars"] == len(r["text"])
        taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
        per_doc[r["doc_id"]] = per_doc.get(r["doc_id"], 0) + size(r["text"])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    share = sum(sizes.values()) / sum(weight.values())
    assert all(weight[s] * share < 3 * sizes[s] for s in order)  # no cap here
    assert all(abs(taken[s] - weight[s] * share) <= max(128, 0.03 * weight[s] * share) for s in order)
    whole = {r["doc_id"]: size(r["text"]) for r in steps[3].collect()}
    assert all(n <= 3 * whole[i] for i, n in per_doc.items())


def test_pieces_fill_sequences(steps):
    p = steps[5].toPandas().sort_values(["sequence_id", "offset"])
    assert (p.groupby("sequence_id").length.cumsum() - p.length == p.offset).all()
    assert p.groupby("sequence_id").length.sum().max() <= 1024
    assert p.sequence_id.nunique() <= -(-p.length.sum() // 1024) * 1.01 + 1
    assert set(p.doc_id) == {r["doc_id"] for r in steps[4].select("doc_id").collect()}


def test_run_and_awkward_documents(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "One two three.", "en", "b", 14), (4, "word " * 30_000, "en", None, 150_000)]
    extra = [(*r, "x", "y") for r in rows]
    spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, h string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{D}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    out = P.run(spark, str(tmp_path))
    assert set(out.columns) >= {"doc_id", "piece", "sequence_id", "offset"} and out.count() >= 0
    assert "pipeline" in E.queries() and P.ORACLE_SQL is None
    empty = tmp_path / "empty"
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(empty / "documents.parquet"))
    spark.read.parquet(f"{D}/labels.parquet").write.parquet(str(empty / "labels.parquet"))
    assert P.run(spark, str(empty)).count() == 0


def test_unlinked_documents_stay_whatever_their_ids_and_columns(spark):
    """Different texts that share an id, or have none, are different documents; extra columns may have any name."""
    r = np.random.default_rng(3)
    text = lambda: " ".join("w%d" % x for x in r.integers(0, 10**6, 60))
    a, b, c, d, e = (text() for _ in range(5))
    near = a + " tail"
    rows = [(None, a), (None, b), (5, c), (5, d), (7, e), (7, e), (9, near), (None, near), (3, None), (4, None)]
    names = ["row", "group", "again", "_id", "_h", "_spans", "_taken", "_score", "score", "_predicted", "predicted", "removed_words", "h", "x.y"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[f"{k} of {n}" for n in names]) for k, (i, t) in enumerate(rows)], schema)
    kept = P.near_dedup(spark, docs, D)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    got = sorted(((x["doc_id"], x["text"]) for x in kept.collect()), key=repr)
    prints = [simhash.fingerprint(t or "", 4) for _, t in rows]
    assert bin(prints[0] ^ prints[6]).count("1") <= 4  # the tail links them
    assert got == sorted([(None, b), (5, c), (5, d), (7, e), (9, near), (3, None)], key=repr)
    for x in kept.collect():
        k = {int(x[n].split()[0]) for n in names if "." not in n}
        assert len(k) == 1 and rows[k.pop()] == (x["doc_id"], x["text"])
    for stage in (P.quality_filter, P.substring_dedup, P.mix):
        out = stage(spark, docs, D)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert all(x[n].endswith(f" of {n}") for x in out.collect() for n in names if "." not in n)
    assert P.substring_dedup(spark, docs, D).count() >= 6 and P.mix(spark, docs, D).count() >= 4
