"""Periodic runs against brute force over all periods."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradeframe.llm import catalog, runs


def brute_runs(w):
    """Runs (start, length, smallest period) by trying every period at every place."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def digest(doc_id, words):
    """The contract's row, step by step."""
    n, w = len(words), words
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=70), st.lists(st.tuples(st.integers(0, 69), st.integers(1, 9), st.integers(0, 70)), max_size=3))
def test_runs_of_any_words(w, plants):
    for a, p, e in plants:
        for i in range(a, min(e, len(w))):
            w[i] = w[a + (i - a) % p]
    assert runs.runs_of(list(w)) == brute_runs(w)
    text = " ".join(f"w{x}" for x in w).encode()
    assert runs.runs_of_texts([b"", text, b"one two", text]) == [[], brute_runs(w), [], brute_runs(w)]


def test_grammar_derives_its_input():
    r = random.Random(4)
    for _ in range(200):
        x = [r.choice([0, 1, 2, -1]) for _ in range(r.randint(1, 60))]
        g = runs.Grammar(x)

        def derived(s):
            return [s] if s < g.first else derived(g.rules[s - g.first][0]) + derived(g.rules[s - g.first][1])

        assert [w for s, _ in g.top for w in derived(s)] == x
        assert all(derived(k + g.first) == x[at: at + len(derived(k + g.first))] for k, (_, _, at) in enumerate(g.rules))
        assert all(-1 not in derived(k + g.first) for k in range(len(g.rules)))


def test_runs_in_lines_and_white_space():
    text = ("buy now \t" * 5 + "\n" + "a\x0bb\x0cc " * 4 + "end").encode()
    assert runs.runs_of_texts([text]) == [[(0, 10, 2), (10, 12, 3)]]
    assert runs.collapsed(text.split(), [(0, 10, 2), (10, 12, 3)]) == b"buy now a b c end"
    five = b"x x x x x"
    assert runs.runs_of_texts([five, five + b" x"]) == [[], [(0, 6, 1)]]


def test_a_very_long_text():
    r = random.Random(8)
    block = [f"w{r.randrange(400)}" for _ in range(9_000)]
    text = " ".join(block * 5 + ["z"] * 40_000).encode()
    assert runs.runs_of_texts([text]) == [[(0, 45_000, 9_000), (45_000, 40_000, 1)]]


ROWS = [
    (1, None, "x"), (2, "", "x"), (3, " \n\t ", "x"), (None, "one two " * 9, "x"), (None, None, "x"), (5, "word", "x"),
    (6, "la " * 30 + "end", "x"), (6, "la " * 30 + "end", "x"), (7, "a b c d " * 3, "x"), (8, "a b c d " * 4, "x"),
    *[(i, " ".join(f"w{(i * k * k) % 37}" for k in range(i)), "x") for i in range(20, 140)],
]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id bigint, text string, runs string, w string, h string, a string, p string, collapsed string, longest string, lines string"
    return spark.createDataFrame([(i, t, *[x] * 8) for i, t, x in ROWS], schema).repartition(5)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_columns_against_brute_force(docs, spark):
    out = runs.digest(runs.periodic_runs(runs.with_planted_periods(docs)))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows_of(out) == sorted((digest(i, (t or "").split()) for i, t, _ in ROWS), key=repr)
    assert {t for _, t in out.dtypes} == {"bigint", "string"}
    found = {r["doc_id"]: r for r in runs.periodic_runs(docs).collect()}
    assert found[6]["collapsed"] == "la end" and found[6]["n_words"] == 31 and found[8]["collapsed"] == "a b c d"
    empty = docs.limit(0)
    assert runs.digest(runs.periodic_runs(runs.with_planted_periods(empty))).count() == 0


def test_whole_table_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    short = {i: t for i, t in texts if len((t or "").split()) <= 1500}  # brute force is quadratic
    out = {r["doc_id"]: tuple(r) for r in catalog.QUERIES["op12_periodic_runs"](spark, d).collect()}
    assert set(out) == {i for i, _ in texts} and len(short) > 150
    assert all(out[i] == digest(i, (t or "").split()) for i, t in short.items())
    assert sum(r[1] > 0 for r in out.values()) >= 5
