"""Vector search against brute force; chat formatting against plain Python."""

import hashlib
import json

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from gradeframe.llm import chat, maxscore, neighbours, vectors
from gradeframe.llm.catalog import HOSTILE
from gradeframe.llm.common import ship

SCHEMA = "vec_id bigint, embedding array<float>, label string, score string, size string"
QUERY = "vec_id % 5 = 0"


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)


def awkward(seed, n=300, size=8):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n // 3, size)).astype(np.float32)
    rows = [(i, base[i % len(base)] if i % 4 == 0 else r.standard_normal(size).astype(np.float32)) for i in range(n)]
    rows += [(n + i, base[0]) for i in range(60)]  # many equal vectors
    rows += [(1000, None), (1005, [1.0, None] + [0.0] * (size - 2)), (1010, [float("nan")] * size), (1015, [float("inf")] * size), (None, base[1]),
             (1020, [0.0] * size), (1025, [1.0] * (size + 1)), (1026, [0.5] * (size + 1)), (1030, []), (2, rows[2][1]), (-5, base[2])]
    return rows


def usable(rows):
    out = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v):
            out.setdefault(i, np.array(v, np.float32).astype(float))
    return out


def brute(rows, measure, k=5, zero=True):
    kept = {i: v for i, v in usable(rows).items() if zero or v.any()}
    out = []
    for q in kept:
        if q % 5 == 0:
            found = sorted(((-measure(kept[q], v), i) for i, v in kept.items() if i != q and len(v) == len(kept[q])))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rows_per_shard", [40, 10_000])
def test_top_k_is_exact(spark, monkeypatch, seed, rows_per_shard):
    monkeypatch.setattr(vectors, "SHARD_ROWS", rows_per_shard)
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 20)
    rows = awkward(seed)
    got = sorted(map(tuple, maxscore.top_k(frame(spark, rows), QUERY).collect()))
    ints = lambda v: np.floor(256 * v).astype(int)
    assert got == brute(rows, lambda a, b: int(ints(a) @ ints(b)))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("blocks", [2, 16])
def test_top_k_gathers_no_copies_of_queries(spark, monkeypatch, blocks):
    """A small table of queries is copied for every shard: the copies are dealt, not broadcast from the driver."""
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_QUERIES", 20), ("BLOCKS", blocks)):
        monkeypatch.setattr(vectors, name, value)
    rows = awkward(3)
    found = maxscore.top_k(frame(spark, rows), QUERY)
    before = plan_of(found)
    got = sorted(map(tuple, found.collect()))
    assert "Broadcast" not in before and "Broadcast" not in plan_of(found)
    ints = lambda v: np.floor(256 * v).astype(int)
    assert got == brute(rows, lambda a, b: int(ints(a) @ ints(b)))


@pytest.mark.parametrize("n", [0, 1, 3, 6])
def test_few_vectors(spark, n):
    rows = [(5 * i, [1.0, float(i)]) for i in range(n)]
    for search in (maxscore.top_k, neighbours.nearest):
        got = search(frame(spark, rows), QUERY).collect()
        assert len(got) == n * min(5, max(0, n - 1))


def test_negative_scores_count(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [-float(i), 0.0]) for i in range(1, 8)]
    got = maxscore.top_k(frame(spark, rows), "vec_id = 0").collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got) == [(i, i) for i in range(1, 6)]


def cosine(a, b):
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


@pytest.mark.parametrize("rows_per_shard", [50, 10_000])
def test_neighbours_recall_and_scores(spark, monkeypatch, rows_per_shard):
    monkeypatch.setattr(vectors, "SHARD_ROWS", rows_per_shard)
    rows = awkward(1, 900, 24)
    want, got = brute(rows, cosine, zero=False), sorted(map(tuple, neighbours.nearest(frame(spark, rows), QUERY).collect()))
    kept = usable(rows)
    assert [(q, n) for q, n, *_ in got] == [(q, n) for q, n, *_ in want]
    assert all(abs(s - cosine(kept[q], kept[i])) < 1e-12 for q, _, i, s in got)
    hits = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want})
    assert hits >= 0.95 * len(want)


@pytest.mark.parametrize("blocks", [2, 16])
def test_neighbours_gather_no_copies_of_queries(spark, monkeypatch, blocks):
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_QUERIES", 20), ("BLOCKS", blocks)):
        monkeypatch.setattr(vectors, name, value)
    rows = awkward(4)
    found = neighbours.nearest(frame(spark, rows), QUERY)
    before = plan_of(found)
    want, got = brute(rows, cosine, zero=False), sorted(map(tuple, found.collect()))
    assert "Broadcast" not in before and "Broadcast" not in plan_of(found)
    assert [(q, n) for q, n, *_ in got] == [(q, n) for q, n, *_ in want]
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.95 * len(want)


def test_neighbours_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = E.queries()["op10_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect()
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    ids = np.array(sorted(rows))
    unit = np.array([rows[i] / np.linalg.norm(rows[i]) for i in ids])
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        s = unit @ unit[np.searchsorted(ids, q)]
        s[ids == q] = -2
        hits += len({r["vec_id"] for r in got if r["query_id"] == q} & set(ids[np.argsort(-s)[:5]].tolist()))
        total += 5
    assert total == len(got) and hits >= 0.9 * total


@pytest.mark.parametrize("groups", [0, 200])
def test_neighbours_verified_share(groups):
    """Of many points a third at most is verified at a recall of 0.9, without any structure and with groups."""
    r = np.random.default_rng(1)
    matrix = r.standard_normal((groups, 64))[r.integers(0, groups, 40_000)] + 0.4 * r.standard_normal((40_000, 64)) if groups else r.standard_normal((40_000, 64))
    ids, unit = np.arange(40_000), neighbours.unit(matrix)
    limit, projected = neighbours.chi_square_quantile(neighbours.SURE, neighbours.PLANES), unit @ neighbours.planes(64)
    trees = [neighbours.Tree(neighbours.Tree.build(ids[a: a + 8192], matrix[a: a + 8192]), 64) for a in range(0, 40_000, 8192)]
    hits = verified = 0
    for q in range(0, 40_000, 1000):
        s = unit @ unit[q]
        s[q] = -2
        found = []
        for t in trees:
            rows, score, n = t.nearest(q, matrix[q], projected[q], 5, limit)
            verified += n
            found += zip(-score, t.ids[rows], strict=True)
        hits += len({i for _, i in sorted(found)[:5]} & set(np.argsort(-s)[:5].tolist()))
    assert hits >= 0.9 * 200 and verified <= 40 * 40_000 / 3


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [0.1, 0.2, 0.3]) for i in range(400)]
    for search in (maxscore.top_k, neighbours.nearest):
        got = search(frame(spark, rows), "vec_id = 200").collect()
        assert sorted((r["rank"], r["vec_id"]) for r in got) == [(i + 1, i) for i in range(5)]


def test_chi_square_quantiles():
    assert neighbours.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert neighbours.chi_square_quantile(0.95, 12) == pytest.approx(21.026, abs=1e-3)


@pytest.mark.parametrize("name", ["op3_chat_formatting", "op6_exact_top_k"])
def test_queries_match_sql(spark, name):
    c = duckdb.connect()
    for t in ("conversations", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = c.execute(E.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = E.queries()[name](spark, "/root/testdata/sf0.01").select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


TEXTS = [HOSTILE, "", "a\nb", "\\", "\\l", "\\e<", "<turn>user\nx</turn>\n", "ünïcode 😀 \\n", "x" * 300_000]


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_conversations_with_awkward_rows(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(TEXTS)]
    rows += [(2, 0, None, None), (2, 1, "assistant", None), (2, 1, "assistant", None), (3, None, "odd\nrole</turn>", "x"), (None, 0, "assistant", "y")]
    table = spark.createDataFrame([(*r, "p", "q") for r in rows], "conv_id bigint, turn bigint, role string, text string, mapping string, turns string")
    made = chat.read_back(chat.formatted(chat.canonical(chat.records_of(table))))
    got = {r["conv_id"]: r for r in chat.digest(made).collect()}
    texts = {r["conv_id"]: r["formatted"] for r in made.select("conv_id", "formatted").collect()}
    for key in (1, 2, 3, None):
        turns = [(r or "", t or "") for i, _, r, t in rows if i == key]
        r = got[key]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digest(turns)
        assert r["formatted_chars"] == len(texts[key]) and texts[key].count("</turn>") == len(turns)
    assert chat.digest(chat.read_back(chat.formatted(chat.canonical(chat.records_of(table.where("false")))))).count() == 0


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"messages": []}, "messages", []),
    ({"messages": [{"role": "user", "content": None}]}, "messages", [("user", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]}, "conversations", [("user", "q"), ("assistant", "a"), ("tool", "t")]),
    ({"prompt": "q", "completion": "a"}, "prompt_completion", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": "a"}, "prompt_response", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "in", "output": "o"}, "instruction", [("user", "i"), ("user", "in"), ("assistant", "o")]),
    ({"instruction": "i", "input": None, "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": 42}, "question_answer", [("user", "q"), ("assistant", "42")]),
    ({"unknown": 1}, None, None),
    (None, None, None),
]


def test_layouts_are_told_apart_by_their_paths(spark):
    rows = [(i, None if r is None else json.dumps(r), "x") for i, (r, _, _) in enumerate(RECORDS)]
    table = spark.createDataFrame(rows, "id int, json string, mapping string").withColumn("record", F.parse_json("json"))
    got = {r["id"]: r for r in chat.read_back(chat.formatted(chat.canonical(table))).collect()}
    for i, (_, name, turns) in enumerate(RECORDS):
        assert got[i]["mapping"] == name
        assert (None if got[i]["turns"] is None else [tuple(t) for t in got[i]["turns"]]) == turns
        if turns is not None:
            assert [tuple(t) for t in got[i]["read_turns"]] == turns
            assert got[i]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        else:
            assert got[i]["formatted"] is None


def test_chat_plan_is_native(spark):
    plan = E.queries()["op3_chat_formatting"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
