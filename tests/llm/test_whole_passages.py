"""Repeated passages go whole, wherever their lines break and whatever stands beside them."""

import random

import numpy as np

from gradeframe.llm import paragraphs


def words(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghinorstu") for _ in range(r.randint(2, 7))) for _ in range(n)]


def deduped(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r for r in paragraphs.dedup_substrings(frame).collect()}


def test_passages_go_to_their_ends_if_the_kept_document_is_copied(spark):
    """Every paragraph of a copied document has equal neighbours; holders of a passage are extended all the same."""
    texts, want = [], {}
    for k in range(20):
        source = words(k, 200)
        passage = source[60:130]
        own = words(100 + k, 40), words(200 + k, 40)
        texts += [" ".join(source), " ".join(source), " ".join([*own[0], *passage, *own[1]])]
        want[3 * k + 2] = " ".join([*own[0], *own[1]])
    out = deduped(spark, texts)
    assert all(out[3 * k]["removed_words"] == 0 and out[3 * k + 1]["text"] == "" for k in range(20))
    whole = sum(out[i]["text"].split() == t.split() for i, t in want.items())
    assert whole >= 18 and sum(out[i]["removed_words"] for i in want) >= 18 * 70


def test_sides_that_another_repeat_removes():
    item = {"n": 10, "both": False, "kept": 5, "shift": 0}
    rows = [{**item, "first": 0}, {**item, "first": 10}, {**item, "first": 20, "both": True}, {**item, "first": 30}, {**item, "first": 40, "shift": 3}]
    get = lambda name: np.array([x[name] for x in rows])
    doc = np.zeros(len(rows), np.int64)
    out = paragraphs.covered(doc, get("first"), get("first") + 10, get("both"), get("kept"), get("shift"))
    assert out.tolist() == [[False, True], [True, False], [False, False], [False, False], [False, False]]
    apart = paragraphs.covered(np.arange(len(rows)), get("first"), get("first") + 10, get("both"), get("kept"), get("shift"))
    assert not apart.any()


def test_passages_go_however_their_lines_break(spark):
    """In short lines; over parts of two lines; in short lines here and on one line there; 51 words within long lines."""
    texts, first = [], {}
    for k in range(40):
        p, a, b = words(300 + k, 51), words(400 + k, 40), words(500 + k, 40)
        lines = "\n".join(" ".join(p[i: i + 6]) for i in range(0, 51, 6))
        parts = [
            ("\n".join((" ".join(a[:12]), lines, " ".join(b[:12]))), "\n".join((" ".join(a[20:32]), lines, " ".join(b[20:32])))),
            (" ".join(a[:9] + p[:25]) + "\n" + " ".join(p[25:] + b[:9]), " ".join(a[20:29] + p[:25]) + "\n" + " ".join(p[25:] + b[20:29])),
            (" ".join(p), lines),
            (" ".join(a[:20] + p + b[:20]), " ".join(a[20:] + p + b[20:])),
        ][k % 4]
        texts += parts
        first[2 * k + 1] = 2 * k
    out = deduped(spark, texts)
    got = {i: (out[i]["removed_words"] in (51, 52), out[i]["duplicate_of"], out[j]["removed_words"]) for i, j in first.items()}  # the word beside may be equal
    assert got == {i: (True, [j], 0) for i, j in first.items()}


def test_every_window_holds_an_anchor():
    r = np.random.default_rng(1)
    for h in (r.integers(0, 2**60, 4000), r.integers(0, 3, 4000), np.zeros(400, int), np.arange(4000) % 2, np.arange(4000) % 20, np.repeat(r.integers(0, 9, 100), 40)):
        h = h.astype(np.uint64)
        places = paragraphs.anchor_places(h, np.ones(len(h), bool))
        w = paragraphs.WINDOW
        for s in range(len(h) - w + 1):
            own = places[(places >= s) & (places < s + w)]
            assert h[s: s + w].min() in h[own]
        assert len(places) <= 0.2 * len(h)


def test_whole_repeated_lines_go_whatever_their_length(spark):
    line, doc, short = " ".join(words(1, 14)), " ".join(words(2, 11)), " ".join(words(3, 8))
    texts = [" ".join(words(k, 30)) + "\n" + line for k in (11, 12, 13)] + [doc, doc, short, short]
    out = deduped(spark, texts)
    assert [(out[i]["removed_words"], out[i]["duplicate_of"]) for i in range(7)] == [(0, []), (14, [0]), (14, [0]), (0, []), (11, [3]), (0, []), (0, [])]
    assert out[1]["text"] == texts[1].split("\n")[0] and out[4]["text"] == ""


def test_short_runs_leave_whole_lines_only():
    a, b, c = (" ".join(words(k, 12)) for k in (1, 2, 3))
    text = f"{a}\n{b}\n{c}"
    for spans, want in (([(10, 24)], f"{a}\n{c}"), ([(12, 27)], f"{a}\n{c}"), ([(3, 20)], text), ([(0, 12)], f"{b}\n{c}"), ([(24, 36)], f"{a}\n{b}"), ([(1, 12)], text)):
        left, gone = paragraphs.without(text, spans, 25)
        assert left.strip("\n") == want and gone.sum() == (0 if want == text else 12)
