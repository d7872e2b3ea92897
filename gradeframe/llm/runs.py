"""Periodic runs of words, found on a grammar of each text.

A run of period q and length at least max(6, 4 q) holds each of its word pairs
three times or more, so a text is cut at the pairs that occur less often in it;
what is left are stretches of at least six words. Re-Pair makes a grammar of the
stretches: the most frequent pair of symbols becomes a new one, until no pair is
left twice; the remaining sequences are made binary by halving. Every run
crosses the boundary between the two parts of the smallest node it fits into, so
runs are sought across the boundary of each nonterminal once (Main and Lorentz:
the matches on both sides of a boundary, by Z-functions, in linear time), moved
to all places where the nonterminal is derived, and intervals of one period that
overlap are merged. A period that is a multiple of a shorter one has the same
maximal intervals, so the smallest period of an interval is its own.

Texts are rows of their own: Spark deals them to tasks, and a task holds a few
megabytes of them at a time.
"""

from __future__ import annotations

from collections import defaultdict
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeframe.llm.common import mix64, text_slices, word_spans

#: A run has at least ``LEAST`` words and ``EXPONENT`` periods.
LEAST, EXPONENT = 6, 4


def z_function(x: list[int]) -> list[int]:
    """For each place, how long what starts there agrees with the beginning."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and x[i + k] == x[k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def crossing(x: list[int], start: int, cut: int, end: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) inside x[start:end] that hold the words at both sides of ``cut``."""
    a, b = x[start:cut], x[cut:end]
    back_a, back_b = a[::-1], b[::-1]
    y, z, most = len(a), len(b), (end - start) // EXPONENT
    out = []
    # Period q repeated to the right of the cut: the match goes on from q words further.
    ahead, behind = z_function(b), z_function([*back_a, -1, *back_b, *back_a])
    for q in range(1, min(z, most) + 1):
        r = ahead[q] if q < z else 0
        s = min(behind[y + 1 + z - q], y)
        if s and s + q + r >= max(LEAST, EXPONENT * q):
            out.append((cut - s, cut + q + r, q))
    # Repeated to the left of it.
    ahead, behind = z_function([*b, -1, *a, *b]), z_function(back_a)
    for q in range(1, min(y, most) + 1):
        s = behind[q] if q < y else 0
        r = min(ahead[z + 1 + y - q], z)
        if r and s + q + r >= max(LEAST, EXPONENT * q):
            out.append((cut - q - s, cut + r, q))
    return out


class Grammar:
    """Re-Pair on a sequence of word ids; negative ids separate stretches and are never paired.

    ``rules``: left and right symbol of each nonterminal, numbered after the words, and
    where one occurrence of it begins; ``top``: the symbols left, with their places."""

    def __init__(self, x: list[int]):
        self.first = max(x, default=0) + 1
        self.rules: list[tuple[int, int, int]] = []
        n = len(x)
        symbol, after, before = list(x), list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i in range(n - 1):
            if x[i] >= 0 and x[i + 1] >= 0:
                places[x[i], x[i + 1]].append(i)
        # Most frequent first, and of equal frequency the oldest: this keeps the grammar flat.
        heap = [(-len(p), k, pair) for k, (pair, p) in enumerate(places.items()) if len(p) > 1]
        heapify(heap)
        age = len(places)
        while heap:
            known, k, (a, b) = heappop(heap)
            held, last = [], -1
            for i in places[a, b]:  # places that still hold the pair and do not overlap
                if symbol[i] == a and i != last and (j := after[i]) < n and symbol[j] == b:
                    held.append(i)
                    last = j if a == b else -1
            places[a, b] = held
            if len(held) < 2:
                continue
            if len(held) < -known:
                heappush(heap, (-len(held), k, (a, b)))
                continue
            new = self.first + len(self.rules)
            self.rules.append((a, b, held[0]))
            grown = set()
            for i in held:
                j = after[i]
                if symbol[i] != a or j >= n or symbol[j] != b:
                    continue
                symbol[i], symbol[j] = new, None
                after[i] = right = after[j]
                left = before[i]
                if right < n:
                    before[right] = i
                    if symbol[right] >= 0:
                        places[new, symbol[right]].append(i)
                        grown.add((new, symbol[right]))
                if left >= 0 and symbol[left] >= 0:
                    places[symbol[left], new].append(left)
                    grown.add((symbol[left], new))
            places[a, b] = []
            for pair in sorted(grown):
                places[pair].sort()
                if len(places[pair]) > 1:
                    age += 1
                    heappush(heap, (-len(places[pair]), age, pair))
        self.top, i = [], 0
        while i < n:
            self.top.append((symbol[i], i))
            i = after[i]


def runs_of(x: list[int]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of ids, by start, then period."""
    n = len(x)
    grammar = Grammar(x)
    first, rules = grammar.first, grammar.rules
    size = [1] * first
    for a, b, _ in rules:
        size.append((size[a] if a >= 0 else 1) + (size[b] if b >= 0 else 1))
    following, preceding, seen = [n] * n, [-1] * n, {}  # the places of the same word
    for i, w in enumerate(x):
        if (p := seen.get(w)) is not None:
            following[p], preceding[i] = i, p
        seen[w] = i

    def across(start, cut, end):
        if end - start < LEAST or (following[cut] >= end and preceding[cut - 1] < start):
            return []  # no word is repeated on either side of the cut
        return crossing(x, start, cut, end)

    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    inside = [across(at, at + size[a], at + size[a] + size[b]) for a, b, at in rules]
    # From the last rule to the first, every place where a nonterminal is derived.
    used: list[list[np.ndarray]] = [[] for _ in rules]
    wanted = any(inside)
    stretch: list[tuple[int, int]] = []

    def halve(lo, hi):
        todo = [(lo, hi)]
        while todo:
            lo, hi = todo.pop()
            if hi - lo < 2:
                continue
            mid = (lo + hi) // 2
            at, end = stretch[lo][1], stretch[hi - 1][1] + size[stretch[hi - 1][0]]
            for s, e, q in across(at, stretch[mid][1], end):
                found[q].append((s, e))
            todo += [(lo, mid), (mid, hi)]

    for symbol, at in [*grammar.top, (-1, n)]:
        if symbol < 0:
            halve(0, len(stretch))
            stretch = []
            continue
        stretch.append((symbol, at))
        if wanted and symbol >= first:
            used[symbol - first].append(np.array([at]))
    if wanted:
        for k in range(len(rules) - 1, -1, -1):
            a, b, at = rules[k]
            here = np.concatenate(used[k]) if used[k] else np.zeros(0, np.int64)
            used[k] = []
            if a >= first:
                used[a - first].append(here)
            if b >= first:
                used[b - first].append(here + size[a])
            for s, e, q in inside[k]:
                found[q].extend(zip((here + (s - at)).tolist(), (here + (e - at)).tolist(), strict=True))
    best: dict[tuple[int, int], int] = {}
    for q in sorted(found):
        reach: list[list[int]] = []
        for s, e in sorted(found[q]):
            if reach and s <= reach[-1][1] - q:
                reach[-1][1] = max(reach[-1][1], e)
            else:
                reach.append([s, e])
        for s, e in reach:
            best.setdefault((s, e), q)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def stretches(text_index: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of each stretch of words, within one text, whose neighbouring
    pairs all occur three times or more in that text; at least ``LEAST`` words."""
    if len(hashes) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = text_index[1:] == text_index[:-1]
    pair = mix64(hashes[:-1] ^ mix64(hashes[1:] + text_index[1:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
    often = same & (count[which] >= EXPONENT - 1)
    edge = np.diff(np.concatenate(([False], often, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
    long = ends - starts >= LEAST
    return starts[long], ends[long]


def runs_of_texts(texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """The runs of the words of each text."""
    _, _, _, _, text_index, hashes = word_spans(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    starts, ends = stretches(text_index, hashes)
    begins = np.searchsorted(text_index, np.arange(len(texts) + 1))
    owner = text_index[starts]
    for t in np.unique(owner).tolist():
        own = np.flatnonzero(owner == t)
        words = np.concatenate([hashes[starts[k]: ends[k]] for k in own])
        ids = np.unique(words, return_inverse=True)[1].tolist()
        x: list[int] = []  # the stretches, each followed by a separator, and where their words are
        place: list[int] = []
        at = 0
        for k in own:
            m = int(ends[k] - starts[k])
            x += ids[at: at + m] + [-1]
            place += range(int(starts[k] - begins[t]), int(starts[k] - begins[t]) + m + 1)
            at += m
        out[t] = [(place[s], n, q) for s, n, q in runs_of(x)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and of each run's first period, joined by blanks."""
    if runs:
        keep = np.ones(len(words), bool)
        for s, n, q in runs:
            keep[s + q: s + n] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period) and the
    collapsed text of every document.

    Words are runs of characters other than ASCII white space, known by 64-bit hashes.
    NULL and empty texts have no words and no runs, and collapse to the empty text.
    Repeated rows and rows with a NULL doc_id are rows of their own; other columns are
    ignored. No documents, no rows."""

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, texts in text_slices(batch.column("text")):
                texts = [t.encode("utf-8", "replace") for t in texts]
                found = runs_of_texts(texts)
                words = [t.split() for t in texts]
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
                texts = [collapsed(w, r).decode() for w, r in zip(words, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([len(w) for w in words], pa.int64()), pa.array(rows, kind), pa.array(texts, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    ddl = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ddl}")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in which a tenth of the texts are made periodic from some word on.

    With h = crc32(doc_id), g = h div 10 and n words: where h mod 10 = 0, word i >= a becomes
    word a + (i - a) mod p, for a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Other texts,
    and those of documents with a NULL doc_id, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w").cast("bigint"), F.expr("h DIV 10")
    with_a = chosen.withColumn("a", F.when(n > 0, g % n))
    with_p = with_a.withColumn("p", F.expr("1 + (size(w) - a) DIV (3 + (h DIV 10) % 8)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    periodic = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get("w", place(i).cast("int"))), " ")
    return with_p.select("doc_id", F.when(F.col("a").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """A row per document of ``periodic_runs``: n_runs, the longest run (ties: smallest start, then
    period; NULL for none), and digests of all runs and of the collapsed text."""

    def field(name: str) -> Column:
        return F.col(f"longest.{name}")

    # The struct that orders runs by length, then by the smaller start and period.
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.select("*", F.array_max(order).alias("longest"), F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").alias("lines")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-field("start")).alias("start"), field("length").alias("length"),
        (-field("period")).alias("period"), F.floor(1000 * field("length") / -field("period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
