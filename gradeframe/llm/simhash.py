"""SimHash near-duplicates: fingerprints, linked within a Hamming distance by vantage-point trees.

Documents with one fingerprint are one point, named by their smallest doc_id.
The top of a vantage-point tree, fitted on a bounded sample of points, deals all
points to shards (its leaves). A point also visits the later leaves that its
radius reaches: at a node with vantage ``v`` and split ``m``, points with
``d(p, v) <= m + r`` may have a partner inside, those with ``d(p, v) > m - r``
outside (triangle inequality). So every pair within the radius meets in a shard.
There the tree goes on as a recursive join; points within the radius of a vantage
are all linked through it and need no pairs among themselves. A shard returns a
spanning forest (at most one row a point), whose roots are joined to components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm.common import mix64, release, stored, text_slices
from gradeframe.llm.components import components

SEED = 42
#: Points of the sample that the top of the tree is fitted on; points a shard should hold.
SAMPLE, SHARD_POINTS = 16_384, 32_768
#: Pairs compared at once, and at most without a further split.
BLOCK, BRUTE = 1 << 20, 1 << 17


def fingerprint(text: str, words: int) -> int:
    """64-bit SimHash of the word shingles of a text (unsigned)."""
    tokens = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(tokens)
    if not n:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_digest
    if n <= words:
        return int.from_bytes(digest(joined, SEED), "big")
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[: n - words] + 1)).tolist()
    counts = np.zeros(64, np.int64)
    stops = ends[words - 1:].tolist()
    for a in range(0, len(starts), 65_536):
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[a: a + 65_536], stops[a: a + 65_536], strict=True)])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and its fingerprint as a signed long. NULL and wordless texts have fingerprint 0."""

    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t, words) for _, _, texts in text_slices(batch.column("text")) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """The top of a vantage-point tree; ``route`` deals points to its leaves."""

    def __init__(self, sample: np.ndarray, points: int, shard_points: int = SHARD_POINTS):
        self.leaves = 0
        self.root = self._grow(sample, max(1, len(sample) * shard_points // max(points, 1)))

    def _grow(self, x: np.ndarray, enough: int):
        if len(x) > max(enough, 8):
            # Of a few vantages the one that spreads the points most.
            tries = [x[i * len(x) // 8] for i in range(8)]
            v = max(tries, key=lambda t: distance(x, t).std())
            d = distance(x, v)
            m = int(np.median(d))
            inside = d <= m
            if inside.all():
                m -= 1
                inside = d <= m
            if inside.any() and not inside.all():
                return int(v), m, self._grow(x[inside], enough), self._grow(x[~inside], enough)
        self.leaves += 1
        return self.leaves - 1

    def route(self, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, leaf, whether it is the point's home) for home leaves and the later leaves visited."""
        home = np.zeros(len(x), np.int64)
        out: list[tuple[np.ndarray, int]] = []

        def go(node, rows, own):
            if not len(rows):
                return
            if isinstance(node, int):
                home[rows[own]] = node
                out.append((rows, node))
                return
            v, m, inner, outer = node
            d = distance(x[rows], np.uint64(v)).astype(np.int64)
            near, far = d <= m + radius, d > m - radius
            go(inner, rows[near], own[near] & (d[near] <= m))
            go(outer, rows[far], own[far] & (d[far] > m))

        go(self.root, np.arange(len(x)), np.ones(len(x), bool))
        point = np.concatenate([r for r, _ in out]) if out else np.zeros(0, np.int64)
        leaf = np.concatenate([np.full(len(r), k) for r, k in out]) if out else np.zeros(0, np.int64)
        keep = leaf >= home[point]
        point, leaf = point[keep], leaf[keep]
        return point, leaf, leaf == home[point]


class Forest:
    """Disjoint sets of points; linked by arrays of pairs."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        p = self.parent
        while len(a):
            a, b = p[a], p[b]
            differ = a != b
            a, b = a[differ], b[differ]
            if not len(a):
                return
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(p, high, low)
            while True:
                q = p[p]
                if np.array_equal(q, p):
                    break
                p[:] = q


def link_within(points: np.ndarray, home: np.ndarray, radius: int) -> np.ndarray:
    """Root (index) of each point when home points link to every point within the radius.

    Pairs of two visiting points are left to the shards where one is at home.
    """
    forest = Forest(len(points))

    def brute(a, b, same):
        step = max(1, BLOCK // max(1, len(b)))
        for i in range(0, len(a), step):
            j = i if same else 0
            d = distance(points[a[i: i + step], None], points[None, b[j:]])
            rows, cols = np.nonzero(d <= radius)
            if len(rows):
                forest.link(a[i + rows], b[j + cols])

    def across(a, b, depth=0):
        """Links between two sets."""
        if not len(a) or not len(b):
            return
        if len(a) * len(b) <= BRUTE or min(len(a), len(b)) <= 16 or depth > 48:
            return brute(a, b, False)
        larger = a if len(a) >= len(b) else b
        v = points[larger[mix64(np.array([len(larger) + depth]))[0] % np.uint64(len(larger))]]
        da, db = distance(points[a], v).astype(np.int64), distance(points[b], v).astype(np.int64)
        half = radius // 2
        core_a, core_b = da <= half, db <= half
        if core_a.any() and core_b.any():  # within the radius of each other by the triangle inequality
            ca, cb = a[core_a], b[core_b]
            forest.link(ca, np.full(len(ca), cb[0]))
            forest.link(cb, np.full(len(cb), ca[0]))
            reach = half + radius
            across(ca, b[~core_b & (db <= reach)], depth + 1)
            across(a[~core_a & (da <= reach)], cb, depth + 1)
            a, da, b, db = a[~core_a], da[~core_a], b[~core_b], db[~core_b]
            if not len(a) or not len(b):
                return None
        m = int(np.median(np.concatenate((da, db))))
        ia, ib = da <= m, db <= m
        if ia.all() and ib.all():
            m -= 1
            ia, ib = da <= m, db <= m
            if not ia.any() and not ib.any():
                return brute(a, b, False)
        across(a[ia], b[ib], depth + 1)
        across(a[~ia], b[~ib], depth + 1)
        across(a[ia & (da > m - radius)], b[~ib & (db <= m + radius)], depth + 1)
        across(a[~ia & (da <= m + radius)], b[ib & (db > m - radius)], depth + 1)
        return None

    def among(s, depth=0):
        """Links within a set."""
        if len(s) * len(s) <= 2 * BRUTE or depth > 64:
            return brute(s, s, True)
        v = points[s[mix64(np.array([len(s) + depth]))[0] % np.uint64(len(s))]]
        d = distance(points[s], v).astype(np.int64)
        ball = d <= radius  # holds the vantage itself
        forest.link(s[ball], np.full(int(ball.sum()), s[ball][0]) if not (d == 0).any() else np.full(int(ball.sum()), s[d == 0][0]))
        rest, dr = s[~ball], d[~ball]
        across(s[ball], rest[dr <= 2 * radius], depth + 1)
        if not len(rest):
            return None
        m = int(np.median(dr))
        inside = dr <= m
        if inside.all():
            m -= 1
            inside = dr <= m
            if not inside.any():
                return brute(rest, rest, True)
        among(rest[inside], depth + 1)
        among(rest[~inside], depth + 1)
        across(rest[inside & (dr > m - radius)], rest[~inside & (dr <= m + radius)], depth + 1)
        return None

    own, guests = np.flatnonzero(home), np.flatnonzero(~home)
    among(own)
    across(own, guests)
    return forest.parent


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, shard_points: int = SHARD_POINTS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links of ``radius`` or
    fewer differing bits. Needs doc_id and text; other columns are ignored. NULL,
    empty and wordless texts have fingerprint zero and link like any other.
    Repeated rows are rows of their own. A NULL doc_id names no component; such a
    row gets that of its fingerprint (NULL if only NULL ids have it, and then
    links nothing). No documents, no rows.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-points")
    sample = points.select("fp").where("rep is not null").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    tree = Tree(np.array([r["fp"] for r in sample], np.int64).view(np.uint64), points.count(), shard_points)

    def deal(batches):
        for batch in batches:
            fp, rep = batch.column("fp").to_numpy(), batch.column("rep").to_numpy()
            point, leaf, home = tree.route(fp.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(fp[point]), pa.array(rep[point]), pa.array(home)], names=["leaf", "fp", "rep", "home"])

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")  # so a root is the smallest doc_id of its set
        rep = rows["rep"].to_numpy()
        root = link_within(rows["fp"].to_numpy().view(np.uint64), rows["home"].to_numpy(bool), radius)
        linked = np.bincount(root, minlength=len(rep))[root] > 1
        return pd.DataFrame({"rep": rep[linked], "root": rep[root[linked]]})

    dealt = points.where("rep is not null").select("fp", F.col("rep").cast("bigint")).mapInArrow(deal, "leaf bigint, fp bigint, rep bigint, home boolean")
    found = stored(dealt.groupBy("leaf").applyInPandas(shard, "rep bigint, root bigint"), "fingerprint-links")
    # A point has one root in each shard it was dealt to: join the roots, not the points.
    roots = stored(found.groupBy("rep").agg(F.collect_set("root").alias("roots"), F.min("root").alias("root")), "fingerprint-roots")
    joined = roots.where(F.size("roots") > 1).select(F.explode("roots").alias("a"), F.col("root").alias("b"))
    classes = stored(components(joined), "fingerprint-classes")
    named = points.join(roots.select("rep", "root"), "rep", "left").join(classes, F.col("root") == F.col("node"), "left")
    named = stored(named.select("fp", F.coalesce("component", "root", "rep").alias("component_id")), "fingerprint-components")
    release(points, found, roots, classes)
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
