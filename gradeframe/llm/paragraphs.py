"""Substring dedup by paragraph MinHash banding.

Paragraphs are the lines of a text, short lines in a row (fewer than ``SHORT`` words each) taken
together; one of more than ``LONG`` words is cut
further at content-defined places: where the hash of two neighbouring words is the
smallest among ``NEAR`` words on either side. Beside them, whatever the line feeds, every
``WINDOW`` places in a row of a text hold an anchor: the ``GRAM`` words from the place of
smallest hash on. So any two passages of ``PASSAGE = GRAM + WINDOW - 1 = 50`` equal words share an anchor;
what anchors find counts from that length on. Anchors that repeat the same document at the
same shift and lie side by side are one run, compared and extended as a whole. Equal
runs, and equal paragraphs, are one class; distinct
paragraphs that share a MinHash band are verified by the exact Jaccard similarity
of their word shingles; classes are the components of the verified pairs. The
first occurrence (smallest doc_id, then place) of a class stays, the others go,
together with the words beside them that equal those beside the occurrence that
stays (up to ``CONTEXT`` on either side). Whole lines of together at least ``SHORT`` words always go; a
fragment inside a line stays if it adds up to fewer than ``LEAST`` words in a row.

``ROWS = 2`` hashes a band and ``BANDS = 5`` find a pair of Jaccard 0.8 with
probability 1 - (1 - 0.8**2)**5 = 0.994, one of 0.9 with 0.9998.

Texts are never gathered: a paragraph travels as a 64-bit key and its bands; only
candidates carry a second 64 bits (so a collision of keys joins nothing), and only
colliding ones shingles. Tables and shuffle files of finished steps are let go. Buckets of more than ``BUCKET``
distinct paragraphs are dealt as pairs of blocks, and a pair that is connected
already is not compared. One document is one task's row at most.

Rows are known by doc_id and text: rows equal in both are one document and get
the same result. NULL and empty texts and texts of fewer than ``SHORT`` words
stay as they are, other columns pass through, a NULL doc_id comes before others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm.common import _powers, apart, mix64, release, slices, stored, text_slices, word_edges, word_spans
from gradeframe.llm.components import components

SHORT, LONG, NEAR = 9, 40, 8
GRAM, WINDOW = 25, 26
PASSAGE = GRAM + WINDOW - 1
WORDS, SIMILARITY = 5, 0.8
ROWS, BANDS = 2, 5
CONTEXT = 32
LEAST = 25
BUCKET = 256
FEW = 8

_BANDS = [f"band{k}" for k in range(BANDS)]
_MIX = mix64(np.arange(1, 64, dtype=np.uint64))
_ODD = mix64(np.arange(101, 101 + ROWS * BANDS, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Hash of the ``words`` words from each word on (for all but the last few)."""
    n = len(hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(words):
        out += hashes[k: n + k] * (_MIX[k] | np.uint64(1))
    return mix64(out)


def paragraph_starts(buf: np.ndarray, starts: np.ndarray, hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Index of the first word of each paragraph."""
    first = np.union1d(0, np.searchsorted(starts, np.flatnonzero(buf == 10)))  # behind line feeds
    first = first[first < len(starts)]
    short = np.diff(first, append=len(starts)) < SHORT
    joined = short[1:] & short[:-1] & (text[first[1:]] == text[first[:-1]])
    first = first[np.concatenate(([True], ~joined))]
    length = np.diff(first, append=len(starts))
    row = np.repeat(np.arange(len(first)), length)
    h = np.full(len(starts), 2**64 - 1, np.uint64)
    h[1:] = mix64(hashes[:-1] * np.uint64(3) + hashes[1:])
    h[first] = 2**64 - 1  # pairs over two paragraphs count for nothing
    is_cut = length[row] > LONG
    is_cut[first] = False
    for d in range(1, NEAR + 1):
        inside = row[d:] == row[:-d]
        is_cut[d:] &= (h[d:] < h[:-d]) | ~inside
        is_cut[:-d] &= (h[:-d] <= h[d:]) | ~inside
    return np.union1d(first, np.flatnonzero(is_cut)).astype(np.int64)


def anchor_places(grams: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places whose hash is the smallest (the first such) of some ``WINDOW`` places in a row.

    ``whole``: which places hold ``GRAM`` words of one text; there are at least ``GRAM - 1`` others between texts.
    Where few words repeat at once (places of one hash follow each other closely), some are left out:
    every window still holds one of that hash."""
    n = len(grams)
    h = np.where(whole, grams, np.uint64(2**64 - 1))
    span = np.ones(n, np.int16)  # places in a row, this one among them, over which it is the smallest
    left, right = whole.copy(), whole.copy()
    for d in range(1, WINDOW):
        left[d:] &= h[:-d] > h[d:]
        right[:-d] &= h[d:] >= h[:-d]
        span += left
        span += right
    places = np.flatnonzero(whole & (span >= WINDOW))
    if not len(places):
        return places
    again = np.zeros(len(places), bool)
    again[1:] = (h[places[1:]] == h[places[:-1]]) & (np.diff(places) <= WINDOW // 2)
    start = np.maximum.accumulate(np.where(again, 0, np.arange(len(places))))
    step = (places - places[start]) // (WINDOW // 2)
    keep = ~again
    keep[1:] |= step[1:] != step[:-1]
    keep[:-1] |= ~again[1:]
    keep[-1] = True
    return places[keep]


def sequence_hashes(hashes: np.ndarray, begin: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the words from each ``begin`` to the next."""
    power, inverse = _powers(len(hashes))
    n = np.diff(begin, append=len(hashes)).astype(np.uint64)
    return mix64(np.add.reduceat(mix64(hashes ^ _MIX[salt]) * power[: len(hashes)], begin) * inverse[begin] + n)


def range_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the words of each range."""
    if not len(first):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(hashes))
    weighed = np.append(mix64(hashes ^ _MIX[salt]) * power[: len(hashes)], np.uint64(0))
    sums = np.add.reduceat(weighed, np.stack((first, last), 1).ravel())[::2]
    return mix64(sums * inverse[first] + (last - first).astype(np.uint64))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, h, first (word), n (words), key, a column for each band of paragraphs of at least ``SHORT`` words."""

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column("text")):
                buf, _, starts, _, text, hashes = word_spans([t.encode("utf-8", "replace") for t in texts])
                if len(starts) < SHORT:
                    continue
                begin = paragraph_starts(buf, starts, hashes, text)
                n = np.diff(begin, append=len(starts))
                keys = sequence_hashes(hashes, begin, 20).view(np.int64)
                of = np.repeat(np.arange(len(begin)), n)
                s = shingle_hashes(hashes)
                inner = of[: len(s)] == of[WORDS - 1:]
                s, s_of = s[inner], of[: len(inner)][inner]
                good = np.flatnonzero(n >= SHORT)
                at = np.searchsorted(s_of, good)
                ends = np.searchsorted(s_of, good, "right")
                # reduceat over (begin, end) pairs; only the even results are wanted
                edges = np.stack((at, ends), 1).ravel()
                padded = np.append(s, np.uint64(0))
                lows = [np.minimum.reduceat(padded * o, edges)[::2] for o in _ODD] if len(good) else [np.zeros(0, np.uint64)] * (ROWS * BANDS)
                bands = [mix64(mix64(lows[2 * k]) * np.uint64(5) + mix64(lows[2 * k + 1]) + _MIX[30 + k]) for k in range(BANDS)]
                first_word = np.searchsorted(text, np.arange(b - a))
                own = text[begin[good]]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a).take(pa.array(own)), batch.column("h").slice(a, b - a).take(pa.array(own)),
                    pa.array((begin[good] - first_word[own]).astype(np.int32)), pa.array(n[good].astype(np.int32)),
                    pa.array(keys[good]), *(pa.array(x.view(np.int64)) for x in bands),
                ], names=["doc_id", "h", "first", "n", "key", *_BANDS])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h bigint, first int, n int, key bigint, {', '.join(f'{x} bigint' for x in _BANDS)}")


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, h, first (word), n (words), key of the anchors of all texts."""

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column("text")):
                *_, text, hashes = word_spans([t.encode("utf-8", "replace") for t in texts])
                if len(hashes) < GRAM:
                    continue
                grams = shingle_hashes(hashes, GRAM)
                places = anchor_places(grams, text[: len(grams)] == text[GRAM - 1:])
                own = text[places]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a).take(pa.array(own)), batch.column("h").slice(a, b - a).take(pa.array(own)),
                    pa.array((places - np.searchsorted(text, np.arange(b - a))[own]).astype(np.int32)), pa.array(np.full(len(places), GRAM, np.int32)),
                    pa.array(mix64(grams[places] ^ _MIX[40]).view(np.int64)),
                ], names=["doc_id", "h", "first", "n", "key"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h bigint, first int, n int, key bigint")


def covered(doc, first, end, both, kept, shift) -> np.ndarray:
    """Whether the words before (first column) and after each item are removed by another item for sure:
    by one of the same document that repeats the same occurrence (``kept``, ``shift``). Arrays, a row an item."""
    out = np.zeros((len(doc), 2), bool)
    rows = np.flatnonzero(~both)
    _, line = np.unique(np.stack((doc[rows], kept[rows], shift[rows])), axis=1, return_inverse=True)
    for side, (near, far) in enumerate(((first[rows], end[rows]), (-end[rows], -first[rows]))):
        order = np.lexsort((near, line))
        group, far = line[order], far[order]
        base = far.min(initial=0)
        step = int(far.max(initial=0) - base) + 1
        reach = np.maximum.accumulate(far - base + group * step) - group * step + base  # how far a line's items go so far
        held = (group[1:] == group[:-1]) & (reach[:-1] >= near[order][1:])
        out[rows[order[1:]][held], side] = True
    return out


def _packed(values: np.ndarray, first: np.ndarray, size: np.ndarray, back: bool = False) -> pa.Array:
    """``size`` 32-bit values from each ``first`` on (or back from it), as bytes: one value of a row, not one for each word."""
    edges = np.concatenate(([0], np.cumsum(size)))
    step = np.arange(edges[-1]) - np.repeat(edges[:-1], size)
    at = np.repeat(first, size) + (-step if back else step)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(values[at])])


def details(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Second hash, shingles (of probes) and word contexts of wanted paragraphs.

    ``wanted``: doc_id, h, items (first, n, key, anchor, probe, both, kept, shift, stay: the key's first place). A side has no context
    only where another paragraph repeats the words there from the same occurrence (``kept``, at
    the same ``shift``) and removes them itself; what may stay or change class (``both``) has both."""
    joined = docs.join(wanted, (docs["doc_id"].eqNullSafe(wanted["doc_id"])) & (docs["h"] == wanted["h"])).select(docs["doc_id"], docs["h"], "text", "items")

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column("text")):
                items = batch.column("items").slice(a, b - a)
                *_, text, hashes = word_spans([t.encode("utf-8", "replace") for t in texts])
                begin = np.searchsorted(text, np.arange(len(texts) + 1))
                short = (hashes & np.uint64(0x7FFFFFFF)).astype(np.int32)
                shingles = shingle_hashes(hashes)
                doc = np.repeat(np.arange(b - a), items.value_lengths().to_numpy())
                flat = items.flatten()
                get = lambda name: flat.field(name).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                p, n = get("first").astype(np.int64), get("n").astype(np.int64)
                beside = covered(doc, p, p + n, get("both"), get("kept"), get("shift").astype(np.int64))
                first, last = begin[doc] + p, begin[doc] + p + n
                before = np.where(beside[:, 0], 0, np.minimum(p, CONTEXT))
                after = np.where(beside[:, 1], 0, np.minimum(begin[doc + 1] - last, CONTEXT))
                probe = get("probe")
                found = [np.unique(shingles[x: y - WORDS + 1]).view(np.int64) if k else None for x, y, k in zip(first.tolist(), last.tolist(), probe.tolist(), strict=True)]
                rows = pa.array(a + doc)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(rows), batch.column("h").take(rows), flat.field("first"), flat.field("n"), flat.field("key"),
                    pa.array(range_hashes(hashes, first, last, 21).view(np.int64)), flat.field("anchor"), flat.field("stay"), pa.array(found, pa.list_(pa.int64())),
                    _packed(short, first - 1, before, back=True), _packed(short, last, after),
                ], names=["doc_id", "h", "first", "n", "key", "check", "anchor", "stay", "shingles", "before", "after"])

    return joined.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h bigint, first int, n int, key bigint, check bigint, anchor boolean, stay boolean, shingles array<bigint>, before binary, after binary")


def collisions(keys: DataFrame) -> DataFrame:
    """(band, key, size): the rows of bands that several keys (key and its bands; one row a key) share."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the band that may go on

        def shared(band, key):
            edge = np.flatnonzero(np.diff(band, prepend=band[:1] - 1))
            size = np.diff(edge, append=len(band))
            many = np.repeat(size > 1, size)
            return pa.RecordBatch.from_arrays([pa.array(band[many]), pa.array(key[many]), pa.array(np.repeat(size, size)[many])], names=["band", "key", "size"])

        for batch in batches:
            band, key = batch.column("band").to_numpy(), batch.column("key").to_numpy()
            if not len(band):
                continue
            cut = int(np.searchsorted(band, band[-1]))
            if cut or held and held[-1][0][-1] != band[-1]:
                yield shared(*(np.concatenate(x) for x in zip(*held, (band[:cut], key[:cut]), strict=True)))
                held = []
            held.append((band[cut:], key[cut:]))
        if held:
            yield shared(*(np.concatenate(x) for x in zip(*held, strict=True)))

    rows = keys.select("key", F.explode(F.array(*_BANDS)).alias("band"))
    return rows.repartition("band").sortWithinPartitions("band").mapInArrow(run, "band bigint, key bigint, size bigint")


def _similar_few(sets: list[set[int]], side: list[bool], two: bool) -> list[tuple[int, int]]:
    """``_similar`` by comparing each pair: for a few sets, array functions cost more in calls than in work."""
    n = len(sets)
    label, out = list(range(n)), []
    for i in range(n):
        for j in range(i + 1, n):
            if label[i] == label[j] or two and side[i] == side[j]:
                continue
            common = len(sets[i] & sets[j])
            if common >= SIMILARITY * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                out.append((i, j))
                label = [label[i] if x == label[j] else x for x in label]
    return out


def _similar(sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """A forest of the pairs with Jaccard >= SIMILARITY; with two sides, pairs across them only."""
    n = len(sets)
    two = side.any() and not side.all()
    if n <= FEW:
        return _similar_few([set(x.tolist()) for x in sets], side.tolist(), two)
    label, out = np.arange(n), []
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    of = np.repeat(np.arange(n), sizes)
    # Members by shingle: counting the members of one set's shingles gives all its intersections.
    order = np.argsort(ids, kind="stable")
    where = np.searchsorted(ids[order], np.arange(ids.max() + 2))
    members, begin = of[order], np.concatenate(([0], np.cumsum(sizes)))
    for i in range(n):
        if (label == label[i]).all():
            continue
        own = ids[begin[i]: begin[i + 1]]
        near = np.concatenate([members[where[k]: where[k + 1]] for k in own])
        near = near[(near > i) & (label[near] != label[i])]
        if not len(near):
            continue
        j, common = np.unique(near, return_counts=True)
        j = j[common >= SIMILARITY * (sizes[i] + sizes[j] - common) - 1e-9]
        for x in (j[side[j] != side[i]] if two else j).tolist():
            if label[x] != label[i]:
                out.append((i, x))
                label[label == label[x]] = label[i]
    return out


def verified(shared: DataFrame, probes: DataFrame) -> DataFrame:
    """Links (a, b) between keys that share a band and are similar enough.

    ``shared``: band, key, size; ``probes``: key, shingles, one row a key."""
    blocks = F.ceil(F.col("size") / BUCKET).cast("int")
    dealt = shared.join(probes, "key").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    # Every pair of blocks of a bucket is a task: a block takes part once beside each block.
    dealt = dealt.select("band", "key", "shingles", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("band", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), (F.col("block") > F.col("other")).alias("second"), "key", "shingles")

    def run(batches):
        held: list = []
        at = None

        def flush():
            keys = [k for k, _, _ in held]
            pairs = _similar([s for _, _, s in held], np.array([w for _, w, _ in held], bool)) if len(held) > 1 else []
            return [(keys[i], keys[j]) for i, j in pairs]

        out: list = []
        for batch in batches:
            values = batch.column("shingles")
            flat, offsets = values.values.to_numpy(), values.offsets.to_numpy()
            for r, (band, x, y, second, key) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("band", "x", "y", "second", "key")), strict=True)):
                if (band, x, y) != at:
                    out += flush()
                    held, at = [], (band, x, y)
                held.append((key, second, flat[offsets[r]: offsets[r + 1]].copy()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
                out = []
        out += flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return dealt.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y").mapInArrow(run, "a bigint, b bigint").distinct()


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of ``_packed`` values: all 32-bit values, where each row's begin, and how many it has."""
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int32)[column.offset: column.offset + len(column) + 1]
    values = np.frombuffer(data or b"", np.int32, int(edges[-1]) // 4)
    return values, edges[:-1] // 4, np.diff(edges) // 4


def common_prefix(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Length of the common prefix of each row's two sequences (``_packed``)."""
    (x, x_at, x_size), (y, y_at, y_size) = _words(a), _words(b)
    most = np.minimum(x_size, y_size)
    out = np.zeros(len(a), np.int32)
    rows, k = np.flatnonzero(most > 0), 0
    while len(rows):
        rows = rows[x[x_at[rows] + k] == y[y_at[rows] + k]]
        k += 1
        out[rows] = k
        rows = rows[most[rows] > k]
    return out


def extended(pairs: DataFrame) -> DataFrame:
    """doc_id, h, first, last (exclusive), kept_doc_id of repeats with the equal words beside them.

    ``pairs``: doc_id, h, first, n, before, after, kept_before, kept_after, kept_doc_id, anchor and
    gap (words back to the occurrence that stays, if in the same document). Anchors that come to fewer than ``PASSAGE`` words are left out."""

    def run(batches):
        for batch in batches:
            first, n = (batch.column(c).to_numpy() for c in ("first", "n"))
            back = common_prefix(batch.column("before"), batch.column("kept_before"))
            gap = pc.fill_null(batch.column("gap"), CONTEXT).to_numpy()
            last = first + n + common_prefix(batch.column("after"), batch.column("kept_after"))
            first = first - np.minimum(back, gap)
            good = ~batch.column("anchor").to_numpy(zero_copy_only=False) | (last - first >= PASSAGE)
            rows = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(rows), batch.column("h").take(rows), pa.array(first[good].astype(np.int32)), pa.array(last[good].astype(np.int32)),
                batch.column("kept_doc_id").take(rows)], names=["doc_id", "h", "first", "last", "kept_doc_id"])

    kind = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(run, f"doc_id {kind}, h bigint, first int, last int, kept_doc_id {kind}")


def anchor_runs(marks: DataFrame) -> DataFrame:
    """(doc_id, h, item) of runs of repeated anchors and of what they repeat, as ``details`` reads them.

    A run's key is that of the range it repeats. In its own document every anchor is a run."""
    place = F.struct("doc_id", "h", "first")
    # Stored, so that both sides of the join are plain shuffles and Spark can split the key of a common passage.
    repeated = marks.groupBy("key").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("key", "place")
    repeated = stored(repeated, "anchors-repeated")
    again = marks.join(repeated, "key").where(~place.eqNullSafe(F.col("place")))
    lines = again.groupBy("doc_id", "h", F.col("place.doc_id").alias("kept_id"), F.col("place.h").alias("kept_h"), (F.col("place.first") - F.col("first")).alias("shift"))
    lines = lines.agg(F.sort_array(F.collect_set("first")).alias("at"))
    own = F.struct("doc_id", "h").eqNullSafe(F.struct("kept_id", "kept_h"))
    # Starts are first anchors, and those that no anchor before touches; likewise ends.
    starts = F.filter("at", lambda x, i: (i == 0) | own | (x - F.get("at", i - 1) > GRAM))
    ends = F.filter("at", lambda x, i: (i == F.size("at") - 1) | own | (F.get("at", i + 1) - x > GRAM))
    runs = lines.select("doc_id", "h", "kept_id", "kept_h", "shift", F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("run"))
    runs = runs.select("doc_id", "h", "kept_id", "kept_h", F.col("run.a").alias("first"), (F.col("run.b") - F.col("run.a") + GRAM).alias("n"), (F.col("run.a") + F.col("shift")).alias("kept_first"))
    runs = stored(runs.withColumn("key", F.xxhash64("kept_id", "kept_h", "kept_first", "n")), "anchor-runs")
    release(repeated)
    kept = runs.select(F.col("kept_id").alias("doc_id"), F.col("kept_h").alias("h"), F.col("kept_first").alias("first"), "n", "key").distinct()
    rows = runs.select("doc_id", "h", "first", "n", "key", F.lit(False).alias("stay")).unionByName(kept.withColumn("stay", F.lit(True)))
    no, yes = F.lit(False), F.lit(True)
    return rows.select("doc_id", "h", F.struct("first", "n", "key", yes.alias("anchor"), no.alias("probe"), yes.alias("both"), F.lit(0).cast("bigint").alias("kept"), F.lit(0).alias("shift"), "stay").alias("item"))


def holders(found: DataFrame, candidates: DataFrame) -> DataFrame:
    """(doc_id, h, item) of each place in ``found`` of a candidate (key, place, probe), as ``details`` reads them."""
    here = found.select("doc_id", "h", "first", "n", "key").join(candidates, "key")
    own = F.struct("doc_id", "h").eqNullSafe(F.struct("place.doc_id", "place.h"))
    stay = F.struct("doc_id", "h", "first").eqNullSafe(F.col("place"))
    probe = F.col("probe") & stay
    return here.select("doc_id", "h", F.struct(
        "first", "n", "key", F.lit(False).alias("anchor"), probe.alias("probe"), (F.col("probe") | own).alias("both"),
        F.xxhash64("place.doc_id", "place.h").alias("kept"), (F.col("place.first") - F.col("first")).alias("shift"), stay.alias("stay")).alias("item"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Word ranges to remove: doc_id, h, first, last (exclusive), kept_doc_id.

    ``docs``: doc_id, text (not NULL), h (a hash of the text)."""
    place = F.struct("doc_id", "h", "first")
    marks = stored(anchors(docs), "anchors")
    held = stored(anchor_runs(marks), "anchor-holders")
    release(marks)
    found = stored(paragraphs(docs), "paragraphs")
    keys = stored(found.groupBy("key").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("copies"), *(F.first(x).alias(x) for x in _BANDS)), "paragraph-keys")
    shared = stored(collisions(keys), "paragraph-bands")
    near = shared.select("key").distinct().withColumn("probe", F.lit(True))
    candidates = keys.join(near, "key", "left").where("copies > 1 or probe").select("key", "place", F.coalesce("probe", F.lit(False)).alias("probe"))
    candidates = stored(candidates, "paragraph-candidates")
    release(keys)
    wanted = holders(found, candidates).unionByName(held)
    wanted = stored(wanted.groupBy("doc_id", "h").agg(F.collect_list("item").alias("items")), "paragraph-wanted")
    release(found, candidates, held)
    detail = stored(details(docs, wanted), "paragraph-details")
    release(wanted)

    probes = detail.where("shingles is not null").dropDuplicates(["key"]).select("key", "shingles")
    links = stored(verified(shared, probes), "paragraph-links")
    release(shared)
    classes = stored(components(links), "paragraph-classes")
    member = detail.select("doc_id", "h", "first", "n", "key", "check", "anchor", "stay", "before", "after").join(classes, F.col("key") == F.col("node"), "left")
    # Equal paragraphs agree in both hashes; similar ones are one class by their component.
    same = F.when(F.col("component").isNull(), F.col("check"))
    member = member.select("doc_id", "h", "first", "n", F.coalesce("component", "key").alias("class"), same.alias("check"), "anchor", "stay", "before", "after")
    # The smallest place of a class stays: that of one of its keys, so only their first places are compared.
    whole = F.struct("doc_id", "h", "first", "n", "before", "after")
    kept = member.where("stay").groupBy("class", "check").agg(F.min(whole).alias("kept")).select(F.col("class").alias("_class"), F.col("check").alias("_check"), "kept")
    kept = stored(kept, "paragraph-kept")
    release(links)
    match = (F.col("class") == F.col("_class")) & F.col("check").eqNullSafe(F.col("_check"))
    pairs = member.join(kept, match)
    pairs = pairs.where(~F.struct("doc_id", "h", "first").eqNullSafe(F.struct("kept.doc_id", "kept.h", "kept.first")))
    # In its own document a repeat does not reach back into the occurrence that stays.
    here = F.struct("doc_id", "h").eqNullSafe(F.struct("kept.doc_id", "kept.h"))
    gap = F.when(here, F.col("first") - F.col("kept.first") - F.col("kept.n"))
    pairs = pairs.where(F.coalesce(gap, F.lit(0)) >= 0)
    sides = [(side, F.substring(side, 1, 4) == F.substring(f"kept.{side}", 1, 4)) for side in ("before", "after")]  # the word next to it
    sides = [F.when(same, F.col(x)).otherwise(F.lit(b"")).alias(y) for side, same in sides for x, y in ((side, side), (f"kept.{side}", f"kept_{side}"))]
    pairs = pairs.select("doc_id", "h", "first", "n", *sides, F.col("kept.doc_id").alias("kept_doc_id"), "anchor", gap.alias("gap"))
    spans = stored(extended(pairs), "paragraph-spans")
    release(detail, kept, classes)
    return spans


def without(text: str, spans: list[tuple[int, int]], least: int = 1) -> tuple[str, np.ndarray]:
    """The text without word ranges (and the blanks after them), and which words are gone.

    Of ranges that together cover fewer than ``least`` words in a row, only whole
    lines go, if these hold ``SHORT`` words or more."""
    data = text.encode("utf-8", "surrogatepass")
    buf, starts, ends = word_edges(data)
    opens = None
    gone = np.zeros(len(starts), bool)
    for a, b in spans:
        gone[max(a, 0): b] = True
    edge = np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))
    out, at = [], 0
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        if b - a < least:
            gone[a:b] = False
            if opens is None:  # first words of lines
                line = np.searchsorted(np.flatnonzero(buf == 10), starts)
                opens = np.append(np.flatnonzero(np.diff(line, prepend=-1)), len(starts))
            a, b = (int(x) for x in opens[[np.searchsorted(opens, a), np.searchsorted(opens, b, "right") - 1]])
            if b - a < SHORT:
                continue
            gone[a:b] = True
        out.append(data[at: starts[a]])
        at = int(ends[b - 1])
        while at < len(data) and data[at] in b" \t":
            at += 1
    out.append(data[at:])
    kept = b"".join(out).decode("utf-8", "surrogatepass")
    return "\n".join(x for x in kept.split("\n") if x.strip()) if gone.any() else text, gone


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any others) with repeated paragraphs removed from the texts.

    Adds ``removed_words`` (int) and ``duplicate_of`` (sorted doc_ids that keep what
    was removed; the document itself if it repeats its own words); columns of
    these names are replaced. Nothing else of a row changes, whatever its columns are called."""
    docs, names = apart(docs.drop("removed_words", "duplicate_of"), ("doc_id", "text"))
    rest = docs.columns
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    spans = repeated_spans(keyed)
    lists = spans.groupBy("doc_id", "h").agg(F.collect_list(F.struct("first", "last", "kept_doc_id")).alias("_spans"))
    lists = lists.withColumnRenamed("doc_id", "_id").withColumnRenamed("h", "_h")
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == lists["_h"]), "left").drop("_id", "_h")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", removed_words int, duplicate_of array<{kind}>"

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for a, b in slices(sizes):
                part, removed, kept, new = batch.slice(a, b - a), [], [], []
                text, lists = part.column("text"), part.column("_spans")
                flat, at = lists.flatten(), 0
                first, last = (np.maximum(flat.field(c).to_numpy(), 0) for c in ("first", "last"))
                keeper = flat.field("kept_doc_id").to_pylist()
                for i, n in enumerate(pc.list_value_length(lists).to_pylist()):
                    if n is None:
                        removed.append(0)
                        kept.append([])
                        continue
                    own, at = slice(at, at + n), at + n  # there is a text
                    changed, gone = without(text[i].as_py(), list(zip(first[own].tolist(), last[own].tolist(), strict=True)), LEAST)
                    new.append(changed)
                    so_far = np.concatenate(([0], np.cumsum(gone)))  # words gone before each
                    hit = so_far[np.minimum(last[own], len(gone))] > so_far[np.minimum(first[own], len(gone))]
                    removed.append(int(so_far[-1]))
                    kept.append(sorted({x for x, y in zip(keeper[own], hit.tolist(), strict=True) if y}, key=lambda x: (x is not None, x)))
                text = pc.replace_with_mask(text, lists.is_valid(), pa.array(new, text.type)) if new else text
                columns = [text if c == "text" else part.column(c) for c in rest]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int32()), pa.array(kept, pa.list_(part.column("doc_id").type))], names=[*rest, "removed_words", "duplicate_of"])

    out = joined.mapInArrow(run, schema)
    return out.toDF(*[names.get(c, c) for c in out.columns])
