"""Removal of repeated byte strings by enhanced suffix arrays of their surroundings.

Every 200-byte window of every text is a suffix cut at 200 bytes. A window is dealt by its
anchor, the 64-byte gram of smallest hash in it: equal windows have equal anchors at the
same place, so a repeat never spans two anchors. Neighbouring windows mostly share an
anchor; those of one anchor are a *piece* of text, and equal pieces are one, with a
number of copies (combined before the shuffle). Only pieces whose anchor occurs twice go on.

The pieces of an anchor meet in one task. There a suffix array of their windows with
longest common prefixes and preceding bytes is scanned with a stack: the intervals
of the common-prefix tree from 200 bytes on whose members are preceded by different bytes
are the maximal repeats, each with all its occurrences. (What always follows the same byte
is part of the repeat that starts there.) An anchor with many different pieces, as at
the edge of a passage that many documents share, is split first: its windows are dealt in
halves by the anchor's place in them, which gives each half a longer common core and
smaller pieces that again are combined, until a group is small or its core is the window.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe.llm.common import mix64, release, slices, stored

#: Bytes of a repeat and of an anchor, different pieces that a group may have, and bytes of pieces in one suffix array.
LENGTH, GRAM, GROUP, CHUNK = 200, 64, 2048, 1 << 21
#: Bytes of text that one numpy pass works on, and windows of a longer text at once.
PASS, SEGMENT = 1 << 20, 1 << 22
#: Places are packed into the low bits of a hash, so that the first of equal minima wins.
_LOW = np.uint64((1 << 24) - 1)
_BASES = 0x100000001B3, 0x9E3779B97F4A7C15
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(max(n, PASS + SEGMENT // 2), b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _TABLES[base] = out[0], out[1]
    return _TABLES[base]


class _Sums:
    """Hashes of any ranges of a buffer, from sums of byte * base ** place."""

    def __init__(self, buf: np.ndarray, base: int):
        power, self.inverse = _powers(base, len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def pieces_of(texts: list[bytes], length: int, gram: int):
    """Pieces of several texts: (text, first window, windows, place of the anchor after it, anchor's hash, piece's hash)."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(sizes)))
    if len(buf) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    sums = _Sums(buf, _BASES[0])
    at = np.arange(len(buf) - gram + 1)
    least = (sums.hashes(at, at + gram) & ~_LOW) | at.astype(np.uint64)
    span, width = 1, length - gram + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span:])
    anchor = (least & _LOW).astype(np.int64)  # of each window of the buffer
    left = np.repeat(begins[1:] - length, sizes)[: len(anchor)] - np.arange(len(anchor))
    whole = left >= 0  # windows that lie in one text
    new = whole.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1] | (left[:-1] == 0)
    first = np.flatnonzero(new)
    end = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True)) + 1
    text = np.searchsorted(begins, first, "right") - 1
    anchored = anchor[first]
    core = sums.hashes(anchored, anchored + gram)
    piece = _Sums(buf, _BASES[1]).hashes(first, end - 1 + length)
    return text, first - begins[text], end - first, anchored - first, core, piece


PIECES = "uid bigint, at bigint, windows int, anchor int, core bigint, piece bigint"


def pieces(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The pieces of every text (uid, body)."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches):
        for batch in batches:
            uids, bodies = batch.column("uid").to_numpy(), batch.column("body")
            sizes = [len(b.as_buffer()) if b.is_valid else 0 for b in bodies]
            for a, b in slices(sizes, PASS):
                part, owner, offset = [], [], []
                for i in range(a, b):
                    if sizes[i] < length:
                        continue
                    body = bodies[i].as_py()
                    for s in range(0, sizes[i] - length + 1, SEGMENT):  # windows of a very long text
                        part.append(body[s: s + SEGMENT + length - 1] if sizes[i] > SEGMENT else body)
                        owner.append(uids[i])
                        offset.append(s)
                        if len(part[-1]) > PASS or len(part) == 1 << 14:
                            yield from found(part, owner, offset)
                            part, owner, offset = [], [], []
                yield from found(part, owner, offset)

    def found(part, owner, offset):
        if part:
            text, first, windows, anchor, core, piece = pieces_of(part, length, gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(owner)[text]), pa.array(first + np.array(offset)[text]), pa.array(windows.astype(np.int32)),
                 pa.array(anchor.astype(np.int32)), pa.array(core.view(np.int64)), pa.array(piece.view(np.int64))], names=names)

    return texts.mapInArrow(run, PIECES)


class SuffixArray:
    """Suffix array, common prefixes and preceding bytes of the windows of several pieces that occur twice.

    ``at``: places in the joined pieces in order of what follows them in their piece;
    ``common``: bytes shared with the next one; ``before``: the byte before (its own for the first of a piece)."""

    def __init__(self, bodies: list[bytes], length: int):
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
        self.begins = np.concatenate(([0], np.cumsum(sizes + 1)))
        buf = np.frombuffer(b"\0".join(bodies) + b"\0" * (2 * length + 8), np.uint8).copy()
        inside = np.ones(len(buf), bool)
        inside[self.begins[1:] - 1] = False
        inside[self.begins[-1]:] = False
        buf[inside] += 1  # no UTF-8 text holds byte 255, so 0 is left for the end of a piece
        place = np.concatenate([np.arange(b, b + n - length + 1) for b, n in zip(self.begins, sizes, strict=False)])
        # Ranks of what follows each place, 8 bytes first, then doubled; zeros follow the last place.
        n = int(self.begins[-1])
        word = np.zeros(n, np.uint64)
        for k in range(8):
            word = (word << np.uint64(8)) | buf[k: k + n]
        self.buf, self.ranks, h = buf, {8: self._rank(word)}, 8
        while h * 2 <= length:
            r = self.ranks[h]
            self.ranks[2 * h] = self._rank(r.astype(np.uint64) << np.uint64(32) | self._at(r, np.arange(n) + h).astype(np.uint64))
            h *= 2
        self.top = h
        r = self.ranks[h]
        whole = r[place].astype(np.uint64) << np.uint64(32) | self._at(r, place + length - h).astype(np.uint64)
        _, which, count = np.unique(whole, return_inverse=True, return_counts=True)
        twice = count[which] > 1
        place, which = place[twice], which[twice]
        keys = [self._at(r, place + k) for k in range(h * ((int(sizes.max(initial=0)) - 1) // h), -1, -h)]
        order = np.lexsort((place, *keys)) if len(place) else np.zeros(0, np.int64)
        self.at = place[order]
        self.owner = np.searchsorted(self.begins, self.at, "right") - 1
        rest = self.begins[self.owner + 1] - 1 - self.at
        self.common = np.minimum(self._common(self.at[:-1], self.at[1:], int(sizes.max(initial=0))), np.minimum(rest[:-1], rest[1:]))
        first = self.at == self.begins[self.owner]
        self.before = np.where(first, -1 - np.arange(len(first)), buf[self.at - 1])

    @staticmethod
    def _rank(keys: np.ndarray) -> np.ndarray:
        return np.unique(keys, return_inverse=True)[1].astype(np.uint32)

    @staticmethod
    def _at(r: np.ndarray, i: np.ndarray) -> np.ndarray:
        return np.where(i < len(r), r[np.minimum(i, len(r) - 1)], 0)

    def _common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Bytes that agree from places a and b on (past the end of a piece, at least as many as in it)."""
        out = np.zeros(len(a), np.int64)
        steps = [self.top] * (most // self.top) + [h for h in sorted(self.ranks, reverse=True) if h < self.top]
        for h in steps:
            r = self.ranks[h]
            i, j = a + out, b + out
            out += h * ((np.maximum(i, j) < len(r)) & (self._at(r, i) == self._at(r, j)))
        going = np.ones(len(a), bool)
        for _ in range(8):
            going &= self.buf[np.minimum(a + out, len(self.buf) - 1)] == self.buf[np.minimum(b + out, len(self.buf) - 1)]
            out += going
        return out

    def intervals(self, length: int):
        """(bytes, first, last member in suffix order) of the maximal repeats of at least ``length`` bytes.

        A scan of the common prefixes with a stack gives the intervals of the common-prefix
        tree; those whose members are all preceded by the same byte are left out."""
        change = np.concatenate(([0], np.cumsum(self.before[1:] != self.before[:-1])))  # equal at both ends: one byte
        edges = np.flatnonzero(np.concatenate(([True], self.common < length, [True])))
        for lo, hi in zip(edges[:-1].tolist(), (edges[1:] - 1).tolist(), strict=True):
            if hi <= lo or change[lo] == change[hi]:
                continue
            stack: list[tuple[int, int]] = []
            common = self.common[lo:hi].tolist()
            for i, c in enumerate([*common, 0], lo):
                start = i
                while stack and stack[-1][0] > c:
                    size, start = stack.pop()
                    if change[start] != change[i]:
                        yield size, start, i
                if c and (not stack or stack[-1][0] < c):
                    stack.append((c, start))


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)



def repeats_within(bodies: list[bytes], copies: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """For each piece of text, (group, start, bytes) of the maximal repeats in it.

    A piece with several copies is a repeat as a whole. Groups are named by their text's hash."""
    out: list[list[tuple[int, int, int]]] = [[(_hash(b), 0, len(b))] if n > 1 else [] for b, n in zip(bodies, copies, strict=True)]
    if len(bodies) > 1:
        s = SuffixArray(bodies, length)
        owner, start = s.owner.tolist(), (s.at - s.begins[s.owner]).tolist()
        for size, lo, hi in s.intervals(length):
            group = _hash(bodies[owner[lo]][start[lo]: start[lo] + size])
            for i in range(lo, hi + 1):
                out[owner[i]].append((group, start[i], size))
    return [sorted(set(r)) for r in out]


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (start, size) covered by spans (start, size)."""
    out: list[tuple[int, int]] = []
    for start, size in sorted(spans):
        if out and start <= out[-1][0] + out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], start + size - out[-1][0])
        else:
            out.append((start, size))
    return out


SPAN = "array<struct<start:int,size:int>>"
FOUND = f"group bigint, part bigint, repeats array<struct<group_id:bigint,start:int,size:int>>, spans {SPAN}"


def searched(parts: DataFrame, length: int) -> DataFrame:
    """The repeats in each part (group, part, copies, body); the parts of a group meet in one task."""
    span = pa.struct([("start", pa.int32()), ("size", pa.int32())])
    repeat = pa.struct([("group_id", pa.int64()), ("start", pa.int32()), ("size", pa.int32())])

    def found(rows):
        bodies, copies = [r[3] for r in rows], [r[2] for r in rows]
        repeats = repeats_within(bodies, copies, length)
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([[{"group_id": g, "start": s, "size": n} for g, s, n in r] for r in repeats], pa.list_(repeat)),
            pa.array([[{"start": s, "size": n} for s, n in union_of([x[1:] for x in r])] for r in repeats], pa.list_(span)),
        ], names=["group", "part", "repeats", "spans"])

    def run(batches):
        rows, size, group = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("group", "part", "copies", "body")), strict=True):
                if size > CHUNK and row[0] != group:  # whole groups only
                    yield found(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
                group = row[0]
        if rows:
            yield found(rows)

    return parts.select("group", "part", "copies", "body").repartition("group").sortWithinPartitions("group").mapInArrow(run, FOUND)


HALF = ("core bigint, piece bigint, copies bigint, shift int, windows int, anchor int, lo int, hi int, "
        "group bigint, part bigint, body binary")


def halved(parts: DataFrame, length: int) -> DataFrame:
    """Both halves of each part by the anchor's place in the windows, with a group of the bytes common to a half's windows."""
    names = [c.split()[0] for c in HALF.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in HALF.split(", ")])

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                mid, n, at = (r["lo"] + r["hi"]) // 2, r["windows"], r["anchor"]
                upper = min(n, max(0, at - mid + 1))  # windows in which the anchor stands at ``mid`` or later
                for first, count, lo, hi in ((0, upper, mid, r["hi"]), (upper, n - upper, r["lo"], mid)):
                    if count:
                        body, anchor = r["body"][first: first + count + length - 1], at - first
                        core = body[anchor - lo: anchor - hi + 1 + length]
                        out.append((r["core"], r["piece"], r["copies"], r["shift"] + first, count, anchor, lo, hi,
                                    _hash(core + b"%d,%d" % (lo, hi)), _hash(body), body))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], names=names) \
                if out else pa.RecordBatch.from_pylist([], schema)

    return parts.mapInArrow(run, HALF)


def _crowded(parts: DataFrame) -> DataFrame:
    """Groups with more than ``GROUP`` different parts."""
    return parts.groupBy("group").agg(F.countDistinct("part").alias("n")).where(F.col("n") > GROUP).select("group")


def occurrences(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Texts (uid, doc_id, body), and the pieces of text that hold repeats: uid, at, repeats (group_id,
    start from ``at``, size) and spans (start from ``at``, size), the bytes covered by them."""
    if not 8 <= gram < length:
        raise ValueError("an anchor takes 8 bytes or more and fewer than a repeat")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = stored(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", body.alias("body")), "repeat-texts")
    every = stored(pieces(texts.select("uid", "body"), length, gram), "repeat-pieces")
    # Stored, so that both sides of the join are plain shuffles and Spark can split a hot anchor.
    often = stored(every.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "repeat-anchors")
    kept = stored(every.join(often, "core", "left_semi"), "repeat-candidates")
    release(every, often)
    classes = stored(kept.groupBy("core", "piece").agg(
        F.count(F.lit(1)).alias("copies"), F.first("windows").alias("windows"), F.first("anchor").alias("anchor"),
        F.min(F.struct("uid", "at")).alias("sample")), "repeat-classes")
    kinds = classes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"))
    counted = classes.join(kinds, "core")

    # An anchor with one piece: all its copies are one repeat. The others need their text.
    whole = F.col("windows") + (length - 1)
    alone = counted.where("kinds = 1").select(
        "core", "piece", F.array(F.struct(F.xxhash64("core", "piece").alias("group_id"), F.lit(0).alias("start"), whole.alias("size"))).alias("repeats"),
        F.array(F.struct(F.lit(0).alias("start"), whole.alias("size"))).alias("spans"))
    several = counted.where("kinds > 1").select("core", "piece", "copies", "windows", "anchor", "sample.uid", "sample.at")
    cut = F.substring("body", F.col("at") + 1, whole)
    parts = stored(several.join(texts.select("uid", "body"), "uid").select(
        "core", "piece", "copies", F.lit(0).alias("shift"), "windows", "anchor", F.lit(0).alias("lo"), F.lit(length - gram + 1).alias("hi"),
        F.col("core").alias("group"), F.col("piece").alias("part"), cut.alias("body")), "repeat-parts")

    crowded = stored(_crowded(parts), "repeat-crowded")
    small = searched(parts.join(crowded, "group", "left_anti"), length)
    found = [alone, small.select(F.col("group").alias("core"), F.col("part").alias("piece"), "repeats", "spans")]
    pending, ready = parts, []
    while not crowded.isEmpty():  # at most as often as a part's windows can be halved
        halves = stored(halved(pending.join(crowded, "group", "left_semi"), length), "repeat-halves")
        crowded = stored(_crowded(halves), "repeat-crowded")
        ready.append(halves.join(crowded, "group", "left_anti"))
        pending = halves
    if ready:
        split = reduce(DataFrame.union, ready)
        equal = split.groupBy("group", "part").agg(F.sum("copies").alias("copies"), F.first("body").alias("body"))
        moved = searched(equal, length).join(split.select("core", "piece", "shift", "group", "part"), ["group", "part"])
        for name in ("repeats", "spans"):
            moved = moved.withColumn(name, F.transform(name, lambda x: x.withField("start", x["start"] + F.col("shift"))))
        found.append(moved.groupBy("core", "piece").agg(
            F.flatten(F.collect_list("repeats")).alias("repeats"), F.flatten(F.collect_list("spans")).alias("spans")))
    results = stored(reduce(DataFrame.unionByName, found).where(F.size("spans") > 0), "repeat-results")
    release(classes, parts)
    return texts, kept.select("uid", "at", "core", "piece").join(results, ["core", "piece"]).select("uid", "at", "repeats", "spans")


def maximal_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(group_id, doc_id, start, size): every occurrence of every maximal repeat of ``length`` bytes or
    more, as far as it lies around one anchor (a longer repeat goes on in the next anchor's groups)."""
    texts, found = occurrences(docs, length, gram)
    rows = found.select("uid", "at", F.inline("repeats")).select("uid", "group_id", (F.col("at") + F.col("start")).alias("start"), "size")
    return rows.join(texts.select("uid", "doc_id"), "uid").select("group_id", "doc_id", "start", "size")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, body (the text's bytes), kept (those outside every ``length``-byte string that starts
    anywhere else too) and spans (start, size of each maximal removed run) of every document.

    NULL and empty texts, and texts shorter than ``length``, lose nothing. Repeated rows and
    rows with a NULL or repeated doc_id are rows of their own, so equal texts of ``length`` bytes
    or more remove each other; other columns are ignored. No documents, no rows."""
    texts, found = occurrences(docs, length, gram)
    spans = found.select("uid", "at", F.inline("spans")).groupBy("uid").agg(
        F.collect_list(F.struct((F.col("at") + F.col("start")).alias("start"), F.col("size"))).alias("spans"))  # as many as a text has pieces
    kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))

    def run(batches):
        for batch in batches:
            sizes = [len(b.as_buffer()) for b in batch.column("body")]
            for a, b in slices(sizes, PASS):
                part = batch.slice(a, b - a)
                runs, kept = [], []
                for body, spans in zip(part.column("body").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    gone = union_of([(s["start"], s["size"]) for s in spans or ()])
                    edges = [0, *(x for s, n in gone for x in (s, s + n)), len(body)]
                    kept.append(b"".join(body[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
                    runs.append([{"start": s, "size": n} for s, n in gone])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("body"), pa.array(kept, pa.binary()), pa.array(runs, kind)],
                                                 names=["doc_id", "body", "kept", "spans"])

    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, body binary, kept binary, spans array<struct<start:bigint,size:bigint>>"
    return texts.join(spans, "uid", "left").select("doc_id", "body", "spans").mapInArrow(run, ddl)


def digest(removed: DataFrame) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of each document of ``remove_repeats``."""
    n, kept = F.octet_length("body").cast("bigint"), F.octet_length("kept").cast("bigint")
    return removed.select("doc_id", n.alias("n_bytes"), (n - kept).alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
