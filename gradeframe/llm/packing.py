"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bin completion (branch and bound): take the largest remaining piece, enumerate
the undominated fillings of the room beside it, follow them in order of waste,
and prune a branch whose waste already rules out beating the incumbent; the
first incumbent is the best-fit-decreasing solution.

Piece lengths are integers from 1 to the capacity, so the packing problem of any
corpus is a histogram of at most ``capacity`` counts. Only this histogram
reaches the driver. The search packs equal bins at once (pattern x number of
bins), and the resulting plan maps the k-th piece of each length to its bin, so
pieces are placed by Spark tasks in parallel: a running number per (task,
length) from the tokenizing pass plus the counts of earlier tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeframe.llm.common import stored, text_slices
from gradeframe.llm.tokens import encoder

CAPACITY = 1024
#: Fillings that the search may enumerate in all, and per bin; steps of one test for domination.
NODES, STEPS, KEPT, FITS = 12_000, 400, 4, 500

Pattern = tuple[tuple[int, ...], int]  # lengths of one bin, number of such bins


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram (``counts[n]`` pieces of length n)."""
    room: dict[int, list[list]] = defaultdict(list)  # free room -> [[lengths, bins], ...]
    free = np.zeros(capacity + 1, np.int64)  # bins by free room
    for n in range(capacity, 0, -1):
        left = int(counts[n])
        while left:
            fits = np.flatnonzero(free[n:])
            if not len(fits):
                k = capacity // n
                for size, bins in ((k, left // k), (left % k, 1)):
                    if size and bins:
                        room[capacity - size * n].append([(n,) * size, bins])
                        free[capacity - size * n] += bins
                break
            r = n + int(fits[0])
            lengths, bins = room[r].pop()
            used = min(bins, left)
            if used < bins:
                room[r].append([lengths, bins - used])
            room[r - n].append([(*lengths, n), used])
            free[r] -= used
            free[r - n] += used
            left -= used
    return [(tuple(x), n) for same in room.values() for x, n in same]


def _fits_into(small: tuple[int, ...], large: tuple[int, ...]) -> bool:
    """Whether the pieces of ``small`` can be packed into pieces of ``large``.

    What is not found within ``FITS`` steps counts as no: the filling is then tried like an undominated one."""
    steps = 0

    def go(small, large):
        nonlocal steps
        steps += 1
        if not small:
            return True
        n, tried = small[0], set()
        for i, r in enumerate(large):
            if r >= n and r not in tried and steps < FITS:
                tried.add(r)
                if go(small[1:], (*large[:i], r - n, *large[i + 1:])):
                    return True
        return False

    return go(small, large)


def fillings(counts: np.ndarray, room: int, most_waste: int) -> tuple[list[tuple[int, ...]], int]:
    """Undominated fillings of ``room`` with waste up to ``most_waste``, least waste first.

    A filling is dominated if its pieces can be packed into the pieces of another
    one: then the other leaves no worse a problem. A single piece that fills the
    room dominates all. Returns the fillings and the number of steps taken.
    """
    if room and counts[room]:
        return [(room,)], 1
    sizes = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    rising = [-n for n in sizes]
    found: list[tuple[int, tuple[int, ...]]] = []
    steps = perfect = 0

    def go(i: int, left: int, taken: list[int]) -> bool:
        nonlocal steps, perfect
        steps += 1
        if steps > STEPS or perfect >= KEPT:
            return False
        grown = False
        # One last piece that closes the room exactly comes first.
        if left and i < len(sizes) and left <= sizes[i] and counts[left] > taken.count(left):
            found.append((0, (*taken, left)))
            perfect += 1
            return True
        for j in range(max(i, bisect_left(rising, -left)), len(sizes)):
            n = sizes[j]
            if counts[n] <= taken.count(n):
                continue
            grown = True
            go(j, left - n, [*taken, n])
            if steps > STEPS or perfect >= KEPT:
                break
        if not grown and left <= most_waste:
            found.append((left, tuple(taken)))
            perfect += not left
        return True

    go(0, room, [])
    if not found:  # the step limit came first: fill greedily
        left, taken = room, []
        for n in sizes:
            while n <= left and counts[n] > taken.count(n):
                taken.append(n)
                left -= n
        if left <= most_waste:
            found.append((left, tuple(taken)))
    found.sort(key=lambda x: (x[0], len(x[1])))
    kept: list[tuple[int, ...]] = []
    for _, x in found:
        if len(kept) < KEPT and not any(_fits_into(x, k) for k in kept):
            kept.append(x)
    return kept, steps


def bin_completion(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns that pack a histogram of lengths into few bins of ``capacity``."""
    counts = np.asarray(counts, np.int64).copy()
    total = int((counts * np.arange(capacity + 1)).sum())
    least = -(-total // capacity)
    best = best_fit(counts, capacity)
    best_bins = sum(n for _, n in best)
    spent = 0
    # A frame: (bins so far, waste so far, fillings to try, pattern applied, largest).
    stack: list[list] = []
    path: list[Pattern] = []
    bins = waste = 0

    def children() -> tuple[int, Iterator]:
        nonlocal spent
        left = np.flatnonzero(counts)
        if not len(left):
            return 0, iter(())
        n = int(left[-1])
        counts[n] -= 1
        allowed = (best_bins - 1) * capacity - total - waste  # total waste of any better solution
        found, steps = fillings(counts, capacity - n, allowed)
        counts[n] += 1
        spent += steps
        return n, iter(found)

    stack.append([*children(), None])
    while stack and best_bins > least and spent < nodes:
        n, options, applied = stack[-1]
        if applied is not None:  # take back what this frame tried last
            lengths, m = applied
            for x in lengths:
                counts[x] += m
            bins -= m
            waste -= m * (capacity - sum(lengths))
            path.pop()
            stack[-1][2] = None
        filling = next(options, None) if n else None
        if filling is None:
            stack.pop()
            continue
        lengths = (n, *filling)
        need = {x: lengths.count(x) for x in lengths}
        m = min(int(counts[x]) // k for x, k in need.items())
        allowed = (best_bins - 1) * capacity - total
        per_bin = capacity - sum(lengths)
        if per_bin:  # no more equal bins than the waste bound admits
            m = min(m, (allowed - waste) // per_bin)
            if m < 1:
                continue
        for x in lengths:
            counts[x] -= m
        bins += m
        waste += m * per_bin
        path.append((lengths, m))
        stack[-1][2] = (lengths, m)
        if not counts.any():
            if bins < best_bins:
                best, best_bins = list(path), bins
            continue
        stack.append([*children(), None])
    return best


class Plan:
    """Where the k-th piece of a length goes: sequence and offset there."""

    def __init__(self, patterns: list[Pattern]):
        runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # length -> (pieces, first sequence, offset)
        first = 0
        for lengths, bins in patterns:
            at = 0
            for n in lengths:
                runs[n].append((bins, first, at))
                at += n
            first += bins
        self.sequences = first
        self.runs = {n: (np.concatenate(([0], np.cumsum([r[0] for r in x])[:-1])), np.array([r[1] for r in x]), np.array([r[2] for r in x])) for n, x in runs.items()}

    def place(self, length: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            begins, first, at = self.runs[int(n)]
            k = np.searchsorted(begins, index[rows], "right") - 1
            sequence[rows], offset[rows] = first[k] + index[rows] - begins[k], at[k]
        return sequence, offset


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    out = [(0, first)] if first else []
    return out + [(a, capacity) for a in range(first, n, capacity)]


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenized pieces of ``docs``: doc_id, piece, start, length, ids_crc32 (and ids as
    little-endian unsigned 32-bit integers), with the task (``part``) that made each and
    its number (``nth``) among the task's pieces of that length."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint" + ", ids binary" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = encoder(vocabulary, keeps_space=True).encode
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for a, b, texts in text_slices(batch.column("text")):
                rows, cols = [], [[] for _ in range(6 + with_ids)]
                for i, ids in zip(range(a, b), encode(texts), strict=True):
                    ids += end
                    for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * start: 4 * (start + n)]
                        rows.append(i)
                        for c, v in zip(cols, (k, start, n, zlib.crc32(own), part, seen[n], own), strict=False):
                            c.append(v)
                        seen[n] += 1
                arrays = [doc_ids.take(pa.array(rows, pa.int64()))] + [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * with_ids)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pack every document into as few sequences of at most ``capacity`` tokens as found.

    ``docs`` needs doc_id and text; other columns are ignored. Returns one row
    per piece with its sequence_id (0 up) and its gapless offset there; with
    ``with_ids`` also its ids. A NULL or empty text is a document of just the end
    id; equal or NULL doc_ids are separate documents; no documents, no rows.
    """
    pieces = stored(pieces_of(docs, vocabulary, end_id, capacity, with_ids), "pieces")
    per_task = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    plan = Plan(bin_completion(counts, capacity))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = pieces.join(per_task.select("part", "length", earlier.alias("before")), ["part", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    rows = numbered.select(*columns, (F.col("before") + F.col("nth")).alias("index"))
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in columns)

    def place(batches):
        for batch in batches:
            sequence, offset = plan.place(batch.column("length").to_numpy(), batch.column("index").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    return rows.mapInArrow(place, f"{names}, sequence_id bigint, `offset` bigint")
