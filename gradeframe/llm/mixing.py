"""Mixing sources to target weights.

Words of a source, in the order of doc_id, are packed into blocks of ``BLOCK``
words. A source's target becomes a number of block slots; every output shard
draws how many of its slots come from each source (multinomial by what the
sources have left, so the totals are met exactly), and puts them in a pseudorandom order. A source numbers its slots
through all shards as they were drawn; slot j takes block ``permutation(j mod blocks)``, a Feistel
network keyed by seed and source, so a source is read in a fixed pseudorandom order, as
often as its quota says (at most ``REPEATS`` times). Slots and blocks are joined by
(source, block index). The output is a table of shard, position, source and block; how often a document's
words are taken, and the mixed texts, are read from it.

Only one row per source is gathered: the mixture's table. Positions of
documents are sums over ranges of doc_id (per task and source), never a
window over a source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeframe.llm.common import apart, mix64, stored, text_slices, word_spans

BLOCK, REPEATS, SHARDS, SEED = 64, 3, 256, 7
#: Weights of the sources by code point (NULL last), repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Slots that one row expands to.
RUN = 65_536


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """Shares of all words by weight; a target above ``repeats`` times its source's
    size stops there, and the excess is shared among the others again."""
    total, out, open_ = float(sum(sizes)), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        left = total - sum(out)
        weight = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / weight > repeats * sizes[i]]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in above:
            out[i] = float(repeats * sizes[i])
        open_ = [i for i in open_ if i not in above]
    return out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at ``index``: four Feistel rounds, walked until inside."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask, out = np.uint64((1 << half) - 1), index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            left, right = right, left ^ (mix64(right + mix64(np.array([key * 4 + r], np.uint64))) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def placed(docs: DataFrame) -> DataFrame:
    """(doc_id, source, h, row, size, part, before): every document's words and its place in its part's share of the source."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches):
        for batch in batches:
            size = [len(t.encode("utf-8", "replace").split()) for _, _, texts in text_slices(batch.column("text")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), batch.column("h"), pa.array(size, pa.int64())], names=["doc_id", "source", "h", "size"])

    def place(batches):
        part, row, seen = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            before = []
            for source, size in zip(batch.column("source").to_pylist(), batch.column("size").to_pylist(), strict=True):
                before.append(seen.get(source, 0))
                seen[source] = before[-1] + size
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((part << 40) + np.arange(row, row + n)), pa.array(np.full(n, part, np.int32)), pa.array(before, pa.int64())], names=["doc_id", "source", "h", "size", "row", "part", "before"])
            row += n

    sized = docs.select("doc_id", "source", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h"), "text").mapInArrow(count, f"doc_id {kind}, source string, h bigint, size bigint")
    ordered = sized.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "source", "size")
    return stored(ordered.mapInArrow(place, f"doc_id {kind}, source string, h bigint, size bigint, row bigint, part int, before bigint"), "mix-documents")


class Mixture:
    """The mixture's table (a row per source), and the slots and places it leads to."""

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED):
        self.spark, self.docs, self.seed, self._output = docs.sparkSession, placed(docs), seed, None
        sums = stored(self.docs.groupBy("part", "source").agg(F.sum("size").alias("size")), "mix-parts")
        found = sums.groupBy("source").agg(F.sum("size").alias("size")).collect()  # a row per source
        found = sorted(((r["source"], r["size"]) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
        self.sources, self.sizes = [s for s, _ in found], [n for _, n in found]
        self.targets = targets(self.sizes, [weights[i % len(weights)] for i in range(len(found))])
        self.blocks = [-(-n // BLOCK) for n in self.sizes]
        self.slots = [min(REPEATS * b, round(t / n * b)) if n else 0 for t, n, b in zip(self.targets, self.sizes, self.blocks, strict=True)]
        table = [(i, s, n, t) for i, (s, n, t) in enumerate(zip(self.sources, self.sizes, self.targets, strict=True))]
        self.table = self.spark.createDataFrame(table, "sid int, source string, source_size bigint, target double")
        before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        self.bases = sums.select("part", "source", before.alias("base"))

    def draws(self) -> list[tuple[int, int, int, int, int, int]]:
        """(output shard, source, first slot of the source, slots, the shard's slots before them and in all) of each shard."""
        left = np.array(self.slots, np.int64)
        rng, first, out = np.random.default_rng(self.seed), np.zeros(len(left), np.int64), []
        for shard in range(SHARDS):
            n = int(left.sum()) // (SHARDS - shard)
            drawn = np.zeros(len(left), np.int64)
            while (more := n - int(drawn.sum())) > 0:
                open_ = left - drawn
                drawn += np.minimum(rng.multinomial(more, open_ / open_.sum()), open_)
            before = np.cumsum(drawn) - drawn
            out += [(shard, i, int(first[i]), int(drawn[i]), int(before[i]), n) for i in np.flatnonzero(drawn).tolist()]
            first, left = first + drawn, left - drawn
        return out

    def output(self) -> DataFrame:
        """(shard, position, sid, slot, block): the block at each position of each output shard.

        A shard's slots are its draws; their positions are a pseudorandom permutation, so its sources
        are mixed. Slot j of a source takes its block permutation(j mod blocks). Written once."""
        if self._output is None:
            self._output = stored(self._slots(), "mix-output")
        return self._output

    def _slots(self) -> DataFrame:
        blocks, seed = self.blocks, self.seed
        draws = self.spark.createDataFrame(self.draws(), "shard int, sid int, first bigint, n bigint, before bigint, total bigint")  # a row per shard and source
        runs = draws.withColumn("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(RUN).cast("bigint"))))
        runs = runs.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))  # a number, so that it stays

        def run(batches):
            for batch in batches:
                for shard, sid, first, n, before, total, a in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    k = np.arange(a, min(a + RUN, n))
                    block = permuted((first + k) % blocks[sid], blocks[sid], (seed << 32) + sid)
                    position = permuted(before + k, total, (seed << 32) + (1 << 31) + shard)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), shard, np.int32)), pa.array(position), pa.array(np.full(len(k), sid, np.int32)), pa.array(first + k), pa.array(block)],
                                                     names=["shard", "position", "sid", "slot", "block"])

        return runs.mapInArrow(run, "shard int, position bigint, sid int, slot bigint, block bigint")

    def known(self) -> DataFrame:
        """Documents with their source's row and ``start``, their first word in the source."""
        rows = self.docs.join(self.bases.withColumnRenamed("source", "_s"), (self.docs["part"] == self.bases["part"]) & self.docs["source"].eqNullSafe(F.col("_s"))).drop("_s", self.bases["part"])
        table = self.table.withColumnRenamed("source", "_s")
        return rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["_s"])).select("row", "doc_id", "source", "h", "size", "sid", "source_size", "target", (F.col("base") + F.col("before")).alias("start"))

    def pieces(self) -> DataFrame:
        """(row, sid, block, first, last): a document's words in each block of its source, counted in the document."""
        docs = self.known().where("size > 0").select("row", "sid", "start", "size")
        block = F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") - 1) / BLOCK))).alias("block")
        rows = docs.select("row", "sid", "start", "size", block)
        return rows.select("row", "sid", "block", F.greatest(F.col("block") * BLOCK - F.col("start"), F.lit(0)).alias("first"), F.least((F.col("block") + 1) * BLOCK - F.col("start"), F.col("size")).alias("last"))

    def taken(self) -> DataFrame:
        """(row, first, last, times): pieces that the mix takes, as often as their blocks are in the output."""
        times = stored(self.output().groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times")), "mix-times")
        return self.pieces().join(times, ["sid", "block"]).select("row", "first", "last", "times")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted).

    ``docs``: doc_id, text, source (other columns are ignored). NULL and wordless texts have size 0 and are
    not taken; a NULL source is a source, repeated rows are documents of their own,
    a source without words has target 0; no documents, no rows."""
    mixture = Mixture(docs, weights, seed)
    sums = mixture.taken().groupBy("row").agg(F.sum((F.col("last") - F.col("first")) * F.col("times")).alias("taken"))
    out = mixture.known().select("row", "doc_id", "size", "source_size", "target").join(sums, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_blocks(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix as output shards: shard, position (gapless from 0 in a shard), source, block and the block's words as text.

    The last block of a source may be shorter. Rows equal in doc_id and text count as one
    document here; other columns are ignored, no documents, no rows."""
    docs = docs.select("doc_id", "text", "source").dropDuplicates(["doc_id", "text"])
    mixture = Mixture(docs, weights, seed)
    known = mixture.known().select("row", "start", F.col("doc_id").alias("id"), "h")
    taken = mixture.output().select("sid", "block").distinct()
    lists = mixture.pieces().join(taken, ["sid", "block"], "left_semi").groupBy("row").agg(F.collect_list(F.struct("sid", "block", "first", "last")).alias("pieces"))
    lists = stored(lists.join(known, "row").select("id", "h", "start", "pieces"), "mix-pieces")
    h = F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["id"]) & (h == lists["h"])).select("text", "start", "pieces")

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column("text")):
                out = []
                for text, start, pieces in zip(texts, *(batch.column(c).slice(a, b - a).to_pylist() for c in ("start", "pieces")), strict=True):
                    words = text.encode("utf-8", "surrogatepass").split()
                    out += [(x["sid"], x["block"], start + x["first"], b" ".join(words[x["first"]: x["last"]]).decode("utf-8", "surrogatepass")) for x in pieces]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["sid", "block", "at", "words"]).cast(schema)

    schema = pa.schema([("sid", pa.int32()), ("block", pa.int64()), ("at", pa.int64()), ("words", pa.string())])
    parts = joined.mapInArrow(run, "sid int, block bigint, at bigint, words string")
    blocks = parts.groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))  # BLOCK words at most
    blocks = stored(blocks.select("sid", "block", F.array_join(F.col("parts.words"), " ").alias("text")), "mix-blocks")
    names = mixture.table.select("sid", "source")
    return mixture.output().join(blocks, ["sid", "block"]).join(names, "sid").select("shard", "position", "source", "block", "text")


def mixed_texts(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix as rows with the columns of ``docs`` (doc_id, text, source and any others).

    A document comes as often as the block that is taken most often holds words
    of it; a copy's text is what is taken that often, in the document's order.
    n_chars, if there, counts the new text. Rows equal in doc_id and text count
    as one document here."""
    docs, original = apart(docs.dropDuplicates(["doc_id", "text"]), ("doc_id", "text", "source", "n_chars"))
    mixture = Mixture(docs, weights, seed)
    rows = mixture.docs.select("row", F.col("h").alias("_h"), F.col("doc_id").alias("_id"))
    lists = mixture.taken().groupBy("row").agg(F.collect_list(F.struct("first", "last", "times")).alias("_taken"))
    lists = stored(lists.join(rows, "row").select("_id", "_h", "_taken"), "mix-taken")
    h = F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["_id"]) & (h == lists["_h"])).drop("_id", "_h")
    names = docs.columns

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column("text")):
                taken = batch.column("_taken").slice(a, b - a).to_pylist()
                index, out = [], []
                for i in range(a, b):
                    data = texts[i - a].encode("utf-8", "surrogatepass")
                    starts = np.append(word_spans([data])[2], len(data))
                    starts[0] = 0
                    pieces = sorted((x["first"], x["last"], x["times"]) for x in taken[i - a])
                    for again in range(max(t for _, _, t in pieces)):
                        index.append(i)
                        out.append(b"".join(data[starts[p]: starts[q]] for p, q, t in pieces if t > again).decode("utf-8", "surrogatepass"))
                new = {"text": pa.array(out, batch.column("text").type)}
                if "n_chars" in names:
                    new["n_chars"] = pa.array([len(t) for t in out]).cast(batch.column("n_chars").type)
                at = pa.array(index, pa.int64())
                yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c).take(at) for c in names], names=names)

    return joined.mapInArrow(run, docs.schema).toDF(*original.values())
