"""Prefix trie of conversations: union-find over the LCP edges of sorted neighbours.

A conversation is the sequence of its turns; a turn is known by the MD5 of its
role and text, so a conversation is one string of 32 characters a turn and every
prefix of d turns is a prefix of 32 d characters. Conversations are dealt and
sorted by that string (range partitioning by string and conv_id, so copies of one
conversation may lie in many partitions). A task joins its neighbours by
union-find in descending order of their longest common prefix: a merge at depth d
makes the branching node of depth d, and the turns between two merges are a chain
of nodes with one child each. Nodes without the first or last conversation of the
partition are complete. The others form its left and right spine: the partition's
forest contracted to two paths, whose nodes carry the sums of the complete
subtrees below them. One pass over the spines in partition order, with the open
path as its only state, merges them across the boundaries. It reads two paths a
partition, however many conversations there are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeframe.llm.common import stored

#: Characters of a turn in a conversation's string (an MD5 in hex).
TURN = 32
NODE = ("node string, depth bigint, conv_id bigint, parent string, parent_conv_id bigint, n_convs bigint, "
        "n_children bigint, n_leaves bigint, saved_tokens bigint")
#: A node of a spine also has its partition, its side (0 both, 1 first, 2 last) and the size of its last text.
SPINE = f"{NODE}, part int, side int, chars bigint"


def turns_of(rows: DataFrame) -> DataFrame:
    """(conv_id, pos from 0, turn, chars) of rows (conv_id, turn, role, text), in order of turn.

    NULL turns come first; equal turns are ordered by role, then text, and repeated
    rows are turns of their own. NULL role or text is the empty text. Rows with a
    NULL conv_id belong to no conversation; other columns are ignored."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text)
    return rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), (F.row_number().over(order) - 1).alias("pos"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("turn"), F.length(text).alias("chars"))


def with_borrowed_heads(turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Turns of conversations that start like the first of their block: the first h turns of
    conversation c - c % block (the remainder of SQL, with the sign of c), then c's own after its
    first h; h is crc32(c) % most.

    Every conv_id of the input is in the output: one left without turns as a row with NULL ``turn``."""
    turns = stored(turns, "trie-turns")  # read three times
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.select("conv_id").distinct().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    own = turns.where(F.col("pos") >= h).select("conv_id", F.lit(1).alias("part"), "pos", "turn", "chars")
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < most)).select(
        F.col("conv_id").alias("base"), F.lit(0).alias("part"), "pos", "turn", "chars")
    borrowed = convs.join(heads, "base").where("pos < h").select("conv_id", "part", "pos", "turn", "chars")
    none = convs.select("conv_id", F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("pos"),
                        F.lit(None).cast("string").alias("turn"), F.lit(None).cast("int").alias("chars"))
    return own.union(borrowed).union(none)


def paths_of(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): a conversation's turns as one string, and the size of each text."""
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.when(F.col("turn").isNotNull(), F.struct("part", "pos", "turn", "chars")))).alias("t"))
    return listed.select("conv_id", F.array_join(F.col("t.turn"), "").alias("path"), F.col("t.chars").alias("sizes"))


def common_turns(a: str, b: str) -> int:
    """Turns that two paths share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    x, y = (np.frombuffer(s[:n].encode("ascii"), np.uint8) for s in (a, b))
    return int(np.argmax(x != y)) // TURN


class Forest:
    """The nodes of one partition's sorted conversations."""

    def __init__(self, convs: list[int], paths: list[str], sizes: list[list[int]]):
        self.convs, self.paths, self.sizes = convs, paths, sizes
        n = len(convs)
        # Of a node: depth, rows lo..hi, smallest conv_id, children, and leaves and savings below it.
        self.depth = [len(p) // TURN for p in paths]
        self.lo, self.hi, self.conv = list(range(n)), list(range(n)), list(convs)
        self.children, self.leaves, self.saved, self.up = [0] * n, [0] * n, [0] * n, [-1] * n
        self.dead = [False] * n
        self.last = n - 1
        self._join()

    def is_open(self, x: int) -> bool:
        return self.lo[x] == 0 or self.hi[x] == self.last

    def _grown(self, x: int, depth: int) -> int:
        """The ancestor of node ``x`` at ``depth``, by a chain of nodes with one child."""
        while self.depth[x] > depth:
            d, convs = self.depth[x], self.hi[x] - self.lo[x] + 1
            self.up[x] = y = len(self.depth)
            is_open = self.is_open(x)  # then its sums are settled when the partitions are merged
            self.depth.append(d - 1)
            self.lo.append(self.lo[x])
            self.hi.append(self.hi[x])
            self.conv.append(self.conv[x])
            self.children.append(0 if is_open else 1)
            self.leaves.append(0 if is_open else self.leaves[x] or 1)
            if not is_open:
                self.saved[x] += (convs - 1) * self.sizes[self.lo[x]][d - 1]
            self.saved.append(0 if is_open else self.saved[x])
            self.up.append(-1)
            self.dead.append(False)
            x = y
        return x

    def _join(self) -> None:
        n = len(self.convs)
        shared = [common_turns(a, b) for a, b in zip(self.paths, self.paths[1:], strict=False)]
        parent, top = list(range(n)), list(range(n))  # union-find over rows; the top node of a root's component

        def find(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in sorted(range(n - 1), key=lambda i: -shared[i]):
            d, a, b = shared[i], find(i), find(i + 1)
            # Both sides come up to depth d: their nodes there are one and the same.
            x, y = self._grown(top[a], d), self._grown(top[b], d)
            self.hi[x] = self.hi[y]
            self.conv[x] = min(self.conv[x], self.conv[y])
            self.children[x] += self.children[y]
            self.leaves[x] += self.leaves[y]
            self.saved[x] += self.saved[y]
            self.dead[y], self.up[y] = True, x
            parent[b] = a
            top[a] = x
        if n:
            self._grown(top[find(0)], 0)

    def rows(self, part: int):
        """Rows of ``SPINE``: complete nodes with ``part`` NULL, nodes of the spines with it."""
        keys: dict[int, str] = {}
        alive = [x for x in range(len(self.depth)) if not self.dead[x]]
        by_row: dict[int, list[int]] = {}
        for x in alive:
            by_row.setdefault(self.lo[x], []).append(x)
        for row, nodes in by_row.items():  # the nodes that start at a row are prefixes of its path
            digest, at = hashlib.md5(), 0
            for x in sorted(nodes, key=self.depth.__getitem__):
                digest.update(self.paths[row][at: TURN * self.depth[x]].encode("ascii"))
                at = TURN * self.depth[x]
                keys[x] = digest.hexdigest()
        for x in alive:
            p = self.up[x]
            while p >= 0 and self.dead[p]:
                p = self.up[p]
            d, is_open = self.depth[x], self.is_open(x)
            side = (0 if self.lo[x] == 0 and self.hi[x] == self.last else 1 if self.lo[x] == 0 else 2) if is_open else None
            leaves = self.leaves[x] if is_open else self.leaves[x] or 1
            above = self.conv[p] if p >= 0 and not self.is_open(p) else None
            yield (keys[x], d, self.conv[x], keys[p] if p >= 0 else None, above, self.hi[x] - self.lo[x] + 1, self.children[x],
                   leaves, self.saved[x], part if is_open else None, side, self.sizes[self.lo[x]][d - 1] if is_open and d else None)


def _batches(rows, schema: pa.Schema, size: int = 65_536):
    rows = list(rows)
    for i in range(0, len(rows), size):
        columns = list(zip(*rows[i: i + size], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def forests(paths: DataFrame) -> DataFrame:
    """The nodes of each partition of conversations sorted by path."""
    schema = _arrow(SPINE)

    def run(batches):
        convs, texts, sizes = [], [], []
        for batch in batches:
            convs += batch.column("conv_id").to_pylist()
            texts += batch.column("path").to_pylist()
            sizes += batch.column("sizes").to_pylist()
        if convs:
            yield from _batches(Forest(convs, texts, sizes).rows(TaskContext.get().partitionId()), schema)

    by = ("path", "conv_id")
    return paths.select("conv_id", "path", "sizes").repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, SPINE)


def merged_spines(spines: DataFrame) -> DataFrame:
    """The nodes that reach a partition's first or last conversation, each once.

    One task reads them in partition order (two paths a partition) and holds the open path."""
    schema = _arrow(NODE)

    def run(batches):
        path: list[dict] = []  # the open nodes, by depth
        out = []

        def close(depth):
            while len(path) > depth:
                x = path.pop()
                x["n_leaves"] = x["n_leaves"] or 1
                x["saved_tokens"] += (x["n_convs"] - 1) * (x["chars"] or 0)
                if path:
                    path[-1]["n_children"] += 1
                    path[-1]["n_leaves"] += x["n_leaves"]
                    path[-1]["saved_tokens"] += x["saved_tokens"]
                out.append(tuple(x[c] for c in schema.names))

        def reach(row):
            d = row["depth"]
            if len(path) > d and path[d]["node"] != row["node"]:
                close(d)
            if len(path) == d:
                path.append(row)
                return
            x = path[d]
            x["conv_id"] = min(x["conv_id"], row["conv_id"])
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                x[c] += row[c]

        for batch in batches:
            for row in batch.to_pylist():
                reach(row)
            yield from _batches(out, schema)
            out.clear()
        close(0)
        yield from _batches(out, schema)

    first, last = "part", F.when(F.col("side") == 2, 1).otherwise(0)  # the first conversation's path, then the last one's
    return spines.repartition(1).sortWithinPartitions(first, last, "depth").mapInArrow(run, NODE)


def ends_of(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end: SHA-256 of their conv_ids,
    ascending and joined by commas, read in that order and never gathered."""

    def run(batches):
        node, digest = None, None
        for batch in batches:
            nodes, convs = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            out = []
            for k, c in zip(nodes, convs, strict=True):
                if k != node:
                    if node is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = k, hashlib.sha256(str(c).encode())
                else:
                    digest.update(f",{c}".encode())
            yield from _batches(out, schema)
        if node is not None:
            yield from _batches([(node, digest.hexdigest())], schema)

    ddl = "node string, ends_sha256 string"
    schema = _arrow(ddl)
    ends = paths.select(F.md5("path").alias("node"), "conv_id")
    return ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(run, ddl)


def prefix_trie(paths: DataFrame) -> DataFrame:
    """A row per distinct prefix of the conversations of ``paths``, the textless root (depth 0) among them.

    node (MD5 of the prefix's turns), conv_id (smallest member), depth, parent and
    parent_conv_id (NULL for the root), n_convs (members: conversations that start
    so, turnless ones at the root alone), n_children, n_leaves (childless nodes in
    its subtree, itself if it is one), saved_tokens (over its subtree, (n_convs - 1)
    times the characters of the node's last text), ends_sha256 (of the members that
    end here; of nothing for none). No conversations, no rows."""
    paths = stored(paths, "trie-paths")
    nodes = stored(forests(paths), "trie-forests")
    columns = [c.split()[0] for c in NODE.split(", ")]
    opened = stored(merged_spines(nodes.where("part IS NOT NULL")), "trie-spines")
    complete = nodes.where("part IS NULL").select(*columns)
    above = opened.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    named = complete.union(opened.select(*columns)).join(above, "parent", "left")
    named = named.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return named.join(ends_of(paths), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"), "node", "parent")
