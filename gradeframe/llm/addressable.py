"""Token ids in directly addressable codes (DAC).

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every
id, level k the next chunk of those ids that need more than k chunks. A
continuation bitmap beside each level marks them, and a rank directory (marks
before each block of 512 bits) finds an id's place in the next level, so any id
is read without decoding others.

A file is a Parquet table of segments; a segment holds whole documents (about
``SEGMENT_TOKENS`` ids, more only if one document is longer): ``doc_ids``,
``doc_starts`` (first id of each document, and the end), and per level
``chunks``, ``bitmaps`` and ``ranks``. Segments of a part follow each other
(``start_in_part``), parts are ascending ranges of doc_id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeframe.llm.common import stored, text_slices
from gradeframe.llm.tokens import encoder

SEGMENT_TOKENS = 1 << 20
BLOCK_BITS = 512


class Dac:
    """A coded array: ``dac[i]`` reads one id, ``dac.slice(a, b)`` a run of them."""

    def __init__(self, chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.chunks = [np.frombuffer(x, np.uint8) for x in chunks]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    @staticmethod
    def encode(ids: np.ndarray) -> Dac:
        ids = np.asarray(ids, np.uint32)
        out: tuple[list, list, list] = ([], [], [])
        while True:
            more = ids > 0xFF
            bits = np.packbits(more, bitorder="little")
            bits = np.concatenate((bits, np.zeros(-len(bits) % (BLOCK_BITS // 8), np.uint8)))
            per_block = np.bitwise_count(bits.reshape(-1, BLOCK_BITS // 8)).sum(1, dtype=np.int64)
            out[0].append((ids & 0xFF).astype(np.uint8).tobytes())
            out[1].append(bits.tobytes())
            out[2].append(np.concatenate(([0], np.cumsum(per_block))).astype("<u4").tobytes())
            ids = ids[more] >> np.uint32(8)
            if not len(ids):
                return Dac(*out)

    def parts(self) -> tuple[list[bytes], list[bytes], list[bytes]]:
        return [x.tobytes() for x in self.chunks], [x.tobytes() for x in self.bitmaps], [x.tobytes() for x in self.ranks]

    def _rank(self, level: int, i: int) -> int:
        """Marks before position i of a level."""
        block, bits = i // BLOCK_BITS, self.bitmaps[level]
        first = block * (BLOCK_BITS // 8)
        n = int(self.ranks[level][block]) + int(np.bitwise_count(bits[first: i // 8]).sum())
        return n + (int(bits[i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def __len__(self) -> int:
        return len(self.chunks[0])

    def __getitem__(self, i: int) -> int:
        value, level = 0, 0
        while True:
            value |= int(self.chunks[level][i]) << (8 * level)
            if not self.bitmaps[level][i // 8] >> (i % 8) & 1:
                return value
            i, level = self._rank(level, i), level + 1

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a to b - 1; only their own chunks are touched."""
        out = np.zeros(b - a, np.uint32)
        rows = np.arange(b - a)
        for level, chunk in enumerate(self.chunks):
            if a >= b:
                break
            out[rows] |= chunk[a:b].astype(np.uint32) << np.uint32(8 * level)
            bits = np.unpackbits(self.bitmaps[level][a // 8: (b + 7) // 8], bitorder="little")[a % 8: a % 8 + b - a]
            rows = rows[bits.astype(bool)]
            if not len(rows):
                break
            a = self._rank(level, a)
            b = a + len(rows)
        return out


SCHEMA = "part int, start_in_part bigint, n_tokens bigint, doc_ids array<{0}>, doc_starts array<bigint>, chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
ARROW = [pa.int32(), pa.int64(), pa.int64(), None, pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.binary())]


def encode_files(docs: DataFrame, vocabulary: str, end_id: int, keeps_space: bool = False) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) into segments, in ascending doc_id order.

    Documents are dealt by ranges of doc_id and sorted there; a task holds one
    segment at a time. A NULL or empty text is a document of just the end id. NULL ids
    come first, equal ids follow each other, no documents give no segments.
    """
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode = encoder(vocabulary, keeps_space).encode
        part, start = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        doc_ids: list = []
        n = 0

        def segment(arrow_type):
            starts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids])))
            levels = Dac.encode(np.frombuffer(b"".join(ids), "<u4")).parts()
            values = [part, start, int(starts[-1]), doc_ids, starts.tolist(), *levels]
            types = [t or pa.list_(arrow_type) for t in ARROW]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=["part", "start_in_part", "n_tokens", "doc_ids", "doc_starts", "chunks", "bitmaps", "ranks"])

        kind = pa.int64()
        for batch in batches:
            keys, kind = batch.column("doc_id").to_pylist(), batch.column("doc_id").type
            for a, b, texts in text_slices(batch.column("text")):
                for key, own in zip(keys[a:b], encode(texts), strict=True):
                    if ids and n + len(own) // 4 >= SEGMENT_TOKENS:
                        yield segment(kind)
                        start, n, ids, doc_ids = start + n, 0, [], []
                    ids.append(own + end)
                    doc_ids.append(key)
                    n += len(own) // 4 + 1
        if ids:
            yield segment(kind)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(run, SCHEMA.format(id_type))


def write_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, keeps_space: bool = False) -> DataFrame:
    """Write the segments of ``docs`` to ``path`` and return the table read back from it."""
    encode_files(docs, vocabulary, end_id, keeps_space).write.parquet(path)
    return read_files(docs.sparkSession, path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_documents(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of written segments: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32, and with ``with_ids`` the ids as an array."""
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per task of the writer
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    id_type = segments.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {id_type}, part int, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r].as_py()  # noqa: B023, E731
                dac, starts, first = Dac(get("chunks"), get("bitmaps"), get("ranks")), get("doc_starts"), get("start_in_part")
                each = [dac.slice(a, b).astype("<u4") for a, b in zip(starts, starts[1:], strict=False)]
                n = len(each)
                arrays = [pa.array(get("doc_ids"), batch.column("doc_ids").type.value_type), pa.array([get("part")] * n, pa.int32()), pa.array([first + s for s in starts[:-1]], pa.int64()), pa.array([len(x) for x in each], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())]
                names = ["doc_id", "part", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.tolist() for x in each], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = segments.drop("n_tokens").mapInArrow(run, schema)
    out = rows.join(totals.select("part", before.alias("before")), "part")
    return out.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def encode_and_read(docs: DataFrame, vocabulary: str, end_id: int, keeps_space: bool = False, with_ids: bool = False) -> DataFrame:
    """Write the files of ``docs`` under the checkpoint folder and read the documents back."""
    return read_documents(stored(encode_files(docs, vocabulary, end_id, keeps_space), "dac"), with_ids)
