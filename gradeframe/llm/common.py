"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeframe.session import application_key
from gradeframe.sources.store import materialize

__all__ = ["apart", "crc_rest", "mix64", "read", "release", "ship", "slices", "span_hashes", "stored", "text_slices", "texts_of", "word_edges", "word_spans"]

#: Bytes of text that one numpy pass works on (a longer text is one pass of its own).
PASS_BYTES = 1 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, so tasks can import it
    wherever the driver found it. Call before functions for tasks are made."""
    application = application_key(spark)
    if application in _SHIPPED:
        return
    _SHIPPED.add(application)
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="gradeframe-package-")) / "gradeframe.zip"  # the driver serves it
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted((root / "gradeframe").rglob("*.py")):
            z.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(target))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write under ``spark.checkpoint.dir`` and read back: lineage ends at shared files,
    so what several later steps read is made once and outlives its executors."""
    return materialize(df, f"llm-{label}")


def release(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def apart(docs: DataFrame, own: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but ``own`` under names that no operator uses, and the names they had."""
    names = [c if c in own else f"other {i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), dict(zip(names, docs.columns, strict=True))


def crc_rest(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (NULL for a NULL id)."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % modulus).cast("int")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; NULL reads as the empty text."""
    return [t if t is not None else "" for t in column.to_pylist()]


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, end, texts) of consecutive parts of an Arrow column, a few megabytes each,
    so that a task never holds a whole batch of texts as Python strings."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in slices(sizes):
        yield a, b, texts_of(column.slice(a, b - a))


def slices(sizes: list[int], limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit``."""
    a, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


# Word hashes: sum of byte * P**position, brought back to position 0 with P's inverse.
_P = 0x100000001B3
_P_INV = pow(_P, -1, 1 << 64)
_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        out = []
        for base in (_P, _P_INV):
            p = np.full(max(n, PASS_BYTES + 4096), base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if n > 4 * PASS_BYTES:  # tables for one very long text are not kept
            return out[0], out[1]
        _POWERS = out[0], out[1]
    return _POWERS


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ascending byte ranges that do not overlap."""
    power, inverse = _powers(len(buf))
    weighed = buf.astype(np.uint64)
    weighed += np.uint64(1)
    weighed *= power[: len(buf)]
    gap = np.flatnonzero(ends[:-1] < starts[1:])
    edges = np.insert(starts, gap + 1, ends[gap])  # gaps get sums of their own
    sums = np.delete(np.add.reduceat(weighed[: ends[-1]], edges), gap + 1 + np.arange(len(gap)))
    return mix64(sums * inverse[starts])


def word_edges(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text with a line feed behind it as bytes, and where its words start and end."""
    buf = np.frombuffer(text + b"\n", np.uint8)
    edge = np.diff(np.concatenate(([False], ~_IS_SPACE[buf])).astype(np.int8))
    return buf, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_spans(texts: list[bytes], cuts: bytes = b"") -> tuple[np.ndarray, ...]:
    """Words (runs without ASCII white space) of several texts at once.

    Returns ``(buffer, text_starts, starts, ends, text_index, hashes)``: the
    texts joined by line feeds as bytes, where each begins, and per word its
    byte range, the number of its text and a 64-bit hash of its bytes. Bytes in
    ``cuts`` also separate words.
    """
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    text_starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
    is_space = _IS_SPACE
    if cuts:
        is_space = _IS_SPACE.copy()
        is_space[list(cuts)] = True
    inside = ~is_space[buf]
    edge = np.diff(np.concatenate(([False], inside)).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return buf, text_starts, none, none, none, np.zeros(0, np.uint64)
    power, inverse = _powers(len(buf))
    weighed = buf.astype(np.uint64)
    weighed += np.uint64(1)
    weighed *= inside  # what is between two words adds nothing to the first: the hashes of ``span_hashes``
    weighed *= power[: len(buf)]
    hashes = mix64(np.add.reduceat(weighed, starts) * inverse[starts])
    words = np.diff(np.searchsorted(starts, text_starts), append=len(starts))
    return buf, text_starts, starts, ends, np.repeat(np.arange(len(texts)), words), hashes
