"""Tables and folders under the session's shared scratch folder (``spark.checkpoint.dir``).

Every table that ``materialize`` writes is registered. One written inside a
``scratch_tables`` block lives as long as the block; any other, or one written as
``lasting``, until ``release`` is given a frame that reads it, or ``release_session``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from gradeframe.session import application_key, ensure_checkpoint_dir

#: Spark's setting to delete a query's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Scratch tables of each application, and those of the innermost open block of this thread.
_SESSION: dict[str, set[str]] = {}
_BLOCK: ContextVar[set[str] | None] = ContextVar("scratch_block", default=None)


def materialize(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """Write a derived table under the session's checkpoint folder and read it back.

    This cuts its lineage, and the re-read table carries its real file size, so
    Spark's own broadcast size check (``autoBroadcastJoinThreshold``) decides on
    measured bytes instead of a join estimate (the product of the inputs'
    sizes). Tables over the threshold are joined by shuffle as usual. The folder
    is the cluster's shared ``spark.checkpoint.dir``; a scratch folder is set only
    when none is configured. A ``lasting`` table outlives the ``scratch_tables`` block it is
    written in (for results that the session goes on using).
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    block = None if lasting else _BLOCK.get()
    (_SESSION.setdefault(application_key(spark), set()) if block is None else block).add(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # the written table is read from now on, not the shuffles that made it
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """A block whose scratch tables are deleted at its end, however it ends.

    Blocks nest: a table belongs to the innermost one. Frames that read such a table
    are of use inside the block only; write their rows before it ends."""
    block: set[str] = set()
    token = _BLOCK.set(block)
    try:
        yield
    finally:
        _BLOCK.reset(token)
        for path in block:
            delete_folder(spark, path)


def release(*frames: DataFrame) -> None:
    """Delete the scratch tables that the given frames read; other files they read stay."""
    for frame in frames:
        spark = frame.sparkSession
        mine = _SESSION.get(application_key(spark), set())
        read = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in frame.inputFiles()}
        for known in filter(None, (_BLOCK.get(), mine)):
            for path in [p for p in known if p.rsplit("/", 1)[-1] in read]:
                delete_folder(spark, path)
                known.discard(path)


def release_session(spark: SparkSession) -> None:
    """Delete all scratch tables that this application wrote outside of blocks."""
    for path in _SESSION.pop(application_key(spark), set()):
        delete_folder(spark, path)


def _folder(spark: SparkSession, path: str):
    """The file system and path object of ``path``, on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_state(spark: SparkSession, path: str) -> tuple:
    """(name, size, time of change) of each file of a table's folder; empty if there is none."""
    fs, target = _folder(spark, path)
    if not fs.exists(target):
        return ()
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(target)))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, sorted; none if it does not exist."""
    fs, target = _folder(spark, path)
    if not fs.exists(target):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below ``path``, sorted; none if it does not exist."""
    fs, target = _folder(spark, path)
    if not fs.exists(target):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(target) if f.isFile())


def matching_folders(spark: SparkSession, base: str, pattern: str) -> dict[str, float]:
    """Folders below ``base`` that a pattern of wildcards names, relative to it, with the time of their last change (seconds)."""
    fs, target = _folder(spark, f"{base}/{pattern}")
    depth = pattern.count("/") + 1
    found = fs.globStatus(target) or []
    return {"/".join(str(f.getPath().toUri().getPath()).split("/")[-depth:]): f.getModificationTime() / 1000 for f in found if f.isDirectory()}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file."""
    fs, target = _folder(spark, path)
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, target = _folder(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, source: str, target: str) -> bool:
    """Give a complete file its final name, at once and only if nothing has that name; False if something has.

    A local file is linked (``link`` fails where the name is taken). Elsewhere it is renamed
    without overwriting, which HDFS does in one step; a store without such a rename
    gives no protection against two writers at one moment."""
    fs, src = _folder(spark, source)
    dst = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(target))
    src = fs.makeQualified(src)
    jvm = spark._jvm
    try:
        if fs.getScheme() == "file":
            paths = jvm.java.nio.file.Paths
            jvm.java.nio.file.Files.createLink(paths.get(dst.toUri()), paths.get(src.toUri()))
            fs.delete(src, False)
        else:
            kind = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), spark._jsc.hadoopConfiguration()).rename(src, dst, kind)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            fs.delete(src, False)
            return False
        raise
    return True
