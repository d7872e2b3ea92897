"""Typed views of Parquet files: their schemas against the declared ones, before any of their rows is read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeframe import schemas as S

#: Each type can hold all values of those before it.
_NUMBERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


class SchemaMismatch(ValueError):
    """Stored rows that are not of the declared type."""


def fits(found: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of type ``found`` is one of type ``declared`` (the same type, or a narrower number)."""
    if isinstance(declared, T.MapType):
        return isinstance(found, T.MapType) and fits(found.keyType, declared.keyType) and fits(found.valueType, declared.valueType)
    if type(declared) in _NUMBERS and type(found) in _NUMBERS:
        return _NUMBERS.index(type(found)) <= _NUMBERS.index(type(declared))
    return type(found) is type(declared)


def check_schema(found: T.StructType, declared: T.StructType, where: str, but: tuple[str, ...] = ()) -> None:
    """Raise ``SchemaMismatch`` naming every column that is missing or does not fit; columns in ``but`` are not looked at."""
    have = {f.name: f.dataType for f in found.fields}
    wrong = []
    for f in declared.fields:
        if f.name in but:
            continue
        if f.name not in have:
            wrong.append(f"no column {f.name}")
        elif not fits(have[f.name], f.dataType):
            wrong.append(f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    if wrong:
        raise SchemaMismatch(f"{where}: {', '.join(wrong)}")


def files_schema(spark: SparkSession, paths: list[str], base: str | None = None) -> T.StructType:
    """The common schema of all files under ``paths``, from their footers; files that contradict each other raise."""
    reader = spark.read.option("mergeSchema", "true")
    try:
        return (reader.option("basePath", base) if base else reader).parquet(*paths).schema
    except Exception as e:
        if "CANNOT_MERGE_SCHEMA" in str(e) or "Failed to merge" in str(e) or "Failed merging schema" in str(e):
            raise SchemaMismatch(f"{paths[0]}: files of different types") from e
        raise


def open_typed(spark: SparkSession, paths: list[str], name: str, base: str | None = None) -> DataFrame:
    """The rows of the Parquet files under ``paths`` as those of table ``name``.

    Raises ``SchemaMismatch``, before it returns, for a column that the files lack or hold in a
    type that is not the declared one nor a narrower number, and for a row without an id that
    the table requires (``schemas.REQUIRED``; files whose statistics show none are not read).
    Narrower numbers are widened; other columns are left out."""
    declared = S.SCHEMAS[name]
    found = files_schema(spark, paths, base)
    check_schema(found, declared, f"{name} in {paths[0]}")
    reader = spark.read.schema(found)
    rows = S.conform((reader.option("basePath", base) if base else reader).parquet(*paths), declared)
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in S.REQUIRED[name]))
    if not rows.where(missing).isEmpty():
        raise SchemaMismatch(f"{name} in {paths[0]}: a row without {' or '.join(S.REQUIRED[name])}")
    return rows
