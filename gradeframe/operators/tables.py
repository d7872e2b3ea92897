"""Keyed table changes as set operations: upsert, delete, archive.

Each returns new DataFrames computed from one unmodified input snapshot; the
caller commits them as the next version of a store (``gradeframe.sources.store``).
History outputs are independent of live outputs, and nothing is read back from a
path being written. Keys compare NULL-safe: NULL equals NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeframe import schemas as S


def _duplicate_guard(count: Column, keys: list[str]) -> Column:
    """A condition that holds for one row a key and fails the query for more.

    As a filter it cannot be pruned with unused columns, so it also acts under
    ``count()`` and a select of the keys alone."""
    message = F.concat(F.lit("duplicate key in incoming rows: "), F.to_json(F.struct(*keys)))
    return F.when(count > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def unique_by_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; the query fails if ``rows`` holds a key twice.

    One aggregate with map-side partial aggregation, so even a key repeated many
    times is counted without gathering its rows in one task. The output is hash
    partitioned on ``keys``, which a following join on ``keys`` reuses.
    """
    others = [c for c in rows.columns if c not in keys]
    agg = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])
    return agg.where(_duplicate_guard(F.col("_n"), keys)).select(*rows.columns)


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Replace the rows of ``target`` whose key is in ``rows``; add the others.

    Whole rows are replaced (a NULL in ``rows`` is written as NULL), NULL is a key
    like any other, and a key that comes twice in ``rows`` fails the query.
    Running the same upsert twice gives the same table as running it once. One
    aggregate takes the incoming row of a key where there is one, else the stored.
    """
    others = [c for c in target.columns if c not in keys]
    both = (target.select(*target.columns, F.lit(0).alias("_new"))
            .unionByName(rows.select(*target.columns, F.lit(1).alias("_new"))))
    agg = both.groupBy(*keys).agg(
        F.sum("_new").alias("_n"), F.max_by(F.struct(F.lit(0).alias("_"), *others), "_new").alias("_row"))
    checked = agg.where(_duplicate_guard(F.col("_n"), keys))
    return checked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*target.columns)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """NULL-safe equality of the key columns of two frames."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def delete_by_key(target: DataFrame, key_rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the rows whose key appears in ``key_rows`` (NULL-safe anti join)."""
    gone = key_rows.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    match = reduce(lambda a, b: a & b, (target[k].eqNullSafe(gone[f"_{k}"]) for k in keys))
    return target.join(gone, match, "left_anti")


def select_by_key(target: DataFrame, key_rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``target`` whose key appears in ``key_rows`` (NULL-safe semi join)."""
    kept = key_rows.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    match = reduce(lambda a, b: a & b, (target[k].eqNullSafe(kept[f"_{k}"]) for k in keys))
    return target.join(kept, match, "left_semi")


def archive(students: DataFrame, marks: DataFrame, member_keys: DataFrame, leaving_date=None,
            students_history: DataFrame | None = None,
            marks_history: DataFrame | None = None) -> dict[str, DataFrame]:
    """Move members (and their marks) to history.

    ``member_keys`` holds (group_id, class_id, student_id) of the members that
    leave. Returns ``students_live``, ``students_history`` (with
    ``date_of_leaving``), ``marks_live`` and ``marks_history``, each with the
    input's column order; together live and new history hold exactly the input
    rows. Unknown keys change nothing. Histories that exist already are extended:
    a row with a key that is there replaces it, as the keyed store does.
    """
    date = F.current_date() if leaving_date is None else F.to_date(F.lit(str(leaving_date)))
    left = (select_by_key(students, member_keys, S.STUDENT_KEYS).withColumn("date_of_leaving", date)
            .select(*students.columns, "date_of_leaving"))
    left_marks = select_by_key(marks, member_keys, S.STUDENT_KEYS)
    return {
        "students_history": left if students_history is None else upsert(students_history, left, S.STUDENT_KEYS),
        "students_live": delete_by_key(students, member_keys, S.STUDENT_KEYS),
        "marks_history": left_marks if marks_history is None else upsert(marks_history, left_marks, S.MARK_KEYS),
        "marks_live": delete_by_key(marks, member_keys, S.STUDENT_KEYS),
    }
