"""Column functions on the score map ``test_id -> mark``.

Two NULL policies, on purpose:

* map path (``map_mean``): a NULL mark counts as 0 in the sum and 1 in the
  size; an empty or NULL map has a NULL mean (never NaN: Spark orders NaN
  above every number, so ``NaN > 40`` would be true).
* exploded path (``explode_scores``): NULL marks are dropped by default, so
  ``avg`` over exploded rows skips them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeframe import schemas as S


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_sum(m: str | Column) -> Column:
    """Sum of the map's values with NULL marks as 0 (NULL for a NULL map)."""
    return F.aggregate(F.map_values(_col(m)), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def map_mean(m: str | Column) -> Column:
    """Mean of the map's values, NULL marks as 0; NULL for an empty or NULL map."""
    m = _col(m)
    return F.try_divide(map_sum(m), F.size(m).cast("double"))


def map_null_count(m: str | Column) -> Column:
    """Number of entries with a NULL mark."""
    return F.size(F.filter(F.map_values(_col(m)), lambda x: x.isNull()))


def map_mark_sum(m: str | Column) -> Column:
    """Sum of the non-NULL marks (NULL when there are none)."""
    vals = F.filter(F.map_values(_col(m)), lambda x: x.isNotNull())
    return F.when(F.size(vals) > 0, F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x))


def map_test_ids(m: str | Column) -> Column:
    """Comma list of the map's keys in ascending order."""
    return F.array_join(F.array_sort(F.map_keys(_col(m))), ",")


def explode_scores(marks: DataFrame, keep_null: bool = False,
                   keys: list[str] | None = None) -> DataFrame:
    """One row per (keys, test_id, mark) from the map column ``test_marks``.

    Rows with an empty or NULL map produce nothing. NULL marks are dropped unless
    ``keep_null``.
    """
    keys = keys if keys is not None else S.MARK_KEYS
    out = marks.select(*keys, F.explode("test_marks").alias("test_id", "mark"))
    if not keep_null:
        out = out.where(F.col("mark").isNotNull())
    return out


def build_score_map(marks_long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Fold long rows (keys, test_id, mark) into one map row per key.

    The input must hold one row per (keys, test_id): ``map_from_entries`` raises
    on a duplicate key. Entries are sorted by test id so the map is the same on
    every run. A map never holds more entries than there are tests.
    """
    keys = keys if keys is not None else S.MARK_KEYS
    return marks_long.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("test_id", "mark")))).alias("test_marks")
    )


def grace_value(mark: Column, amount: float = S.GRACE_AMOUNT,
                boundary: float = S.GRACE_BOUNDARY) -> Column:
    """Grace rule on one mark: at or below the boundary add ``amount``; else unchanged.

    Below 95 adds 5, exactly 95 becomes 100, above 95 (and NULL) stays as it is.
    """
    return F.when(mark <= F.lit(boundary), mark + F.lit(amount)).otherwise(mark)


def grace_map(m: str | Column, test_id: int = S.GRACE_TEST_ID, amount: float = S.GRACE_AMOUNT,
              boundary: float = S.GRACE_BOUNDARY) -> Column:
    """Apply ``grace_value`` to the entry of ``test_id`` only; other entries unchanged."""
    return F.transform_values(
        _col(m),
        lambda k, v: F.when(k == F.lit(test_id), grace_value(v, amount, boundary)).otherwise(v),
    )
