"""Id helpers: dense numbering of distinct values, and id bucketing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeframe import schemas as S
from gradeframe.scratch import materialize


def dense_ids(df: DataFrame, value_col: str, id_col: str, name_col: str | None = None,
              num_ranges: int | None = None) -> DataFrame:
    """Number the distinct non-null values of ``value_col`` 1..n in ascending order.

    Same result as ``dense_rank() over (order by value_col)``, without moving the
    whole value set into one task: the distinct values are range-partitioned,
    sorted inside each range, numbered locally from ``monotonically_increasing_id``
    (partition index in the high bits, row position in the low 33 bits), and
    shifted by the sizes of the lower ranges. Only the per-range sizes (one row
    per range, bounded by the shuffle partition count) meet in one place.

    The locally numbered ranges are written once under ``spark.checkpoint.dir``:
    the range bounds come from sampling, so two separate evaluations of the
    range shuffle could cut the values differently, and the local numbers and
    the range sizes must come from the same cut. Inside each range the values
    are sorted (they are unique) before they are numbered, so a retried task
    numbers them the same. The range sizes (one row per range) become literals,
    so the result is one projection of the written table, with its real size.
    """
    vals = df.select(F.col(value_col)).where(F.col(value_col).isNotNull()).distinct()
    # Without an explicit count AQE may coalesce neighbouring ranges (order is kept).
    ranged = (vals.repartitionByRange(num_ranges, value_col) if num_ranges
              else vals.repartitionByRange(value_col))
    local = materialize(
        ranged
        .sortWithinPartitions(value_col)
        .select(
            value_col,
            F.spark_partition_id().alias("_range"),
            F.monotonically_increasing_id().alias("_mid"),
        )
        .select(
            value_col, "_range",
            (F.col("_mid") - F.shiftleft(F.col("_range").cast("long"), 33) + 1).alias("_local"),
        ), id_col, lasting=True)
    before, offsets = 0, [F.lit(-1), F.lit(0)]  # a map literal needs an entry
    for r in sorted(local.groupBy("_range").count().collect()):  # one row per range
        offsets += [F.lit(r["_range"]), F.lit(before)]
        before += r["count"]
    return local.select(
        (F.element_at(F.create_map(*offsets), F.col("_range")) + F.col("_local")).cast("int").alias(id_col),
        F.col(value_col).alias(name_col or value_col),
    )


def _ceil_div(value: Column, width: int) -> Column:
    """ceil(value / width) in integer arithmetic (a double is inexact above 2**53)."""
    return F.call_function("div", value + F.pmod(-value, F.lit(width)), F.lit(width))


def group_bucket(student_id: Column, width: int = S.GROUP_BUCKET_WIDTH,
                 buckets: int = S.GROUP_BUCKETS) -> Column:
    """Group of an id: consecutive blocks of ``width`` ids, folded onto 1..buckets."""
    block = _ceil_div(student_id, width)
    return (((block - 1) % buckets) + 1).cast("int")


def class_bucket(student_id: Column, width: int = S.CLASS_BUCKET_WIDTH) -> Column:
    """Class of an id: 1 for ids up to ``width``, 2 above."""
    return F.when(_ceil_div(student_id, width) > 1, F.lit(2)).otherwise(F.lit(1)).cast("int")
