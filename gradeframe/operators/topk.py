"""Deterministic top-k.

Ties are broken by ``student_id`` so every run returns the same rows. Per-key
top-k is ``row_number() <= k`` over a window; Spark plans it with a partial
``WindowGroupLimit`` on the map side, so each map task ships at most k rows per
key and a key holding most of the rows never gathers them in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeframe import schemas as S


def top_k_per(df: DataFrame, partition_by: list[str], order_by: list[Column], k: int,
              rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(k))


def top_per_test(test_means_df: DataFrame, k: int = S.TOP_K,
                 test_ids: list[int] | None = None) -> DataFrame:
    """Top k members by mean per (class, test); optionally only some tests."""
    df = test_means_df
    if test_ids is not None:
        df = df.where(F.col("test_id").isin(list(test_ids)))
    ranked = top_k_per(df, ["class_id", "test_id"],
                       [F.desc("average_marks"), F.asc("student_id")], k)
    return ranked.select("class_id", "test_id", "rank", "student_id", "average_marks")


def top_overall(totals: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Top k members by mean of test means per class."""
    ranked = top_k_per(totals, ["class_id"], [F.desc("total_average"), F.asc("student_id")], k)
    return ranked.select("class_id", "rank", "student_id", "total_average")


def top_lists(test_means_df: DataFrame, k: int = S.TOP_K, test_ids: list[int] | None = None) -> DataFrame:
    """Both kinds of list at once: the rows of ``top_per_test`` and, with a NULL test_id, of ``top_overall``.

    A member's means (one row a member, from an aggregate that needs no shuffle after the
    means') become one candidate per list, so the scores are read and dealt once."""
    means = F.array_sort(F.collect_list(F.struct("test_id", F.col("average_marks").alias("average"))))
    per_member = test_means_df.groupBy("class_id", "student_id").agg(means.alias("_means"))
    wanted = "_means" if test_ids is None else F.filter("_means", lambda m: m["test_id"].isin(list(test_ids)))
    total = F.aggregate("_means", F.lit(0.0), lambda acc, m: acc + m["average"]) / F.size("_means")
    overall = F.array(F.struct(F.lit(None).cast("int").alias("test_id"), total.alias("average")))
    lists = per_member.select("class_id", "student_id", F.inline(F.concat(wanted, overall)))
    ranked = top_k_per(lists, ["class_id", "test_id"], [F.desc("average"), F.asc("student_id")], k)
    return ranked.select("class_id", "test_id", "rank", "student_id", "average")
