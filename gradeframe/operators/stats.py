"""Means, counts, pass rates, best and worst test.

All aggregates are on flat grouping columns, so Spark plans partial (map-side)
aggregation before each shuffle: a key that holds a large share of the rows is
reduced to one row per map task before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeframe import schemas as S
from gradeframe.functions.scores import explode_scores, map_mean
from gradeframe.operators.dims import restrict


def score_map_means(marks: DataFrame) -> DataFrame:
    """Map mean per marks row (NULL mark = 0; empty/NULL map -> NULL)."""
    return marks.select(*S.MARK_KEYS, map_mean("test_marks").alias("average"))


def subject_mean_of_student(marks: DataFrame, student_id: int | None = None,
                            subject_id: int | None = None) -> DataFrame:
    """Map mean of a member's marks in a subject (all members / subjects when None)."""
    rows = restrict(restrict(marks, "student_id", student_id), "subject_id", subject_id)
    return rows.select("student_id", "subject_id", map_mean("test_marks").alias("average"))


def test_means(marks: DataFrame, class_id: int | None = None, subject_id: int | None = None) -> DataFrame:
    """Mean mark per (class, subject, test) over exploded, non-NULL marks."""
    rows = restrict(restrict(marks, "class_id", class_id), "subject_id", subject_id)
    return (explode_scores(rows).groupBy("class_id", "subject_id", "test_id")
            .agg(F.avg("mark").alias("mean_mark")))


def best_worst_test(means: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Best and worst test by mean per group of ``by``; ties go to the lower test id.

    ``gap_over_100`` is (best - worst) / 100, the figure the original report
    prints as a "percentage increase"; ``relative_increase_pct`` is the relative
    increase (NULL when the worst mean is 0).
    """
    by = by if by is not None else ["class_id", "subject_id"]
    agg = means.groupBy(*by).agg(
        F.max_by("test_id", F.struct(F.col("mean_mark"), -F.col("test_id"))).alias("best_test"),
        F.max("mean_mark").alias("best_mean"),
        F.min_by("test_id", F.struct(F.col("mean_mark"), F.col("test_id"))).alias("worst_test"),
        F.min("mean_mark").alias("worst_mean"),
    )
    return agg.select(
        *by, "best_test", "best_mean", "worst_test", "worst_mean",
        ((F.col("best_mean") - F.col("worst_mean")) / F.lit(100.0)).alias("gap_over_100"),
        (F.try_divide(F.col("best_mean") - F.col("worst_mean"), F.col("worst_mean"))
         * F.lit(100.0)).alias("relative_increase_pct"),
    )


def member_count(marks: DataFrame) -> DataFrame:
    """Members with a marks row per (class, subject)."""
    return (marks.groupBy("class_id", "subject_id")
            .agg(F.count("student_id").alias("student_count")))


def pass_count(marks: DataFrame, threshold: float = S.PASS_THRESHOLD) -> DataFrame:
    """Members whose map mean is strictly above ``threshold``; pairs with none are absent."""
    means = score_map_means(marks)
    return (means.where(F.col("average") > F.lit(threshold))
            .groupBy("class_id", "subject_id").agg(F.count("student_id").alias("student_pass")))


def pass_rate(marks: DataFrame, threshold: float = S.PASS_THRESHOLD,
              keep_zero: bool = False, class_id: int | None = None,
              subject_id: int | None = None) -> DataFrame:
    """Pass percentage per (class, subject) in a single aggregate (one shuffle).

    A member with a NULL mean (empty or NULL map) is counted but does not pass.
    Pairs without any pass are absent unless ``keep_zero`` (then 0.0).
    """
    rows = restrict(restrict(marks, "class_id", class_id), "subject_id", subject_id)
    counts = score_map_means(rows).groupBy("class_id", "subject_id").agg(
        F.count("student_id").alias("student_count"),
        F.count(F.when(F.col("average") > F.lit(threshold), F.col("student_id"))).alias("student_pass"),
    )
    if not keep_zero:
        counts = counts.where(F.col("student_pass") > 0)
    return counts.select(
        "class_id", "subject_id",
        (F.col("student_pass") / F.col("student_count") * F.lit(100)).alias("pass_percentage"),
    )


def student_test_means(marks: DataFrame, class_id: int | None = None) -> DataFrame:
    """Mean mark per (member, test) over all the member's subjects (exploded path).

    The map rows are dealt by member before they are exploded: this aggregate and
    a following one per member then need no further shuffle."""
    rows = restrict(marks, "class_id", class_id).repartition("class_id", "student_id")
    return (explode_scores(rows).groupBy("class_id", "student_id", "test_id")
            .agg(F.avg("mark").alias("average_marks")))


def student_total_mean(test_means_df: DataFrame) -> DataFrame:
    """Mean of a member's test means: each test weighs the same, whatever its subject count.

    The means of a member (at most one per test) are added in test order, so the
    double does not depend on the order in which rows arrive."""
    means = F.array_sort(F.collect_list(F.struct("test_id", "average_marks")))
    total = F.aggregate(F.col("_means"), F.lit(0.0), lambda acc, m: acc + m["average_marks"])
    return (test_means_df.groupBy("class_id", "student_id").agg(means.alias("_means"))
            .select("class_id", "student_id", (total / F.size("_means")).alias("total_average")))


def members_mean_over(marks: DataFrame, test_id: int = S.GRACE_TEST_ID,
                      threshold: float = S.GRACE_TEST_THRESHOLD,
                      class_id: int | None = None) -> DataFrame:
    """Members (group_id, class_id, student_id) whose mean in ``test_id`` over all their
    subjects is strictly above ``threshold``.

    Reads the one map entry directly (NULL when absent; ``avg`` skips NULLs, as
    the exploded path does) instead of exploding every entry and filtering.
    """
    rows = restrict(marks, "class_id", class_id)
    return (rows.select(*S.STUDENT_KEYS, F.try_element_at("test_marks", F.lit(test_id)).alias("mark"))
            .groupBy(*S.STUDENT_KEYS).agg(F.avg("mark").alias("average"))
            .where(F.col("average") > F.lit(threshold)))


def ranked_test_means(means: DataFrame) -> DataFrame:
    """Test means with their place in the (class, subject): best first, ties to the lower test id."""
    order = Window.partitionBy("class_id", "subject_id").orderBy(F.desc("mean_mark"), "test_id")
    return means.withColumn("rank", F.row_number().over(order))


def test_statistics(means: DataFrame) -> DataFrame:
    """Every test mean with its rank in the (class, subject), beside the columns of ``best_worst_test``
    for that pair: one shuffle of the means serves both."""
    pair = Window.partitionBy("class_id", "subject_id")
    best = F.max(F.struct(F.col("mean_mark").alias("mean"), (-F.col("test_id")).alias("test"))).over(pair)
    worst = F.min(F.struct(F.col("mean_mark").alias("mean"), F.col("test_id").alias("test"))).over(pair)
    gap = F.col("best.mean") - F.col("worst.mean")
    return ranked_test_means(means).withColumns({"best": best, "worst": worst}).select(
        "class_id", "subject_id", "test_id", "mean_mark", "rank", (-F.col("best.test")).alias("best_test"), F.col("worst.test").alias("worst_test"),
        (gap / F.lit(100.0)).alias("gap_over_100"), (F.try_divide(gap, F.col("worst.mean")) * F.lit(100.0)).alias("relative_increase_pct"))


def stored_pass_rate(stored: DataFrame, class_id: int, subject_id: int) -> DataFrame:
    """The stored pass percentage of one (class, subject): a filter that Spark pushes to the files."""
    return stored.where((F.col("class_id") == F.lit(class_id)) & (F.col("subject_id") == F.lit(subject_id)))
