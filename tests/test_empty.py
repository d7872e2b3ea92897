"""Empty in, empty out: no operator fails or invents rows on empty input."""

from conftest import marks_frame, students_frame
from gradeframe import schemas as S
from gradeframe.functions import explode_scores
from gradeframe.operators import dims, grace, stats, tables, topk


def test_empty_marks(spark):
    m = marks_frame(spark, [])
    assert explode_scores(m).count() == 0
    assert stats.pass_rate(m).count() == 0
    assert stats.pass_rate(m, keep_zero=True).count() == 0
    means = stats.test_means(m)
    assert means.count() == 0 and stats.best_worst_test(means).count() == 0
    per_test = stats.student_test_means(m)
    assert topk.top_per_test(per_test).count() == 0
    assert topk.top_overall(stats.student_total_mean(per_test)).count() == 0
    adj = grace.grace_adjust(grace.flag_eligible(m))
    assert grace.adjusted_scores(adj).count() == 0
    assert grace.pass_rate_before_after(adj).count() == 0


def test_member_without_marks_gives_no_mean(spark):
    m = marks_frame(spark, [(1, 2, 3, 1, {1: 50.0})])
    assert stats.subject_mean_of_student(m, student_id=2).count() == 0


def test_empty_tables_operations(spark):
    st = students_frame(spark, [])
    m = marks_frame(spark, [])
    out = tables.archive(st, m, st.select(*S.STUDENT_KEYS), "2024-06-30")
    assert all(df.count() == 0 for df in out.values())
    stored = spark.createDataFrame([(2, 3, 50.0)], S.PASS_PERCENTAGE)
    empty = spark.createDataFrame([], S.PASS_PERCENTAGE)
    assert [tuple(r) for r in tables.upsert(stored, empty, S.PASS_KEYS).collect()] == [(2, 3, 50.0)]
    assert dims.members_of_class_groups(st, spark.createDataFrame([], S.SUBJECT_GROUP)).count() == 0
