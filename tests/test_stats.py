from pyspark.sql import functions as F

from conftest import FIXTURE_MARKS, marks_frame, rows
from gradeframe.operators import stats


def test_pass_rate_semantics(spark):
    m = marks_frame(spark, FIXTURE_MARKS)
    got = {(c, s): p for c, s, p in rows(stats.pass_rate(m))}
    # subject 3: 8 members (incl. empty and NULL map); passes: 1, 2, 6, 7, 8, 9
    assert got[(2, 3)] == 6 / 8 * 100
    assert (2, 4) not in got          # exactly 40 is not a pass
    assert (2, 5) not in got          # zero-pass pair is absent
    kz = {(c, s): p for c, s, p in rows(stats.pass_rate(m, keep_zero=True))}
    assert kz[(2, 5)] == 0.0 and kz[(2, 4)] == 0.0


def test_counts(spark):
    m = marks_frame(spark, FIXTURE_MARKS)
    assert rows(stats.member_count(m)) == [(2, 3, 8), (2, 4, 1), (2, 5, 2)]
    assert rows(stats.pass_count(m)) == [(2, 3, 6)]


def test_pass_count_never_above_member_count(spark):
    from gradeframe.sources import load
    t = load(spark, "/root/testdata/sf0.001")
    j = stats.member_count(t.marks).join(stats.pass_count(t.marks), ["class_id", "subject_id"])
    assert j.where(F.col("student_pass") > F.col("student_count")).count() == 0


def test_test_means_and_best_worst(spark):
    m = marks_frame(spark, [
        (1, 2, 3, 1, {1: 60.0, 2: 80.0, 3: 60.0}),
        (1, 2, 3, 2, {1: 60.0, 2: 40.0, 3: 60.0}),
    ])
    means = stats.test_means(m)
    assert rows(means) == [(2, 3, 1, 60.0), (2, 3, 2, 60.0), (2, 3, 3, 60.0)]
    bw = stats.best_worst_test(means).first().asDict()
    # all tied: best and worst both go to the lower test id
    assert bw["best_test"] == 1 and bw["worst_test"] == 1
    assert bw["gap_over_100"] == 0.0 and bw["relative_increase_pct"] == 0.0


def test_best_worst_gap(spark):
    m = marks_frame(spark, [(1, 2, 3, 1, {1: 50.0, 2: 80.0, 3: 40.0})])
    bw = stats.best_worst_test(stats.test_means(m)).first().asDict()
    assert (bw["best_test"], bw["worst_test"]) == (2, 3)
    assert bw["gap_over_100"] == (80.0 - 40.0) / 100
    assert bw["relative_increase_pct"] == (80.0 - 40.0) / 40.0 * 100


def test_best_worst_zero_worst_mean(spark):
    m = marks_frame(spark, [(1, 2, 3, 1, {1: 0.0, 2: 80.0})])
    bw = stats.best_worst_test(stats.test_means(m)).first().asDict()
    assert bw["relative_increase_pct"] is None


def test_subject_without_group_is_empty(spark):
    m = marks_frame(spark, FIXTURE_MARKS)
    assert stats.test_means(m, subject_id=99).count() == 0
    assert stats.pass_rate(m, subject_id=99).count() == 0


def test_mean_of_means_differs_from_mean_of_all(spark):
    m = marks_frame(spark, [
        (1, 2, 3, 1, {1: 90.0, 2: 30.0}),
        (1, 2, 4, 1, {1: 60.0}),
    ])
    per_test = stats.student_test_means(m)
    assert rows(per_test, "test_id", "average_marks") == [(1, 75.0), (2, 30.0)]
    total = stats.student_total_mean(per_test).first()["total_average"]
    assert total == 52.5
    assert total != (90.0 + 30.0 + 60.0) / 3


def test_members_mean_over_is_strict(spark):
    m = marks_frame(spark, [
        (1, 2, 3, 1, {1: 50.0}), (1, 2, 4, 1, {1: 50.0}),
        (1, 2, 3, 2, {1: 52.0}), (1, 2, 4, 2, {1: None}),
    ])
    assert rows(stats.members_mean_over(m)) == [(1, 2, 2, 52.0)]
