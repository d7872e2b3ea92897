from pyspark.sql import functions as F

from conftest import marks_frame, rows
from gradeframe.operators import stats, topk


def _tie_marks(spark):
    # test-1 means: s1 90, s2 80, then s3..s6 all 70 (tie at rank 3)
    data = [(1, 2, 3, 1, {1: 90.0, 2: 10.0}), (1, 2, 3, 2, {1: 80.0, 2: 20.0})]
    data += [(1, 2, 3, s, {1: 70.0, 2: 30.0}) for s in (6, 4, 5, 3)]
    return marks_frame(spark, data)


def test_tie_at_rank_three_keeps_lowest_id(spark):
    per_test = stats.student_test_means(_tie_marks(spark))
    top = rows(topk.top_per_test(per_test, test_ids=[1]), "rank", "student_id")
    assert top == [(1, 1), (2, 2), (3, 3)]


def test_top_per_test_every_test(spark):
    per_test = stats.student_test_means(_tie_marks(spark))
    top2 = rows(topk.top_per_test(per_test).where("test_id = 2"), "rank", "student_id")
    assert top2 == [(1, 3), (2, 4), (3, 5)]


def test_overall_matches_single_class_limit(spark):
    per_test = stats.student_test_means(_tie_marks(spark))
    totals = stats.student_total_mean(per_test)
    a = rows(topk.top_overall(totals), "student_id", "total_average")
    b = totals.where("class_id = 2").orderBy(F.desc("total_average"), "student_id").limit(3)
    assert a == rows(b, "student_id", "total_average") and len(a) == 3


def test_per_key_top_k_plans_partial_group_limit(spark):
    from gradeframe.sources import load
    t = load(spark, "/root/testdata/sf0.001")
    plan = topk.top_per_test(stats.student_test_means(t.marks))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_ranked_on_the_exact_mean(spark):
    """Means that differ only far behind the point are no tie."""
    data = [(1, 2, 3, 1, {1: 70.0}), (1, 2, 3, 2, {1: 70.0 + 1e-11}), (1, 2, 3, 3, {1: 70.0 + 2e-11})]
    totals = stats.student_total_mean(stats.student_test_means(marks_frame(spark, data)))
    assert rows(topk.top_overall(totals), "rank", "student_id") == [(1, 3), (2, 2), (3, 1)]
