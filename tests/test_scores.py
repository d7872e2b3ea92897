from pyspark.sql import functions as F

from conftest import FIXTURE_MARKS, marks_frame, rows
from gradeframe.functions import (
    build_score_map, explode_scores, grace_map, map_mark_sum, map_mean, map_null_count, map_test_ids,
)


def test_map_mean_null_policies(spark):
    m = marks_frame(spark, FIXTURE_MARKS[:4])
    got = dict(m.select("student_id", map_mean("test_marks").alias("a")).collect())
    assert got[1] == 50.0
    assert got[2] == 50.0           # NULL mark counts as 0 and in the size
    assert got[3] is None           # empty map: NULL, never NaN
    assert got[4] is None           # NULL map


def test_map_mean_never_passes_on_empty(spark):
    m = marks_frame(spark, FIXTURE_MARKS[:4])
    passed = m.where(map_mean("test_marks") > 40).select("student_id").collect()
    assert sorted(r[0] for r in passed) == [1, 2]


def test_explode_skips_null_marks_and_maps(spark):
    m = marks_frame(spark, FIXTURE_MARKS[:4])
    got = rows(explode_scores(m), "student_id", "test_id", "mark")
    assert got == [(1, 1, 60.0), (1, 2, 50.0), (1, 3, 40.0), (2, 1, 90.0), (2, 3, 60.0)]
    kept = rows(explode_scores(m, keep_null=True), "student_id", "test_id")
    assert (2, 2) in kept and all(s in (1, 2) for s, _ in kept)


def test_map_summaries(spark):
    m = marks_frame(spark, FIXTURE_MARKS[:4])
    got = {r[0]: tuple(r[1:]) for r in m.select(
        "student_id", map_test_ids("test_marks"), F.size("test_marks"),
        map_null_count("test_marks"), map_mark_sum("test_marks")).collect()}
    assert got[1] == ("1,2,3", 3, 0, 150.0)
    assert got[2] == ("1,2,3", 3, 1, 150.0)
    assert got[3] == ("", 0, 0, None)


def test_grace_edges(spark):
    m = marks_frame(spark, FIXTURE_MARKS[5:9] + [(1, 2, 3, 12, {1: None, 2: 80.0})])
    out = m.select("student_id", grace_map("test_marks").alias("g"))
    got = {r[0]: r[1] for r in out.collect()}
    assert got[6] == {1: 99.0, 2: 80.0, 3: 80.0}
    assert got[7] == {1: 100.0, 2: 80.0, 3: 80.0}
    assert got[8] == {1: 96.0, 2: 80.0, 3: 80.0}   # above 95: unchanged, no cap
    assert got[9] == {1: 100.0, 2: 80.0, 3: 80.0}
    assert got[12] == {1: None, 2: 80.0}           # NULL stays NULL


def test_grace_touches_only_its_test(spark):
    m = marks_frame(spark, [(1, 2, 3, 6, {2: 80.0, 3: 80.0})])
    assert m.select(grace_map("test_marks")).first()[0] == {2: 80.0, 3: 80.0}


def test_explode_then_build_is_identity(spark):
    m = marks_frame(spark, FIXTURE_MARKS[:2] + FIXTURE_MARKS[4:])
    rebuilt = build_score_map(explode_scores(m, keep_null=True))
    assert rows(rebuilt) == rows(m)
