import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from conftest import FIXTURE_MARKS, marks_frame, rows, students_frame
from gradeframe import schemas as S
from gradeframe.operators import tables

STUDENTS = [(1, 2, i, f"first{i}", f"last{i}") for i in range(1, 12)]


def _rates(spark, data):
    return spark.createDataFrame(data, S.PASS_PERCENTAGE)


def test_upsert_replaces_and_adds(spark):
    stored = _rates(spark, [(2, 3, 50.0), (2, 4, 10.0)])
    out = tables.upsert(stored, _rates(spark, [(2, 3, 60.0), (2, 5, 1.0)]), S.PASS_KEYS)
    assert rows(out) == [(2, 3, 60.0), (2, 4, 10.0), (2, 5, 1.0)]


def test_upsert_twice_equals_once_and_last_wins(spark):
    stored = _rates(spark, [(2, 3, 50.0)])
    once = tables.upsert(stored, _rates(spark, [(2, 3, 70.0)]), S.PASS_KEYS)
    twice = tables.upsert(once, _rates(spark, [(2, 3, 70.0)]), S.PASS_KEYS)
    assert rows(once) == rows(twice) == [(2, 3, 70.0)]
    later = tables.upsert(once, _rates(spark, [(2, 3, 80.0)]), S.PASS_KEYS)
    assert rows(later) == [(2, 3, 80.0)]


def test_upsert_writes_null_values(spark):
    stored = _rates(spark, [(2, 3, 50.0)])
    out = tables.upsert(stored, _rates(spark, [(2, 3, None)]), S.PASS_KEYS)
    assert rows(out) == [(2, 3, None)]


def test_upsert_rejects_duplicate_keys(spark):
    stored = _rates(spark, [(2, 3, 50.0)])
    dup = _rates(spark, [(2, 3, 60.0), (2, 3, 61.0)])
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.upsert(stored, dup, S.PASS_KEYS).collect()


def test_upsert_of_map_rows(spark):
    stored = marks_frame(spark, FIXTURE_MARKS[:2])
    new = marks_frame(spark, [(1, 2, 3, 1, {1: 99.0})])
    out = {r["student_id"]: r["test_marks"] for r in tables.upsert(stored, new, S.MARK_KEYS).collect()}
    assert out == {1: {1: 99.0}, 2: {1: 90.0, 2: None, 3: 60.0}}


def test_delete_by_key(spark):
    m = marks_frame(spark, FIXTURE_MARKS)
    keys = students_frame(spark, [(1, 2, 1, "a", "b")])
    out = tables.delete_by_key(m, keys, S.STUDENT_KEYS)
    assert sorted(r[0] for r in out.select("student_id").collect()) == list(range(2, 12))


def test_archive_partitions_the_input(spark):
    st = students_frame(spark, STUDENTS)
    m = marks_frame(spark, FIXTURE_MARKS)
    keys = st.where("student_id = 1").select(*S.STUDENT_KEYS)
    out = tables.archive(st, m, keys, "2024-06-30")
    hist = out["students_history"].collect()
    assert len(hist) == 1 and str(hist[0]["date_of_leaving"]) == "2024-06-30"
    assert rows(out["students_live"].unionByName(out["students_history"].drop("date_of_leaving"))) == rows(st)
    # the archived member's marks are in history (not lost)
    assert rows(out["marks_history"], "student_id") == [(1,)]
    live_and_hist = out["marks_live"].unionByName(out["marks_history"])
    assert rows(live_and_hist, "student_id") == rows(m, "student_id")


def test_archive_unknown_id_changes_nothing(spark):
    st = students_frame(spark, STUDENTS)
    m = marks_frame(spark, FIXTURE_MARKS)
    keys = st.where("student_id = 999").select(*S.STUDENT_KEYS)
    out = tables.archive(st, m, keys, "2024-06-30")
    assert out["students_history"].count() == 0 and out["marks_history"].count() == 0
    assert rows(out["students_live"]) == rows(st)
    assert out["marks_live"].count() == m.count()


def test_outputs_keep_the_table_column_order(spark):
    st = students_frame(spark, STUDENTS)
    m = marks_frame(spark, FIXTURE_MARKS)
    keys = st.where("student_id = 1").select(*S.STUDENT_KEYS)
    out = tables.archive(st, m, keys, "2024-06-30")
    assert out["marks_live"].columns == out["marks_history"].columns == m.columns
    assert out["students_live"].columns == st.columns
    assert out["students_history"].columns == st.columns + ["date_of_leaving"]
    assert tables.delete_by_key(m, keys, S.STUDENT_KEYS).columns == m.columns
    assert tables.upsert(m, m.limit(1), S.MARK_KEYS).columns == m.columns


@pytest.mark.parametrize("use", [lambda d: d.count(), lambda d: d.select(*S.PASS_KEYS).collect(), lambda d: d.collect()])
def test_upsert_rejects_duplicate_keys_however_it_is_read(spark, use):
    dup = _rates(spark, [(2, 4, 60.0), (2, 4, 61.0)])
    with pytest.raises((PySparkException, Py4JJavaError)):
        use(tables.upsert(_rates(spark, [(2, 3, 50.0)]), dup, S.PASS_KEYS))


def test_null_keys_are_keys(spark):
    stored, new = _rates(spark, [(None, 3, 50.0), (2, 3, 1.0)]), _rates(spark, [(None, 3, 60.0), (2, None, 7.0)])
    once = tables.upsert(stored, new, S.PASS_KEYS)
    twice = tables.upsert(once, new, S.PASS_KEYS)
    want = [(2, 3, 1.0), (2, None, 7.0), (None, 3, 60.0)]
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str) == sorted(want, key=str)
    left = tables.delete_by_key(twice, _rates(spark, [(None, 3, 0.0)]), S.PASS_KEYS)
    assert sorted(map(tuple, left.collect()), key=str) == [(2, 3, 1.0), (2, None, 7.0)]


def test_second_archive_keeps_the_first_member(spark):
    st, m = students_frame(spark, STUDENTS), marks_frame(spark, FIXTURE_MARKS)
    keys = lambda i: st.where(f"student_id = {i}").select(*S.STUDENT_KEYS)
    one = tables.archive(st, m, keys(1), "2024-06-30")
    two = tables.archive(one["students_live"], one["marks_live"], keys(2), "2024-07-01",
                         one["students_history"], one["marks_history"])
    assert rows(two["students_history"], "student_id") == [(1,), (2,)]
    assert rows(two["marks_history"], "student_id") == [(1,), (2,)]
    assert two["students_live"].count() == len(STUDENTS) - 2
