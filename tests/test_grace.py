from pyspark.sql import functions as F

from conftest import marks_frame, rows, students_frame
from gradeframe import schemas as S
from gradeframe.functions.scores import explode_scores
from gradeframe.operators import grace


def _marks(spark):
    return marks_frame(spark, [
        # student 1: subject 3 mean 70 (> 50), test-1 mean over subjects (94+60)/2 = 77 -> eligible
        (1, 2, 3, 1, {1: 94.0, 2: 60.0, 3: 56.0}),
        (1, 2, 4, 1, {1: 60.0, 2: 60.0, 3: 60.0}),
        # student 2: subject 3 mean 50 (not > 50) -> not eligible
        (1, 2, 3, 2, {1: 90.0, 2: 30.0, 3: 30.0}),
        (1, 2, 4, 2, {1: 90.0, 2: 90.0, 3: 90.0}),
        # student 3: subject 3 mean 80 but test-1 mean (40 + 50)/2 = 45 -> not eligible
        (1, 2, 3, 3, {1: 40.0, 2: 100.0, 3: 100.0}),
        (1, 2, 4, 3, {1: 50.0, 2: 50.0, 3: 50.0}),
        # student 4: 95 in test 1 -> 100; eligible
        (1, 2, 3, 4, {1: 95.0, 2: 95.0, 3: 95.0}),
    ])


def test_eligibility(spark):
    flagged = grace.flag_eligible(_marks(spark), class_id=2, subject_id=3)
    assert rows(grace.grace_eligible(flagged)) == [(1, 2, 3, 1), (1, 2, 3, 4)]


def test_all_pairs_equal_per_pair_runs(spark):
    m = _marks(spark)
    every = rows(grace.grace_eligible(grace.flag_eligible(m)))
    per_pair = (rows(grace.grace_eligible(grace.flag_eligible(m, class_id=2, subject_id=3)))
                + rows(grace.grace_eligible(grace.flag_eligible(m, class_id=2, subject_id=4))))
    assert every == sorted(per_pair)


def test_adjust_changes_only_test_one_and_never_lowers(spark):
    adj = grace.grace_adjust(grace.flag_eligible(_marks(spark), class_id=2, subject_id=3))
    scores = grace.adjusted_scores(adj)
    changed = rows(scores.where("changed"), "student_id", "test_id", "mark")
    assert changed == [(1, 1, 99.0), (4, 1, 100.0)]
    before = explode_scores(_marks(spark).where("subject_id = 3")).select(
        "student_id", "test_id", F.col("mark").alias("old"))
    j = scores.join(before, ["student_id", "test_id"])
    assert j.where("mark < old").count() == 0
    assert j.where("test_id <> 1 AND mark <> old").count() == 0


def test_names_and_rates(spark):
    st = students_frame(spark, [(1, 2, 1, "ann", None), (1, 2, 4, None, "lee"), (1, 2, 2, "x", "y")])
    flagged = grace.flag_eligible(_marks(spark), class_id=2, subject_id=3)
    names = rows(grace.eligible_names(grace.grace_eligible(flagged), st), "student_id", "full_name")
    assert names == [(1, "ann "), (4, " lee")]
    ba = rows(grace.pass_rate_before_after(grace.grace_adjust(flagged)))
    assert ba == [(2, 3, 100.0, 100.0)]


def test_grace_cannot_change_a_pass(spark):
    # Eligible rows have a subject mean above 50, so they pass already: the
    # after-rate equals the before-rate even though marks went up.
    m = marks_frame(spark, [(1, 2, 3, 1, {1: 60.0, 2: 50.0}), (1, 2, 3, 2, {1: 20.0, 2: 20.0})])
    adj = grace.grace_adjust(grace.flag_eligible(m))
    assert rows(grace.adjusted_scores(adj).where("changed"), "student_id", "mark") == [(1, 65.0)]
    assert rows(grace.pass_rate_before_after(adj)) == [(2, 3, 50.0, 50.0)]


def test_scope_by_id_frames_equals_scope_by_ids(spark):
    m = _marks(spark)
    by_id = rows(grace.grace_eligible(grace.flag_eligible(m, class_id=2, subject_id=3)))
    ids = spark.createDataFrame([(3,)], "subject_id int")
    cls = spark.createDataFrame([(2,)], "class_id int")
    by_frame = rows(grace.grace_eligible(grace.flag_eligible(m, class_ids=cls, subject_ids=ids)))
    assert by_id == by_frame == [(1, 2, 3, 1), (1, 2, 3, 4)]


def test_next_marks_equals_upsert_of_adjusted_rows(spark):
    from gradeframe import schemas as S
    from gradeframe.operators import tables
    m = _marks(spark).unionByName(marks_frame(spark, [(2, None, 3, 9, {1: 70.0}), (2, 2, None, 9, {1: 70.0})]))
    adj = grace.grace_adjust(grace.flag_eligible(m, class_id=2, subject_id=3)).select(*S.MARK_KEYS, "test_marks")

    def rows_any(df):  # rows may hold NULL ids
        return sorted((tuple(r) for r in df.collect()), key=repr)

    want = rows_any(tables.upsert(m, adj, S.MARK_KEYS))
    assert rows_any(grace.next_marks(m, adj, class_id=2, subject_id=3)) == want
    cls = spark.createDataFrame([(2,)], "class_id int")
    sub = spark.createDataFrame([(3,)], "subject_id int")
    assert rows_any(grace.next_marks(m, adj, class_ids=cls, subject_ids=sub)) == want
    assert grace.next_marks(m, adj, class_ids=cls, subject_ids=sub).count() == m.count()


def test_same_student_id_in_two_classes_and_two_groups(spark):
    """The test mean, the eligibility and the names are the member's own: (group, class, id)."""
    m = marks_frame(spark, [
        (1, 1, 3, 7, {1: 60.0}), (1, 2, 3, 7, {1: 20.0, 2: 100.0, 3: 100.0}),   # two classes
        (1, 1, 3, 8, {1: 60.0}), (2, 1, 3, 8, {1: 20.0, 2: 100.0, 3: 100.0}),   # two groups
    ])
    want = [(1, 1, 3, 7), (1, 1, 3, 8)]
    assert rows(grace.grace_eligible(grace.flag_eligible(m))) == want
    assert rows(grace.grace_eligible(grace.flag_eligible(m, class_id=1, subject_id=3))) == want
    st = students_frame(spark, [(1, 1, 7, "a", "x"), (1, 2, 7, "b", "y"), (1, 1, 8, "c", "z"), (2, 1, 8, "d", "w")])
    names = grace.eligible_names(grace.grace_eligible(grace.flag_eligible(m)), st)
    assert rows(names, "student_id", "full_name") == [(7, "a x"), (8, "c z")]


def test_only_groups_that_take_the_subject(spark):
    m = marks_frame(spark, [(1, 1, 3, 7, {1: 60.0}), (2, 1, 3, 8, {1: 60.0})])
    bridge = spark.createDataFrame([(1, 3), (2, 4)], S.SUBJECT_GROUP)
    assert rows(grace.grace_eligible(grace.flag_eligible(m, subject_group=bridge))) == [(1, 1, 3, 7)]


def test_stored_rate_is_the_before_side(spark):
    stored = spark.createDataFrame([(2, 3, 12.5)], S.PASS_PERCENTAGE)
    after = spark.createDataFrame([(2, 3, 50.0), (2, 4, 10.0)], S.PASS_PERCENTAGE)
    assert sorted(rows(grace.stored_before_after(stored, after)), key=str) == [(2, 3, 12.5, 50.0), (2, 4, None, 10.0)]
