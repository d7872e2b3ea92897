"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query derives its tables from the input parquet files and runs over the
whole of them. Operations that are about one member (the point lookup, the
archive, the delete, the grace upsert of one class and subject) take the member
or pair as a parameter, but their outputs still cover whole tables. All output
columns are flat (maps are exploded or summarised) and aliased to the names the
oracle SQL uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeframe import schemas as S
from gradeframe.functions.scores import (
    explode_scores, map_mark_sum, map_null_count, map_test_ids,
)
from gradeframe.operators import dims, grace, stats, tables, topk
from gradeframe.plans import jobs
from gradeframe.sources.model import load

# Parameters of the registered queries.
STUDENT_ID = S.DEFAULT_STUDENT_ID
NEXT_STUDENT_ID = S.DEFAULT_STUDENT_ID + 1
LEAVING_DATE = S.DEFAULT_LEAVING_DATE
GRACE_CLASS_ID = 2
GRACE_SUBJECT_ID = 3
LOOKUP_SUBJECT_NAME = "medium"
ENROLLED_AGAIN, LATER_LEAVING_DATE = "again", "2025-01-31"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# The same queries as functions of a tables object (``model.Tables`` derived
# from inputs, or ``store.StoredTables`` read from snapshots).
TABLE_QUERIES: dict[str, Callable] = {}


def query(fn):
    name = fn.__name__.removesuffix("_q")
    TABLE_QUERIES[name] = fn

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load(spark, sf_dir))

    run.__name__ = name
    run.__doc__ = fn.__doc__
    QUERIES[name] = run
    return fn


# -- lookups and rosters (O1, O2) --------------------------------------------

@query
def point_lookup(t):
    return dims.point_lookup(t.students, STUDENT_ID).select(*S.STUDENTS.fieldNames())


@query
def member_profile(t):
    return dims.member_profile(t.students, t.groups, t.classes, t.subjects, t.subject_group_mapper)


@query
def subject_mean_of_student(t):
    return stats.subject_mean_of_student(t.marks)


@query
def members_of_class_groups(t):
    return dims.members_of_class_groups(t.students, t.subject_group_mapper)


@query
def subject_by_name(t):
    return dims.rows_by_name(t.subjects, "subject_name", LOOKUP_SUBJECT_NAME)


@query
def group_subject_lists(t):
    return dims.key_lists(t.subject_group_mapper, "group_id", "subject_id", "subject_ids")


@query
def class_group_lists(t):
    return dims.key_lists(t.class_group_mapper, "class_id", "group_id", "group_ids")


# -- score maps ----------------------------------------------------------------

@query
def explode_scores_q(t):
    return explode_scores(t.marks)


@query
def score_map_build(t):
    m = t.marks
    return m.select(
        *S.MARK_KEYS,
        map_test_ids("test_marks").alias("test_ids"),
        F.size("test_marks").alias("n_tests"),
        map_null_count("test_marks").alias("n_null"),
        map_mark_sum("test_marks").alias("mark_sum"),
    )


@query
def score_map_mean(t):
    return stats.score_map_means(t.marks)


# -- statistics (O2, O3) -------------------------------------------------------

@query
def test_means_for_subject(t):
    return stats.test_means(t.marks)


@query
def test_means_ranked(t):
    return stats.ranked_test_means(stats.test_means(t.marks))


@query
def best_worst_test(t):
    return stats.best_worst_test(stats.test_means(t.marks))


@query
def test_statistics(t):
    return jobs.test_statistics(t)


@query
def member_count(t):
    return stats.member_count(t.marks)


@query
def pass_count(t):
    return stats.pass_count(t.marks)


@query
def pass_rate(t):
    return stats.pass_rate(t.marks)


# -- top k (O4) ----------------------------------------------------------------

@query
def student_test_means(t):
    return stats.student_test_means(t.marks)


@query
def student_total_mean(t):
    return stats.student_total_mean(stats.student_test_means(t.marks))


@query
def top3_per_test(t):
    return topk.top_per_test(stats.student_test_means(t.marks))


@query
def top3_overall(t):
    per_test = stats.student_test_means(t.marks)
    return topk.top_overall(stats.student_total_mean(per_test))


@query
def class_top_lists(t):
    return jobs.top_lists(t)


# -- grace marks (O6) ----------------------------------------------------------

@query
def members_mean_over(t):
    return stats.members_mean_over(t.marks)


@query
def grace_eligible(t):
    return grace.grace_eligible(grace.flag_eligible(t.marks, subject_group=t.subject_group_mapper))


@query
def grace_eligible_names(t):
    return grace.eligible_names(grace.grace_eligible(grace.flag_eligible(t.marks, subject_group=t.subject_group_mapper)), t.students)


@query
def grace_adjusted_scores(t):
    return grace.adjusted_scores(grace.grace_adjust(grace.flag_eligible(t.marks, subject_group=t.subject_group_mapper)))


@query
def grace_pass_rate_before_after(t):
    return grace.pass_rate_before_after(grace.grace_adjust(grace.flag_eligible(t.marks, subject_group=t.subject_group_mapper)))


@query
def grace_upsert_marks(t):
    new = jobs.grace_marks(t, subject_id=GRACE_SUBJECT_ID, class_id=GRACE_CLASS_ID)["marks"]
    return explode_scores(new, keep_null=True)


@query
def upsert_pass_rate(t):
    return jobs.grace_marks(t, subject_id=GRACE_SUBJECT_ID, class_id=GRACE_CLASS_ID)["pass_percentage"]


@query
def stored_pass_rate_lookup(t):
    return stats.stored_pass_rate(jobs.stored_rates(t), GRACE_CLASS_ID, GRACE_SUBJECT_ID)


@query
def group_takes_subject(t):
    return dims.group_takes_subject(t.students, t.subject_group_mapper, STUDENT_ID, t.subjects)


# -- table changes (O5) --------------------------------------------------------

@query
def delete_by_key(t):
    keys = dims.member_keys(t.students, STUDENT_ID)
    return tables.delete_by_key(t.marks, keys, S.STUDENT_KEYS).select(*S.MARK_KEYS)


def _archive(t):
    return jobs.archive_student(t, STUDENT_ID, LEAVING_DATE)


@query
def archive_students_live(t):
    return _archive(t)["students_live"]


@query
def archive_students_history(t):
    return _archive(t)["students_history"]


@query
def archive_history_append(t):
    first = _archive(t)["students_history"]
    return jobs.archive_student(t, NEXT_STUDENT_ID, LEAVING_DATE, students_history=first)["students_history"]


@query
def archive_again(t):
    """Archived, enrolled again under another name and archived again: the history holds the last row alone."""
    first = _archive(t)
    again = first["students_history"].select(*S.STUDENT_KEYS, "firstname", F.lit(ENROLLED_AGAIN).alias("lastname"))
    live = tables.upsert(first["students_live"], again, S.STUDENT_KEYS)
    keys = dims.member_keys(live, STUDENT_ID)
    return tables.archive(live, t.marks, keys, LATER_LEAVING_DATE, students_history=first["students_history"])["students_history"]


@query
def archive_marks_live(t):
    return explode_scores(_archive(t)["marks_live"], keep_null=True)


@query
def archive_marks_history(t):
    return explode_scores(_archive(t)["marks_history"], keep_null=True)


# -- filling the tables (O7) ---------------------------------------------------

@query
def build_dimension(t):
    return dims.build_dimension(t.groups, t.classes, t.subjects, t.tests)


@query
def build_bridge(t):
    return dims.build_bridge(t.students, "class_id", "group_id")


@query
def build_subject_bridge(t):
    return dims.build_bridge(t.marks, "group_id", "subject_id")


@query
def id_buckets(t):
    return dims.id_buckets(t.students)


@query
def enrollment_fanout(t):
    return dims.enrollment_fanout(t.students, t.subject_group_mapper)

