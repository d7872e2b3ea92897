"""Dimension lookups, bridge joins, per-key lists, and dimension building.

Dimension and bridge tables are small, but no operator here hints a broadcast:
Spark's size check (``autoBroadcastJoinThreshold`` on estimates, then AQE on
measured sizes) broadcasts them when they are small and falls back to a
shuffle join when they are not. Id lists are never collected to the driver;
"id in (list)" becomes a semi join against the list as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe import schemas as S
from gradeframe.functions.ids import class_bucket, group_bucket
from gradeframe.functions.names import full_name, name_matches


# -- lookups ------------------------------------------------------------------

def point_lookup(students: DataFrame, student_id: int) -> DataFrame:
    """Rows of one member id (a pushed-down equality filter)."""
    return students.where(F.col("student_id") == F.lit(student_id))


def member_keys(students: DataFrame, student_id: int) -> DataFrame:
    """Distinct keys (group_id, class_id, student_id) of one member id; Spark's size check
    decides whether a join with them is a broadcast."""
    return point_lookup(students, student_id).select(*S.STUDENT_KEYS).distinct()


def ids_by_name(dim: DataFrame, id_col: str, name_col: str, name: str) -> DataFrame:
    """Ids whose name equals ``name`` ignoring case (a one-column DataFrame)."""
    return dim.where(name_matches(F.col(name_col), name)).select(id_col)


def rows_by_name(dim: DataFrame, name_col: str, name: str) -> DataFrame:
    """Rows of a dimension whose name equals ``name`` ignoring case."""
    return dim.where(name_matches(F.col(name_col), name))


def attach_name(df: DataFrame, dim: DataFrame, id_col: str, name_col: str,
                default: str = "") -> DataFrame:
    """Left join an id column to its name; a missing name becomes ``default``."""
    named = df.join(dim.select(id_col, name_col), id_col, "left")
    return named.withColumn(name_col, F.coalesce(F.col(name_col), F.lit(default)))


def restrict(df: DataFrame, col: str, value=None, ids: DataFrame | None = None) -> DataFrame:
    """Keep rows whose ``col`` equals ``value`` and/or appears in ``ids`` (semi join)."""
    if value is not None:
        df = df.where(F.col(col) == F.lit(value))
    if ids is not None:
        df = df.join(ids.select(col).distinct(), col, "left_semi")
    return df


# -- bridges ------------------------------------------------------------------

def groups_taking_subject(subject_group: DataFrame, subject_id: int | None = None) -> DataFrame:
    """(group_id, subject_id) pairs, optionally for one subject."""
    return restrict(subject_group.select("group_id", "subject_id"), "subject_id", subject_id)


def groups_of_class(class_group: DataFrame, class_id: int | None = None) -> DataFrame:
    """(class_id, group_id) pairs, optionally for one class."""
    return restrict(class_group.select("class_id", "group_id"), "class_id", class_id)


def group_takes_subject(students: DataFrame, subject_group: DataFrame, student_id: int,
                        subject_ids: DataFrame) -> DataFrame:
    """(subject_id, takes): whether the member's group takes each of the subjects.

    Tells "the group does not take it" apart from "no marks yet"."""
    group = point_lookup(students, student_id).select("group_id").distinct()
    taken = (subject_group.select("group_id", "subject_id").join(group, "group_id")
             .select("subject_id", F.lit(True).alias("_takes")).distinct())
    return (subject_ids.select("subject_id").distinct().join(taken, "subject_id", "left")
            .select("subject_id", F.coalesce("_takes", F.lit(False)).alias("takes")))


def enrollment_fanout(students: DataFrame, subject_group: DataFrame) -> DataFrame:
    """Each member times the subjects of the member's group: (student_id, subject_id)."""
    return (students.select("group_id", "student_id")
            .join(subject_group.select("group_id", "subject_id"), "group_id")
            .select("student_id", "subject_id"))


def members_of_class_groups(students: DataFrame, subject_group: DataFrame,
                            class_id: int | None = None, subject_id: int | None = None) -> DataFrame:
    """Roster per (class, subject): members of the class whose group takes the subject.

    With both ids given this is the roster of one class for one subject. Members
    without an id are dropped.
    """
    members = restrict(students, "class_id", class_id).where(F.col("student_id").isNotNull())
    pairs = groups_taking_subject(subject_group, subject_id)
    return (members.join(pairs, "group_id")
            .select("class_id", "subject_id", "student_id", "firstname", "lastname"))


def key_lists(bridge: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Per ``key`` the sorted distinct ``value``s as a comma list.

    The list is bounded by the size of the value dimension (e.g. the number of
    subjects), which must be small enough for one row.
    """
    return (bridge.groupBy(key)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_set(value)), lambda v: v.cast("string")),
                              ",").alias(out)))


def member_profile(students: DataFrame, groups: DataFrame, classes: DataFrame,
                   subjects: DataFrame, subject_group: DataFrame,
                   student_id: int | None = None) -> DataFrame:
    """Name, group name, class name and subject names (in subject id order) per member.

    The subject list of a group stands on each of its members' rows: meant for
    dimensions of subjects that stay small (hundreds); use the bridge otherwise."""
    subject_names = (
        subject_group.select("group_id", "subject_id").distinct()
        .join(subjects, "subject_id")
        .groupBy("group_id")
        .agg(F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("subject_id", "subject_name"))),
                        lambda s: s["subject_name"]), ", ").alias("subjects"))
    )
    members = restrict(students, "student_id", student_id)
    named = attach_name(members, groups, "group_id", "group_name")
    named = attach_name(named, classes, "class_id", "class_name")
    named = attach_name(named, subject_names, "group_id", "subjects")
    return named.select(
        "student_id",
        full_name(F.col("firstname"), F.col("lastname"), capitalize=True).alias("full_name"),
        "group_name", "class_name", "subjects",
    )


# -- building dimensions and bridges ------------------------------------------

def build_dimension(groups: DataFrame, classes: DataFrame, subjects: DataFrame,
                    tests: DataFrame) -> DataFrame:
    """All dimensions in one frame: (dimension, id, name, label).

    Numbered dimensions get a numbered label ("group 1", "Test 1"); named ones
    use their name.
    """
    def label(prefix, id_col):
        return F.concat(F.lit(prefix), F.col(id_col).cast("string"))

    return (
        groups.select(F.lit("groups").alias("dimension"), F.col("group_id").alias("id"),
                      F.col("group_name").alias("name"),
                      label(S.GROUP_LABEL_PREFIX, "group_id").alias("label"))
        .unionByName(classes.select(F.lit("classes").alias("dimension"), F.col("class_id").alias("id"),
                                    F.col("class_name").alias("name"), F.col("class_name").alias("label")))
        .unionByName(subjects.select(F.lit("subjects").alias("dimension"), F.col("subject_id").alias("id"),
                                     F.col("subject_name").alias("name"), F.col("subject_name").alias("label")))
        .unionByName(tests.select(F.lit("tests").alias("dimension"), F.col("test_id").alias("id"),
                                  F.col("test_name").alias("name"),
                                  label(S.TEST_LABEL_PREFIX, "test_id").alias("label")))
    )


def build_bridge(facts: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct (left, right) pairs of a fact table."""
    return facts.select(left, right).where(F.col(left).isNotNull() & F.col(right).isNotNull()).distinct()


def id_buckets(students: DataFrame) -> DataFrame:
    """Group and class of each member id by the fixed-width id bucketing rule."""
    return students.select(
        "student_id",
        group_bucket(F.col("student_id")).alias("group_id"),
        class_bucket(F.col("student_id")).alias("class_id"),
    )
