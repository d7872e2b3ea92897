"""Grace marks.

A member's row of a subject gets the grace rule on one test when

* the member's group takes the subject,
* the map mean of the member's row in that subject is above
  ``subject_threshold`` (50), and
* the mean of the same member (group, class and id) in the grace test over all
  their subjects (exploded path, NULL marks skipped) is above ``test_threshold`` (50).

Without ``class_id`` / ``subject_id`` every (class, subject) pair is handled at
once, each exactly as if the job had been run for that pair alone.

Plan: one scan of the class's score rows and one shuffle by member; the
grace-test mean is a window over the member's rows (as many as the member has
subjects), after which the rows of the subject are picked. No id list is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeframe import schemas as S
from gradeframe.functions.names import full_name
from gradeframe.functions.scores import grace_map, map_mean
from gradeframe.operators.dims import restrict
from gradeframe.operators.tables import same_keys


def flag_eligible(marks: DataFrame, class_id: int | None = None, subject_id: int | None = None,
                  test_id: int = S.GRACE_TEST_ID,
                  subject_threshold: float = S.GRACE_SUBJECT_THRESHOLD,
                  test_threshold: float = S.GRACE_TEST_THRESHOLD,
                  class_ids: DataFrame | None = None,
                  subject_ids: DataFrame | None = None,
                  subject_group: DataFrame | None = None) -> DataFrame:
    """The subject rows in scope with an ``eligible`` flag.

    The scope is given by ids (``class_id``, ``subject_id``) or by one-column
    id DataFrames (``class_ids``, ``subject_ids``, e.g. from a name lookup). The
    grace-test mean always covers all of a member's subjects. ``subject_group``
    (group_id, subject_id) restricts the rows to groups that take the subject.
    """
    in_class = restrict(marks, "class_id", class_id, class_ids)
    member = Window.partitionBy(*S.STUDENT_KEYS)
    with_mean = in_class.select(
        *S.MARK_KEYS, "test_marks",
        F.avg(F.try_element_at("test_marks", F.lit(test_id))).over(member).alias("_test_mean"))
    scope = restrict(with_mean, "subject_id", subject_id, subject_ids)
    if subject_group is not None:
        scope = scope.join(subject_group.select("group_id", "subject_id").distinct(),
                           ["group_id", "subject_id"], "left_semi")
    return scope.select(
        *S.MARK_KEYS, "test_marks",
        (F.coalesce(F.col("_test_mean") > F.lit(test_threshold), F.lit(False))
         & F.coalesce(map_mean("test_marks") > F.lit(subject_threshold), F.lit(False))
         ).alias("eligible"))


def next_marks(marks: DataFrame, adjusted: DataFrame, class_id: int | None = None,
               subject_id: int | None = None, class_ids: DataFrame | None = None,
               subject_ids: DataFrame | None = None) -> DataFrame:
    """The whole marks table after grace: same result as upserting ``adjusted``
    (the rows in scope, rewritten) into ``marks``, without a join on the large
    table. Rows outside the scope pass through as they are (a filter, or a join
    with the small id frames); only the rows in scope were shuffled, for their
    eligibility. NULL ids are outside every scope, as in ``flag_eligible``.
    """
    rows, in_scope = marks, F.lit(True)
    if class_id is not None:
        in_scope = in_scope & (F.col("class_id") == F.lit(class_id))
    if subject_id is not None:
        in_scope = in_scope & (F.col("subject_id") == F.lit(subject_id))
    for col, ids in (("class_id", class_ids), ("subject_id", subject_ids)):
        if ids is not None:
            flag = f"_in_{col}"
            rows = rows.join(ids.select(col).distinct().withColumn(flag, F.lit(True)), col, "left")
            in_scope = in_scope & F.coalesce(F.col(flag), F.lit(False))
    outside = rows.where(~F.coalesce(in_scope, F.lit(False))).select(*marks.columns)
    return outside.unionByName(adjusted.select(*marks.columns))


def grace_eligible(flagged: DataFrame) -> DataFrame:
    """Keys (group_id, class_id, subject_id, student_id) of the eligible rows."""
    return flagged.where("eligible").select(*S.MARK_KEYS)


def grace_adjust(flagged: DataFrame, test_id: int = S.GRACE_TEST_ID, amount: float = S.GRACE_AMOUNT,
                 boundary: float = S.GRACE_BOUNDARY) -> DataFrame:
    """All rows in scope, eligible ones with the grace rule applied to ``test_id``.

    Keeps ``test_marks_before`` and ``eligible`` next to the new ``test_marks``.
    """
    return flagged.select(
        *S.MARK_KEYS,
        F.when(F.col("eligible"), grace_map("test_marks", test_id, amount, boundary))
        .otherwise(F.col("test_marks")).alias("test_marks"),
        F.col("test_marks").alias("test_marks_before"),
        "eligible",
    )


def adjusted_scores(adjusted: DataFrame) -> DataFrame:
    """Exploded adjusted marks with a ``changed`` flag per entry (NULL marks kept)."""
    pairs = adjusted.select(
        *S.MARK_KEYS,
        F.explode(F.map_zip_with("test_marks_before", "test_marks",
                                 lambda k, old, new: F.struct(old.alias("old"), new.alias("new"))))
        .alias("test_id", "pair"),
    )
    return pairs.select(
        *S.MARK_KEYS, "test_id",
        F.col("pair.new").alias("mark"),
        F.coalesce(F.col("pair.new") != F.col("pair.old"), F.lit(False)).alias("changed"),
    )


def eligible_names(eligible: DataFrame, students: DataFrame) -> DataFrame:
    """Full names ("first last", NULL parts empty) of the eligible members, joined on the member's whole
    key (NULL-safe: a member without a class has a name too)."""
    members = students.select(*S.STUDENT_KEYS, full_name(F.col("firstname"), F.col("lastname")).alias("full_name"))
    return eligible.join(members, same_keys(eligible, members, S.STUDENT_KEYS)).select(
        *[eligible[k] for k in S.MARK_KEYS], "full_name")


def stored_before_after(stored: DataFrame, after: DataFrame) -> DataFrame:
    """The stored pass percentage beside the one after grace, per (class, subject) of ``after``
    or of ``stored`` (restricted by the caller to the job's scope); a side that is absent is NULL."""
    none = F.lit(None).cast("double")
    both = (stored.select(*S.PASS_KEYS, F.col("pass_percentage").alias("before_pct"), none.alias("after_pct"))
            .unionByName(after.select(*S.PASS_KEYS, none.alias("before_pct"), F.col("pass_percentage").alias("after_pct"))))
    return both.groupBy(*S.PASS_KEYS).agg(F.max("before_pct").alias("before_pct"), F.max("after_pct").alias("after_pct"))


def pass_rate_before_after(adjusted: DataFrame, threshold: float = S.PASS_THRESHOLD,
                           keep_zero: bool = False) -> DataFrame:
    """Pass percentage per (class, subject) before and after grace, in one aggregate.

    A side without any pass is NULL (absent in the original report) unless
    ``keep_zero``; pairs with no pass on either side are dropped unless
    ``keep_zero``.
    """
    agg = adjusted.groupBy("class_id", "subject_id").agg(
        F.count("student_id").alias("n"),
        F.count(F.when(map_mean("test_marks_before") > F.lit(threshold), F.col("student_id"))).alias("pb"),
        F.count(F.when(map_mean("test_marks") > F.lit(threshold), F.col("student_id"))).alias("pa"),
    )

    def pct(c):
        rate = F.col(c) / F.col("n") * F.lit(100)
        return rate if keep_zero else F.when(F.col(c) > 0, rate)

    if not keep_zero:
        agg = agg.where((F.col("pb") > 0) | (F.col("pa") > 0))
    return agg.select("class_id", "subject_id", pct("pb").alias("before_pct"), pct("pa").alias("after_pct"))
