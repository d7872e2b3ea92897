"""Table schemas, primary keys and the fixed parameter defaults.

Ids that number rows of a fact-sized table (``student_id``) are 64-bit so that
they do not overflow at cluster scale; ids of small dimensions stay 32-bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

I = T.IntegerType()
L = T.LongType()
S = T.StringType()
D = T.DoubleType()

SCORE_MAP = T.MapType(T.IntegerType(), T.DoubleType(), valueContainsNull=True)

STUDENTS = T.StructType([
    T.StructField("group_id", I), T.StructField("class_id", I),
    T.StructField("student_id", L), T.StructField("firstname", S),
    T.StructField("lastname", S),
])
MARKS = T.StructType([
    T.StructField("group_id", I), T.StructField("class_id", I),
    T.StructField("subject_id", I), T.StructField("student_id", L),
    T.StructField("test_marks", SCORE_MAP),
])
MARKS_LONG = T.StructType([
    T.StructField("group_id", I), T.StructField("class_id", I),
    T.StructField("subject_id", I), T.StructField("student_id", L),
    T.StructField("test_id", I), T.StructField("mark", D),
])
PASS_PERCENTAGE = T.StructType([
    T.StructField("class_id", I), T.StructField("subject_id", I),
    T.StructField("pass_percentage", D),
])
STUDENTS_HISTORY = T.StructType(STUDENTS.fields + [T.StructField("date_of_leaving", T.DateType())])
GROUPS = T.StructType([T.StructField("group_id", I), T.StructField("group_name", S)])
CLASSES = T.StructType([T.StructField("class_id", I), T.StructField("class_name", S)])
SUBJECTS = T.StructType([T.StructField("subject_id", I), T.StructField("subject_name", S)])
TESTS = T.StructType([T.StructField("test_id", I), T.StructField("test_name", S)])
SUBJECT_GROUP = T.StructType([T.StructField("group_id", I), T.StructField("subject_id", I)])
CLASS_GROUP = T.StructType([T.StructField("class_id", I), T.StructField("group_id", I)])

# Result tables of one pass: the top lists (test_id NULL: the overall list) and the tests of a subject.
TOP_STUDENTS = T.StructType([
    T.StructField("class_id", I), T.StructField("test_id", I), T.StructField("rank", I),
    T.StructField("student_id", L), T.StructField("average", D),
])
TEST_STATISTICS = T.StructType([
    T.StructField("class_id", I), T.StructField("subject_id", I), T.StructField("test_id", I),
    T.StructField("mean_mark", D), T.StructField("rank", I), T.StructField("best_test", I),
    T.StructField("worst_test", I), T.StructField("gap_over_100", D), T.StructField("relative_increase_pct", D),
])

SCHEMAS = {
    "students": STUDENTS, "marks": MARKS, "marks_history": MARKS,
    "pass_percentage": PASS_PERCENTAGE, "students_history": STUDENTS_HISTORY,
    "groups": GROUPS, "classes": CLASSES, "subjects": SUBJECTS, "tests": TESTS,
    "subject_group_mapper": SUBJECT_GROUP, "class_group_mapper": CLASS_GROUP,
    "top_students": TOP_STUDENTS, "test_statistics": TEST_STATISTICS,
}

# Primary keys (upsert / delete replace or remove whole rows by these).
STUDENT_KEYS = ["group_id", "class_id", "student_id"]
MARK_KEYS = ["group_id", "class_id", "subject_id", "student_id"]
PASS_KEYS = ["class_id", "subject_id"]
KEYS = {
    "students": STUDENT_KEYS, "students_history": STUDENT_KEYS,
    "marks": MARK_KEYS, "marks_history": MARK_KEYS,
    "pass_percentage": PASS_KEYS,
    "groups": ["group_id"], "classes": ["class_id"], "subjects": ["subject_id"],
    "tests": ["test_id"],
    "subject_group_mapper": ["group_id", "subject_id"],
    "class_group_mapper": ["class_id", "group_id"],
    "top_students": ["class_id", "test_id", "rank"],
    "test_statistics": ["class_id", "subject_id", "test_id"],
}
# Key columns that a stored row must have: group and class of a member may be unknown.
REQUIRED = {name: [k for k in keys if k not in ("group_id", "class_id")] or keys for name, keys in KEYS.items()}
REQUIRED["top_students"] = ["rank", "student_id"]

# Fixed values of the modelled application (defaults of the parameters below).
PASS_THRESHOLD = 40          # a subject is passed when its map mean is strictly above this
GRACE_SUBJECT_THRESHOLD = 50  # grace: subject map mean strictly above this
GRACE_TEST_THRESHOLD = 50     # grace: mean of the grace test over all subjects strictly above this
GRACE_TEST_ID = 1             # the grace rule touches this test only
GRACE_AMOUNT = 5.0            # added to marks at or below GRACE_BOUNDARY
GRACE_BOUNDARY = 95.0         # marks above this are left unchanged
TOP_K = 3                     # size of the top lists
TOP_TESTS = (1, 2)            # tests the top-k operation lists by default
GROUP_BUCKET_WIDTH = 150      # id bucketing: students per group bucket
GROUP_BUCKETS = 3             # id bucketing: number of group buckets
CLASS_BUCKET_WIDTH = 450      # id bucketing: first class holds ids up to this
GROUP_LABEL_PREFIX = "group "
TEST_LABEL_PREFIX = "Test "

# Parameters used by the registered queries where an operation is about one
# member (the point lookup, the archive): the member id.
DEFAULT_STUDENT_ID = 10
# Fixed date used by the registered archive queries so repeated runs agree.
DEFAULT_LEAVING_DATE = "2024-06-30"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (the typed view of a scan)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
