import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gradeframe import schemas as S  # noqa: E402
from gradeframe.session import get_session  # noqa: E402

from gradeframe.plans.catalog import QUERIES  # noqa: E402

#: The queries of the score tables (other subpackages have tests of their own).
NAMES = sorted(QUERIES)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def marks_frame(spark, rows):
    """rows: (group_id, class_id, subject_id, student_id, {test: mark} or None)."""
    return spark.createDataFrame(rows, S.MARKS)


def students_frame(spark, rows):
    return spark.createDataFrame(rows, S.STUDENTS)


# Literal marks rows of the unit fixtures (class 2).
FIXTURE_MARKS = [
    (1, 2, 3, 1, {1: 60.0, 2: 50.0, 3: 40.0}),      # plain: mean 50, passes, not > 50
    (1, 2, 3, 2, {1: 90.0, 2: None, 3: 60.0}),      # NULL mark: map mean 50
    (1, 2, 3, 3, {}),                               # empty map
    (1, 2, 3, 4, None),                             # NULL map
    (1, 2, 4, 5, {1: 40.0, 2: 40.0, 3: 40.0}),      # exactly 40: not passed
    (1, 2, 3, 6, {1: 94.0, 2: 80.0, 3: 80.0}),      # grace edges
    (1, 2, 3, 7, {1: 95.0, 2: 80.0, 3: 80.0}),
    (1, 2, 3, 8, {1: 96.0, 2: 80.0, 3: 80.0}),
    (1, 2, 3, 9, {1: 100.0, 2: 80.0, 3: 80.0}),
    (1, 2, 5, 10, {1: 10.0, 2: 10.0, 3: 10.0}),     # zero-pass pair (2, 5)
    (1, 2, 5, 11, {1: 10.0, 2: 10.0, 3: 10.0}),
]


def rows(df, *cols):
    """Rows as sorted tuples, NULL first."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()),
                  key=lambda r: tuple((x is not None, x) for x in r))
