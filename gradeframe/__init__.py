"""gradeframe: set-based PySpark jobs over assessment-score tables.

Tables (see ``gradeframe.schemas``): members (``students``) in groups and
classes, and one row per (group, class, subject, student) holding a map
``test_id -> mark``. Operators are plain ``DataFrame -> DataFrame`` functions
built from native Spark expressions; none of them triggers an action.

Layout:

* ``sources``   -- deriving the tables from the TPC-H-like inputs, and the
  parquet snapshot store that replaces the keyed sink.
* ``functions`` -- column-level helpers (map mean, grace rewrite, names, ids).
* ``operators`` -- relational operators (lookups, statistics, top-k, upsert,
  delete, archive, grace eligibility).
* ``plans``     -- the user-visible jobs and the registered query catalog.
"""

from gradeframe.session import get_session

__all__ = ["get_session"]
