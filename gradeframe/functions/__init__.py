"""Column-level functions (native Spark expressions only)."""

from gradeframe.functions.ids import class_bucket, dense_ids, group_bucket
from gradeframe.functions.names import capitalize_first, full_name, name_matches
from gradeframe.functions.scores import (
    build_score_map, explode_scores, grace_map, grace_value, map_mark_sum, map_mean,
    map_null_count, map_sum, map_test_ids,
)

__all__ = [
    "build_score_map", "capitalize_first", "class_bucket", "dense_ids", "explode_scores",
    "full_name", "grace_map", "grace_value", "group_bucket", "map_mark_sum", "map_mean",
    "map_null_count", "map_sum", "map_test_ids", "name_matches",
]
