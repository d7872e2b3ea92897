"""Independent SQL for each registered query (DuckDB dialect).

Written from the table definitions, not from the Spark code: the derived tables
are common table expressions over the raw input views (region, nation,
customer, part, orders, lineitem), and every query is plain SQL over them.
"""

from __future__ import annotations

# Derived tables (mirrors the rules documented in gradeframe.sources.model).
PREFIX = """
WITH
subj AS (
  SELECT CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS subject_id, p_type AS subject_name
  FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) d),
cls AS (
  SELECT CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS class_id, c_mktsegment AS class_name
  FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL) d),
grp AS (SELECT CAST(r_regionkey + 1 AS INTEGER) AS group_id, r_name AS group_name FROM region),
tst AS (SELECT DISTINCT CAST(l_linenumber AS INTEGER) AS test_id FROM lineitem WHERE l_linenumber IS NOT NULL),
stud AS (
  SELECT CAST(n_regionkey + 1 AS INTEGER) AS group_id, cls.class_id,
         CAST(c_custkey + 1 AS BIGINT) AS student_id, c_name AS firstname, c_mktsegment AS lastname
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN cls ON c_mktsegment = cls.class_name),
ml AS (
  SELECT s.group_id, s.class_id, p.subject_id, s.student_id, CAST(l_linenumber AS INTEGER) AS test_id,
         CAST(2 * max(l_quantity) AS DOUBLE) AS mark
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey JOIN subj p ON p_type = p.subject_name
       JOIN stud s ON s.student_id = o_custkey + 1
  GROUP BY s.group_id, s.class_id, p.subject_id, s.student_id, l_linenumber),
sgm AS (SELECT DISTINCT group_id, subject_id FROM ml),
cgm AS (SELECT DISTINCT class_id, group_id FROM stud),
mrow AS (
  SELECT group_id, class_id, subject_id, student_id,
         sum(coalesce(mark, 0)) / count(*) AS average
  FROM ml GROUP BY group_id, class_id, subject_id, student_id),
stm AS (
  SELECT class_id, student_id, test_id, avg(mark) AS average_marks
  FROM ml WHERE mark IS NOT NULL GROUP BY class_id, student_id, test_id),
t1 AS (
  SELECT group_id, class_id, student_id FROM ml WHERE mark IS NOT NULL AND test_id = 1
  GROUP BY group_id, class_id, student_id HAVING avg(mark) > 50),
elig AS (
  SELECT m.group_id, m.class_id, m.subject_id, m.student_id FROM mrow m
  WHERE average > 50
    AND EXISTS (SELECT 1 FROM sgm g WHERE g.group_id = m.group_id AND g.subject_id = m.subject_id)
    AND EXISTS (SELECT 1 FROM t1 WHERE t1.group_id IS NOT DISTINCT FROM m.group_id
                AND t1.class_id IS NOT DISTINCT FROM m.class_id AND t1.student_id = m.student_id)),
adj AS (
  SELECT ml.*, e.student_id IS NOT NULL AS eligible,
         CASE WHEN e.student_id IS NOT NULL AND ml.test_id = 1 AND ml.mark <= 95
              THEN ml.mark + 5 ELSE ml.mark END AS new_mark
  FROM ml LEFT JOIN elig e
    ON ml.group_id IS NOT DISTINCT FROM e.group_id AND ml.class_id IS NOT DISTINCT FROM e.class_id
       AND ml.subject_id = e.subject_id AND ml.student_id = e.student_id),
member_keys AS (SELECT group_id, class_id, student_id FROM stud WHERE student_id = 10)
"""

_PASS_RATE = """
  SELECT class_id, subject_id,
         CAST(count(CASE WHEN average > 40 THEN student_id END) AS DOUBLE) / count(student_id) * 100e0
           AS pass_percentage
  FROM mrow GROUP BY class_id, subject_id
  HAVING count(CASE WHEN average > 40 THEN student_id END) > 0
"""

BODIES = {
    "point_lookup": """
SELECT group_id, class_id, student_id, firstname, lastname FROM stud WHERE student_id = 10""",

    "member_profile": """,
gsub AS (
  SELECT g.group_id, string_agg(s.subject_name, ', ' ORDER BY s.subject_id) AS subjects
  FROM sgm g JOIN subj s ON g.subject_id = s.subject_id GROUP BY g.group_id)
SELECT st.student_id,
       upper(substr(coalesce(st.firstname, ''), 1, 1)) || substr(coalesce(st.firstname, ''), 2)
         || ' ' || coalesce(st.lastname, '') AS full_name,
       coalesce(g.group_name, '') AS group_name, coalesce(c.class_name, '') AS class_name,
       coalesce(gs.subjects, '') AS subjects
FROM stud st LEFT JOIN grp g ON st.group_id = g.group_id
     LEFT JOIN cls c ON st.class_id = c.class_id
     LEFT JOIN gsub gs ON st.group_id = gs.group_id""",

    "subject_mean_of_student": """
SELECT student_id, subject_id, average FROM mrow""",

    "members_of_class_groups": """
SELECT s.class_id, g.subject_id, s.student_id, s.firstname, s.lastname
FROM stud s JOIN sgm g ON s.group_id = g.group_id WHERE s.student_id IS NOT NULL""",

    "subject_by_name": """
SELECT subject_id, subject_name FROM subj WHERE lower(subject_name) = 'medium'""",

    "group_subject_lists": """
SELECT group_id, string_agg(CAST(subject_id AS VARCHAR), ',' ORDER BY subject_id) AS subject_ids
FROM sgm GROUP BY group_id""",

    "class_group_lists": """
SELECT class_id, string_agg(CAST(group_id AS VARCHAR), ',' ORDER BY group_id) AS group_ids
FROM cgm GROUP BY class_id""",

    "explode_scores": """
SELECT group_id, class_id, subject_id, student_id, test_id, mark FROM ml WHERE mark IS NOT NULL""",

    "score_map_build": """
SELECT group_id, class_id, subject_id, student_id,
       string_agg(CAST(test_id AS VARCHAR), ',' ORDER BY test_id) AS test_ids,
       CAST(count(*) AS INTEGER) AS n_tests,
       CAST(count(*) - count(mark) AS INTEGER) AS n_null,
       sum(mark) AS mark_sum
FROM ml GROUP BY group_id, class_id, subject_id, student_id""",

    "score_map_mean": """
SELECT group_id, class_id, subject_id, student_id, average FROM mrow""",

    "test_means_for_subject": """
SELECT class_id, subject_id, test_id, avg(mark) AS mean_mark
FROM ml WHERE mark IS NOT NULL GROUP BY class_id, subject_id, test_id""",

    "best_worst_test": """,
tm AS (
  SELECT class_id, subject_id, test_id, avg(mark) AS mean_mark
  FROM ml WHERE mark IS NOT NULL GROUP BY class_id, subject_id, test_id),
b AS (
  SELECT class_id, subject_id, test_id AS best_test, mean_mark AS best_mean,
         row_number() OVER (PARTITION BY class_id, subject_id ORDER BY mean_mark DESC, test_id) AS rn
  FROM tm),
w AS (
  SELECT class_id, subject_id, test_id AS worst_test, mean_mark AS worst_mean,
         row_number() OVER (PARTITION BY class_id, subject_id ORDER BY mean_mark ASC, test_id) AS rn
  FROM tm)
SELECT b.class_id, b.subject_id, best_test, best_mean, worst_test, worst_mean,
       (best_mean - worst_mean) / 100e0 AS gap_over_100,
       CASE WHEN worst_mean = 0 THEN NULL ELSE (best_mean - worst_mean) / worst_mean * 100e0 END
         AS relative_increase_pct
FROM b JOIN w ON b.class_id = w.class_id AND b.subject_id = w.subject_id
WHERE b.rn = 1 AND w.rn = 1""",

    "member_count": """
SELECT class_id, subject_id, count(student_id) AS student_count FROM mrow GROUP BY class_id, subject_id""",

    "pass_count": """
SELECT class_id, subject_id, count(student_id) AS student_pass
FROM mrow WHERE average > 40 GROUP BY class_id, subject_id""",

    "pass_rate": _PASS_RATE,

    "student_test_means": """
SELECT class_id, student_id, test_id, average_marks FROM stm""",

    "student_total_mean": """
SELECT class_id, student_id,
       list_reduce(list(average_marks ORDER BY test_id), lambda a, b: a + b) / count(*) AS total_average
FROM stm GROUP BY class_id, student_id""",

    "top3_per_test": """
SELECT class_id, test_id, CAST(rn AS INTEGER) AS "rank", student_id, average_marks
FROM (SELECT *, row_number() OVER (PARTITION BY class_id, test_id
                                   ORDER BY average_marks DESC, student_id) AS rn FROM stm) r
WHERE rn <= 3""",

    "top3_overall": """,
tot AS (SELECT class_id, student_id,
               list_reduce(list(average_marks ORDER BY test_id), lambda a, b: a + b) / count(*) AS total_average
        FROM stm GROUP BY class_id, student_id)
SELECT class_id, CAST(rn AS INTEGER) AS "rank", student_id, total_average
FROM (SELECT *, row_number() OVER (PARTITION BY class_id
                                   ORDER BY total_average DESC, student_id) AS rn FROM tot) r
WHERE rn <= 3""",

    "class_top_lists": """,
inside AS (
  SELECT m.class_id, m.student_id, m.test_id, avg(m.mark) AS average_marks
  FROM ml m WHERE m.mark IS NOT NULL
    AND EXISTS (SELECT 1 FROM cgm g WHERE g.class_id = m.class_id AND g.group_id = m.group_id)
  GROUP BY m.class_id, m.student_id, m.test_id),
tot AS (SELECT class_id, student_id,
               list_reduce(list(average_marks ORDER BY test_id), lambda a, b: a + b) / count(*) AS total_average
        FROM inside GROUP BY class_id, student_id),
lists AS (
  SELECT class_id, test_id, student_id, average_marks AS average FROM inside WHERE test_id IN (1, 2)
  UNION ALL SELECT class_id, NULL, student_id, total_average FROM tot)
SELECT class_id, test_id, CAST(rn AS INTEGER) AS "rank", student_id, average
FROM (SELECT *, row_number() OVER (PARTITION BY class_id, test_id ORDER BY average DESC, student_id) AS rn FROM lists) r
WHERE rn <= 3""",

    "test_statistics": """,
tm AS (
  SELECT class_id, subject_id, test_id, avg(mark) AS mean_mark
  FROM ml WHERE mark IS NOT NULL GROUP BY class_id, subject_id, test_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY class_id, subject_id ORDER BY mean_mark DESC, test_id) AS down,
         row_number() OVER (PARTITION BY class_id, subject_id ORDER BY mean_mark, test_id) AS up FROM tm)
SELECT r.class_id, r.subject_id, r.test_id, r.mean_mark, CAST(r.down AS INTEGER) AS "rank",
       b.test_id AS best_test, w.test_id AS worst_test, (b.mean_mark - w.mean_mark) / 100e0 AS gap_over_100,
       CASE WHEN w.mean_mark = 0 THEN NULL ELSE (b.mean_mark - w.mean_mark) / w.mean_mark * 100e0 END AS relative_increase_pct
FROM r JOIN r b ON r.class_id IS NOT DISTINCT FROM b.class_id AND r.subject_id = b.subject_id AND b.down = 1
       JOIN r w ON r.class_id IS NOT DISTINCT FROM w.class_id AND r.subject_id = w.subject_id AND w.up = 1""",

    "archive_again": """
SELECT group_id, class_id, student_id, firstname, 'again' AS lastname, DATE '2025-01-31' AS date_of_leaving
FROM stud WHERE student_id = 10""",

    "members_mean_over": """
SELECT group_id, class_id, student_id, avg(mark) AS average FROM ml
WHERE mark IS NOT NULL AND test_id = 1 GROUP BY group_id, class_id, student_id HAVING avg(mark) > 50""",

    "grace_eligible": """
SELECT group_id, class_id, subject_id, student_id FROM elig""",

    "grace_eligible_names": """
SELECT e.group_id, e.class_id, e.subject_id, e.student_id,
       coalesce(s.firstname, '') || ' ' || coalesce(s.lastname, '') AS full_name
FROM elig e JOIN stud s ON e.group_id IS NOT DISTINCT FROM s.group_id
     AND e.class_id IS NOT DISTINCT FROM s.class_id AND e.student_id = s.student_id""",

    "grace_adjusted_scores": """
SELECT group_id, class_id, subject_id, student_id, test_id, new_mark AS mark,
       coalesce(new_mark <> mark, false) AS changed
FROM adj""",

    "grace_pass_rate_before_after": """,
r AS (
  SELECT class_id, subject_id, student_id,
         sum(coalesce(mark, 0)) / count(*) AS avg_before,
         sum(coalesce(new_mark, 0)) / count(*) AS avg_after
  FROM adj GROUP BY group_id, class_id, subject_id, student_id),
c AS (
  SELECT class_id, subject_id, count(student_id) AS n,
         count(CASE WHEN avg_before > 40 THEN student_id END) AS pb,
         count(CASE WHEN avg_after > 40 THEN student_id END) AS pa
  FROM r GROUP BY class_id, subject_id)
SELECT class_id, subject_id,
       CASE WHEN pb > 0 THEN CAST(pb AS DOUBLE) / n * 100e0 END AS before_pct,
       CASE WHEN pa > 0 THEN CAST(pa AS DOUBLE) / n * 100e0 END AS after_pct
FROM c WHERE pb > 0 OR pa > 0""",

    "upsert_pass_rate": """,
stored AS (""" + _PASS_RATE + """),
a AS (
  SELECT class_id, subject_id, student_id, sum(coalesce(new_mark, 0)) / count(*) AS average
  FROM adj WHERE class_id = 2 AND subject_id = 3 GROUP BY group_id, class_id, subject_id, student_id),
after AS (
  SELECT class_id, subject_id,
         CAST(count(CASE WHEN average > 40 THEN student_id END) AS DOUBLE) / count(student_id) * 100e0
           AS pass_percentage
  FROM a GROUP BY class_id, subject_id
  HAVING count(CASE WHEN average > 40 THEN student_id END) > 0)
SELECT * FROM stored s
WHERE NOT EXISTS (SELECT 1 FROM after f WHERE f.class_id = s.class_id AND f.subject_id = s.subject_id)
UNION ALL
SELECT * FROM after""",

    "grace_upsert_marks": """
SELECT group_id, class_id, subject_id, student_id, test_id,
       CASE WHEN class_id = 2 AND subject_id = 3 THEN new_mark ELSE mark END AS mark
FROM adj""",

    "stored_pass_rate_lookup": """
SELECT * FROM (""" + _PASS_RATE + """) r WHERE class_id = 2 AND subject_id = 3""",

    "group_takes_subject": """
SELECT subject_id, EXISTS (SELECT 1 FROM sgm g JOIN stud s ON s.group_id = g.group_id
                           WHERE s.student_id = 10 AND g.subject_id = subj.subject_id) AS takes
FROM subj""",

    "test_means_ranked": """
SELECT *, CAST(row_number() OVER (PARTITION BY class_id, subject_id ORDER BY mean_mark DESC, test_id) AS INTEGER) AS "rank"
FROM (SELECT class_id, subject_id, test_id, avg(mark) AS mean_mark
      FROM ml WHERE mark IS NOT NULL GROUP BY class_id, subject_id, test_id) m""",

    "archive_history_append": """
SELECT s.*, DATE '2024-06-30' AS date_of_leaving FROM stud s WHERE student_id IN (10, 11)""",

    "delete_by_key": """
SELECT m.group_id, m.class_id, m.subject_id, m.student_id FROM mrow m
WHERE NOT EXISTS (SELECT 1 FROM member_keys k WHERE k.group_id IS NOT DISTINCT FROM m.group_id
                  AND k.class_id IS NOT DISTINCT FROM m.class_id AND k.student_id = m.student_id)""",

    "archive_students_live": """
SELECT s.* FROM stud s
WHERE NOT EXISTS (SELECT 1 FROM member_keys k WHERE k.group_id IS NOT DISTINCT FROM s.group_id
                  AND k.class_id IS NOT DISTINCT FROM s.class_id AND k.student_id = s.student_id)""",

    "archive_students_history": """
SELECT s.*, DATE '2024-06-30' AS date_of_leaving FROM stud s
WHERE EXISTS (SELECT 1 FROM member_keys k WHERE k.group_id IS NOT DISTINCT FROM s.group_id
              AND k.class_id IS NOT DISTINCT FROM s.class_id AND k.student_id = s.student_id)""",

    "archive_marks_live": """
SELECT m.group_id, m.class_id, m.subject_id, m.student_id, m.test_id, m.mark FROM ml m
WHERE NOT EXISTS (SELECT 1 FROM member_keys k WHERE k.group_id IS NOT DISTINCT FROM m.group_id
                  AND k.class_id IS NOT DISTINCT FROM m.class_id AND k.student_id = m.student_id)""",

    "archive_marks_history": """
SELECT m.group_id, m.class_id, m.subject_id, m.student_id, m.test_id, m.mark FROM ml m
WHERE EXISTS (SELECT 1 FROM member_keys k WHERE k.group_id IS NOT DISTINCT FROM m.group_id
              AND k.class_id IS NOT DISTINCT FROM m.class_id AND k.student_id = m.student_id)""",

    "build_dimension": """
SELECT 'groups' AS dimension, group_id AS id, group_name AS name,
       'group ' || CAST(group_id AS VARCHAR) AS label FROM grp
UNION ALL SELECT 'classes', class_id, class_name, class_name FROM cls
UNION ALL SELECT 'subjects', subject_id, subject_name, subject_name FROM subj
UNION ALL SELECT 'tests', test_id, 'Test ' || CAST(test_id AS VARCHAR),
                 'Test ' || CAST(test_id AS VARCHAR) FROM tst""",

    "build_bridge": """
SELECT class_id, group_id FROM cgm""",

    "build_subject_bridge": """
SELECT group_id, subject_id FROM sgm""",

    "id_buckets": """
SELECT student_id,
       CAST(((ceil(student_id / 150e0) - 1) % 3) + 1 AS INTEGER) AS group_id,
       CAST(CASE WHEN ceil(student_id / 450e0) > 1 THEN 2 ELSE 1 END AS INTEGER) AS class_id
FROM stud""",

    "enrollment_fanout": """
SELECT s.student_id, g.subject_id FROM stud s JOIN sgm g ON s.group_id = g.group_id""",
}


def sql_for(name: str) -> str:
    """Full SQL: the shared CTE prefix, extra CTEs (bodies starting with ','), the select."""
    return PREFIX + BODIES[name]


ORACLE_SQL = {name: sql_for(name) for name in BODIES}
