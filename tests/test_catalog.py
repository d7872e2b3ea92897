"""Every registered query against its SQL oracle (DuckDB), plus plan checks."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import NAMES, SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in data:
        out.append(tuple(str(r[i]) if hasattr(r[i], "isoformat") else r[i] for i in order))
    return sorted(out, key=repr)


def test_every_query_has_sql():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = [tuple(r) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["class_id", "subject_id", "pass_percentage"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_no_python_in_plans(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow"):  # BatchEvalPython, ArrowEvalPython, MapInPandas, MapInArrow, FlatMapGroupsIn...
        assert node not in plan


def test_scan_pruned_and_filter_pushed(spark):
    from gradeframe.sources import load
    plan = load(spark, SF_SMALL).marks_long._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    assert "LessThan" not in plan  # no line item is cut


def test_every_matching_line_item_lands_in_a_mark(spark, con):
    """One mark per (member, subject, line number) that any line item has, and every such line item counts."""
    from gradeframe.sources import load
    got = load(spark, SF_SMALL).marks_long.select("student_id", "subject_id", "test_id").collect()
    want = con.execute("""
        SELECT DISTINCT o_custkey + 1, s.subject_id, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey JOIN (SELECT p_type, dense_rank() OVER (ORDER BY p_type) AS subject_id
          FROM (SELECT DISTINCT p_type FROM part)) s USING (p_type)
        JOIN customer ON o_custkey = c_custkey""").fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)
    lines = con.execute("SELECT count(DISTINCT l_linenumber) FROM lineitem").fetchone()[0]
    assert load(spark, SF_SMALL).tests.count() == lines


def test_members_of_unknown_nation_or_segment_stay(spark, tmp_path):
    import shutil

    from gradeframe.sources import load
    for t in TABLES:
        shutil.copytree(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet") if (SF_SMALL + t).endswith("/") else shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    c = duckdb.connect()
    c.execute(f"""COPY (SELECT CASE WHEN c_custkey = 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
                  CASE WHEN c_custkey = 4 THEN NULL ELSE c_nationkey END AS c_nationkey, * EXCLUDE (c_mktsegment, c_nationkey)
                  FROM '{SF_SMALL}/customer.parquet') TO '{tmp_path}/customer.parquet' (FORMAT parquet)""")
    t = load(spark, str(tmp_path))
    found = {r["student_id"]: r for r in t.students.where("student_id IN (4, 5)").collect()}
    assert found[4]["class_id"] is None and found[5]["group_id"] is None
    assert t.students.count() == load(spark, SF_SMALL).students.count()
    assert t.marks.where("student_id IN (4, 5)").select("student_id").distinct().count() == 2


@pytest.mark.parametrize("name", ["pass_rate", "test_means_for_subject", "student_test_means",
                                  "member_count", "members_mean_over", "best_worst_test"])
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan


def test_pass_rate_is_one_shuffle_over_the_scores(spark):
    import tempfile

    from gradeframe.operators import stats
    from gradeframe.plans import jobs
    from gradeframe.sources import load
    store = jobs.fill_tables(load(spark, SF_SMALL), tempfile.mkdtemp(prefix="gradeframe-store-") + "/s")
    df = stats.pass_rate(store.marks)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1
    # the stored score table: class and subject come from partition folders
    assert "ReadSchema: struct<student_id:bigint,test_marks:map<int,double>>" in final
