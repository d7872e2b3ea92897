import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from conftest import SF_SMALL, rows
from gradeframe import schemas as S
from gradeframe.functions.scores import explode_scores
from gradeframe.plans import jobs
from gradeframe.sources import StoredTables, load, read_table, table_path, write_snapshot
from gradeframe.sources.store import partition_of


def _store(spark):
    base = tempfile.mkdtemp(prefix="gradeframe-store-") + "/scores"
    return jobs.fill_tables(load(spark, SF_SMALL), base)


def _files(store, name):
    return {f"{f}/{x}" for f in store.folders(name) for x in os.listdir(f"{store.base}/{name}/{f}") if x.endswith(".parquet")}


def test_fill_tables_round_trip(spark):
    t, store = load(spark, SF_SMALL), _store(spark)
    assert store.version == 0
    assert store.marks.schema == S.MARKS
    assert rows(explode_scores(store.marks, keep_null=True)) == rows(explode_scores(t.marks, keep_null=True))
    assert rows(store.students) == rows(t.students)
    assert rows(store.subject_group_mapper) == rows(t.subject_group_mapper)
    assert any(partition_of(f) == "class_id=1/subject_id=1" for f in store.folders("marks"))
    # one folder of files per table and partition: nothing was written twice
    assert sorted(os.listdir(store.base)) == sorted(["_manifests", "_versions", "class_group_mapper", "classes", "groups", "marks",
                                                     "students", "subject_group_mapper", "subjects", "tests"])
    for name in ("groups", "subjects", "students", "marks"):
        assert len({f.split("/")[0] for f in store.folders(name)}) == 1
    with pytest.raises(ValueError):
        jobs.fill_tables(t, store.base)


def test_jobs_chain_on_one_store(spark):
    """Fill, O3, O6, archive, archive; every version stays readable."""
    s0 = _store(spark)
    s1 = jobs.store_pass_percentage(s0)
    want = rows(jobs.pass_percentage(s0))
    assert rows(s1.pass_percentage) == want and s0.pass_percentage.count() == 0

    before = _files(s1, "marks")
    s2 = jobs.store_grace_marks(s1, subject_id=3, class_id=2)
    job = jobs.grace_marks(s1, subject_id=3, class_id=2, stored_pass_rate=s1.pass_percentage)
    assert rows(explode_scores(s2.marks, keep_null=True)) == rows(explode_scores(job["marks"], keep_null=True))
    assert rows(s2.pass_percentage) == rows(job["pass_percentage"])
    changed = {partition_of(f.rpartition("/")[0]) for f in before ^ _files(s2, "marks")}
    assert changed == {"class_id=2/subject_id=3"}

    s3 = jobs.store_archive_student(s2, 10, "2024-06-30")
    s4 = jobs.store_archive_student(s3, 11, "2024-07-01")
    assert rows(s4.students_history, "student_id") == [(10,), (11,)]
    assert sorted(r[0] for r in s4.marks_history.select("student_id").distinct().collect()) == [10, 11]
    assert s4.students.count() == s0.students.count() - 2
    assert s4.students.where("student_id IN (10, 11)").isEmpty() and s4.marks.where("student_id IN (10, 11)").isEmpty()
    assert s4.marks.count() + s4.marks_history.count() == s0.marks.count()
    home = {f"class_id={r[0]}" for r in s0.students.where("student_id IN (10, 11)").select("class_id").collect()}
    assert {f.split("/")[1] for f in _files(s2, "marks") ^ _files(s4, "marks")} <= home
    assert {f.split("/")[1] for f in _files(s2, "students") ^ _files(s4, "students")} <= home
    assert StoredTables(spark, s0.base).version == 4
    assert rows(StoredTables(spark, s0.base, 0).students) == rows(s0.students)


def test_reads_of_one_partition_prune_the_others(spark):
    plan = _store(spark).marks.where("class_id = 2 AND subject_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(class_id" in plan


def test_snapshots_are_never_overwritten(spark):
    base = tempfile.mkdtemp(prefix="gradeframe-store-")
    df = spark.createDataFrame([(2, 3, 50.0)], S.PASS_PERCENTAGE)
    p = write_snapshot(df, table_path(base, "pass_percentage", 0), "pass_percentage")
    with pytest.raises((PySparkException, Py4JJavaError)):
        write_snapshot(df, p, "pass_percentage")
    p1 = write_snapshot(df, table_path(base, "pass_percentage", 1), "pass_percentage")
    assert rows(read_table(spark, p1, "pass_percentage")) == [(2, 3, 50.0)]


def test_jobs_by_name(spark):
    t = load(spark, SF_SMALL)
    stats = jobs.subject_statistics(t, subject_name="medium", class_name="building")
    assert stats["roster"].select("subject_id").distinct().collect()[0][0] == 3
    assert stats["test_means"].count() == t.tests.count()
    bw = stats["best_worst"].first()
    assert bw["best_mean"] >= bw["worst_mean"]
    top = jobs.top_students(t, class_name="Building")
    assert top["overall"].count() == 3
    g = jobs.grace_marks(t, subject_name="MEDIUM", class_name="building")
    g_ids = jobs.grace_marks(t, subject_id=3, class_id=2)
    assert rows(g["eligible"]) == rows(g_ids["eligible"])
    assert rows(g["adjusted_scores"]) == rows(g_ids["adjusted_scores"])
    assert g["eligible"].count() > 0
    assert rows(g["eligible"].select("class_id", "subject_id").distinct()) == [(2, 3)]
    assert g["pass_percentage"].count() == jobs.pass_percentage(t).count()
    rep = jobs.subject_mean_report(t, 10, subject_name="medium")
    assert rep["member"].count() == 1
    assert rows(rep["takes_subject"]) == [(3, True)]


def test_cli_chain(spark, capsys):
    from gradeframe.__main__ import main
    store = tempfile.mkdtemp(prefix="gradeframe-cli-") + "/scores"
    assert main(["pass-percentage", "--input", SF_SMALL, "--show", "2"]) == 0
    assert "pass_percentage" in capsys.readouterr().out
    for args in (["fill", "--input", SF_SMALL], ["pass-percentage"], ["grace", "--subject", "medium", "--class", "building"],
                 ["archive", "--student-id", "10"], ["archive", "--student-id", "11"], ["top3", "--class", "building"]):
        assert main([*args, "--store", store]) == 0
    assert "version 5" in capsys.readouterr().out
    assert rows(StoredTables(spark, store).students_history, "student_id") == [(10,), (11,)]
    assert StoredTables(spark, store).top_students.select("class_id").distinct().count() == 1
    assert main(["vacuum", "--store", store, "--keep", "2"]) == 0 and "deleted" in capsys.readouterr().out
    assert StoredTables(spark, store).versions() == [4, 5]
    with pytest.raises(SystemExit):
        main(["top3", "--store", store + "-none"])


def test_every_query_same_on_stored_tables(spark):
    from gradeframe.plans.catalog import TABLE_QUERIES
    t, st = load(spark, SF_SMALL), _store(spark)
    for name, fn in sorted(TABLE_QUERIES.items()):
        assert rows(fn(st)) == rows(fn(t)), name
