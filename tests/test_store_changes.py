"""Keyed changes of a store, two writers, vacuum, typed opens, one-pass results and scratch tables."""

import glob
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import FIXTURE_MARKS, SF_SMALL, marks_frame, rows, students_frame
from gradeframe import schemas as S
from gradeframe.functions.scores import explode_scores
from gradeframe.operators import dims, grace, stats
from gradeframe.plans import jobs
from gradeframe.scratch import materialize, publish, release, release_session, scratch_tables, write_text
from gradeframe.session import ensure_checkpoint_dir
from gradeframe.sources import CommitConflict, SchemaMismatch, StoredTables, load, read_table, with_retries
from gradeframe.sources.model import forget
from gradeframe.sources.store import partition_of


@pytest.fixture()
def store(spark):
    """A small store: members 1..40 in groups 1-2 and classes 1-3 (and none), marks in subjects 3-5."""
    base = tempfile.mkdtemp(prefix="gradeframe-store-") + "/scores"
    members = [(1 + i % 2, (None, 1, 2, 3)[i % 4], i, f"f{i}", f"l{i}") for i in range(1, 41)]
    marks = [(g, c, s, i, {1: float(20 + i * s % 80), 2: float(30 + i * 7 * s % 70)}) for g, c, i, *_ in members for s in (3, 4, 5)]
    empty = StoredTables(spark, base)
    return empty.commit({
        "students": empty.write("students", students_frame(spark, members)), "marks": empty.write("marks", marks_frame(spark, marks)),
        "classes": empty.write("classes", spark.createDataFrame([(c, f"class {c}") for c in (1, 2, 3)], S.CLASSES)),
        "subjects": empty.write("subjects", spark.createDataFrame([(s, f"subject {s}") for s in (3, 4, 5)], S.SUBJECTS)),
        "subject_group_mapper": empty.write("subject_group_mapper", spark.createDataFrame([(g, s) for g in (1, 2) for s in (3, 4, 5)], S.SUBJECT_GROUP)),
        "class_group_mapper": empty.write("class_group_mapper", spark.createDataFrame([(c, g) for c in (1, 2, 3) for g in (1, 2)], S.CLASS_GROUP)),
    })


def long(df):
    return some(explode_scores(df, keep_null=True))


def key(r):
    return tuple((x is not None, x) for x in r)


def some(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


# -- S5: keyed history append ------------------------------------------------------


def test_archived_enrolled_and_archived_again_stands_once(spark, store):
    first = jobs.store_archive_student(store, 10, "2024-06-30")
    other = jobs.store_archive_student(first, 11, "2024-07-01")
    back = students_frame(spark, [(1, 2, 10, "new", "name")])
    again = marks_frame(spark, [(1, 2, 3, 10, {1: 99.0}), (1, 2, 5, 10, {2: 1.0})])
    enrolled = jobs.store_rows(other, {"students": back, "marks": again})
    assert rows(enrolled.students.where("student_id = 10")) == [(1, 2, 10, "new", "name")]
    last = jobs.store_archive_student(enrolled, 10, "2025-01-31")
    assert [(r["student_id"], r["firstname"], str(r["date_of_leaving"])) for r in last.students_history.orderBy("student_id").collect()] == [
        (10, "new", "2025-01-31"), (11, "f11", "2024-07-01")]
    # the subjects of the second time are replaced, the other one of the first time stays
    want = sorted([(1, 2, 3, 10, 1, 99.0), (1, 2, 5, 10, 2, 1.0), *[r for r in long(store.marks.where("student_id = 10")) if r[2] == 4]])
    assert sorted(r for r in long(last.marks_history) if r[3] == 10) == want
    assert last.students.where("student_id IN (10, 11)").isEmpty()
    # histories keep the folders of partitions that hold none of the member's keys
    kept = {f for f in other.folders("marks_history") if "class_id=2/" not in f}
    assert kept and kept <= set(last.folders("marks_history"))
    assert {partition_of(f) for f in set(last.folders("marks_history")) ^ set(other.folders("marks_history"))} == {"class_id=2/subject_id=3", "class_id=2/subject_id=5"}


def test_upsert_reads_and_writes_only_the_partitions_of_its_keys(spark, store):
    new = marks_frame(spark, [(1, None, 3, 4, {1: 1.0}), (2, 1, 4, 1, None), (2, 9, 9, 99, {1: 5.0})])
    after = jobs.store_rows(store, {"marks": new})
    changed = {partition_of(f) for f in set(store.folders("marks")) ^ set(after.folders("marks"))}
    assert changed == {"class_id=__HIVE_DEFAULT_PARTITION__/subject_id=3", "class_id=1/subject_id=4", "class_id=9/subject_id=9"}
    from gradeframe.operators import tables
    want = tables.upsert(store.marks, new, S.MARK_KEYS)
    assert some(explode_scores(after.marks, keep_null=True)) == some(explode_scores(want, keep_null=True))
    assert after.marks.count() == store.marks.count() + 1  # (1, NULL, 3, 4) is a key that is stored
    twice = jobs.store_rows(after, {"marks": new})
    assert some(explode_scores(twice.marks, keep_null=True)) == some(explode_scores(after.marks, keep_null=True))
    with pytest.raises(Exception, match="duplicate key"):
        jobs.store_rows(store, {"marks": new.union(new)})
    assert jobs.store_rows(store, {"classes": spark.createDataFrame([(1, "one")], S.CLASSES)}).classes.count() == 3


# -- two writers -------------------------------------------------------------------


def test_two_jobs_from_one_version(spark, store):
    a = jobs.store_rows(store, {"marks": marks_frame(spark, [(1, 1, 3, 500, {1: 1.0})])})
    b = jobs.store_rows(store, {"marks": marks_frame(spark, [(1, 2, 3, 501, {1: 2.0})])})  # started from the same version
    assert (store.version, a.version, b.version) == (0, 1, 2)
    assert rows(b.marks.where("student_id >= 500").select("student_id")) == [(500,), (501,)]
    with pytest.raises(CommitConflict, match="class_id=1/subject_id=3") as e:
        jobs.store_rows(store, {"marks": marks_frame(spark, [(1, 1, 3, 502, {1: 1.0})])})
    assert e.value.version == 2 and e.value.partitions == {"marks": ["class_id=1/subject_id=3"]}
    assert StoredTables(spark, store.base).version == 2
    done = with_retries(jobs.store_rows, store, {"marks": marks_frame(spark, [(1, 1, 3, 502, {1: 1.0})])})
    assert rows(done.marks.where("student_id >= 500").select("student_id")) == [(500,), (501,), (502,)]
    with pytest.raises(CommitConflict):  # whole tables, too
        jobs.store_rows(a, {"subjects": store.subjects}), jobs.store_rows(a, {"subjects": store.subjects})


def test_a_result_computed_from_changed_rows_conflicts(spark, store):
    rated = jobs.store_pass_percentage(store)
    jobs.store_rows(rated, {"marks": marks_frame(spark, [(1, 2, 4, 600, {1: 1.0})])})
    with pytest.raises(CommitConflict, match="marks"):
        jobs.store_pass_percentage(rated)
    with pytest.raises(CommitConflict, match="class_id=2/subject_id=4"):  # grace reads every subject of the class
        jobs.store_grace_marks(rated, subject_id=3, class_id=2)
    other = jobs.store_grace_marks(rated, subject_id=3, class_id=1)  # another class: carried over
    assert not other.marks.where("student_id = 600").isEmpty()
    again = with_retries(jobs.store_grace_marks, rated, subject_id=3, class_id=2)
    want = jobs.grace_marks(other, subject_id=3, class_id=2, stored_pass_rate=other.pass_percentage)
    assert some(again.pass_percentage) == some(want["pass_percentage"])


def test_one_version_is_claimed_by_one_writer(spark, store):
    """Many at once, from one version and on their own partitions: each gets a version and none is lost."""
    def job(i):
        return jobs.store_rows(store, {"marks": marks_frame(spark, [(1, 100 + i, 3, 700 + i, {1: 1.0})])}).version

    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(job, range(6)))
    assert sorted(versions) == [1, 2, 3, 4, 5, 6]
    last = StoredTables(spark, store.base)
    assert rows(last.marks.where("student_id >= 700").select("student_id")) == [(700 + i,) for i in range(6)]
    base = ensure_checkpoint_dir(spark) + "/publish"
    for i in range(8):
        write_text(spark, f"{base}/{i}", str(i))
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda i: publish(spark, f"{base}/{i}", f"{base}/name"), range(8))) == 1
    assert [f for f in os.listdir(base.removeprefix("file:")) if not f.startswith(".")] == ["name"]


# -- S6: physical delete -------------------------------------------------------------


def ids_on_disk(store, name):
    files = glob.glob(f"{store.base}/{name}/**/*.parquet", recursive=True)
    return {r[0] for r in duckdb.sql(f"SELECT student_id FROM read_parquet({files!r}, union_by_name = true)").fetchall()} if files else set()


def test_vacuum_takes_deleted_rows_off_the_disk(spark, store):
    gone = jobs.store_archive_student(store, 10, "2024-06-30")
    assert 10 in ids_on_disk(store, "students") and 10 in ids_on_disk(store, "marks")
    gone.write("marks", marks_frame(spark, [(1, 1, 3, 999, {1: 1.0})]))  # a job that never commits
    before = long(gone.marks), rows(gone.students_history)
    open_plan = gone.marks
    assert gone.vacuum(keep=2) == []
    deleted = gone.vacuum(keep=1, older_than=3600)
    assert deleted and 10 not in ids_on_disk(store, "students") and 10 not in ids_on_disk(store, "marks")
    assert 999 in ids_on_disk(store, "marks")  # it may still be at work
    assert any("marks/" in f for f in gone.vacuum(keep=1, older_than=0)) and 999 not in ids_on_disk(store, "marks")
    assert long(open_plan) == before[0] == long(StoredTables(spark, store.base).marks)
    assert rows(gone.students_history) == before[1] and ids_on_disk(store, "students_history") == {10}
    assert StoredTables(spark, store.base).versions() == [1] and gone.vacuum(keep=1, older_than=0) == []
    after = jobs.store_rows(StoredTables(spark, store.base), {"classes": store.classes.limit(0)})
    assert after.version == 2
    with pytest.raises(ValueError):
        gone.vacuum(keep=0)


def test_a_writer_on_a_dropped_version_still_sees_conflicts(spark, store):
    one = jobs.store_rows(store, {"marks": marks_frame(spark, [(1, 1, 3, 800, {1: 1.0})])})
    two = jobs.store_rows(one, {"marks": marks_frame(spark, [(1, 1, 3, 801, {1: 1.0})])})
    two.vacuum(keep=1)
    late = StoredTables(spark, store.base, 2)
    with pytest.raises(CommitConflict):
        store.commit({"marks": [f for f in store.folders("marks") if partition_of(f) != "class_id=1/subject_id=3"]})
    assert late.commit({}).version == 3


# -- S2: typed views -------------------------------------------------------------------


def test_files_of_another_shape_raise_at_open(spark, tmp_path):
    good = marks_frame(spark, FIXTURE_MARKS)

    def saved(df):
        path = tempfile.mkdtemp(dir=tmp_path) + "/marks"
        df.write.parquet(path)
        return path

    assert long(read_table(spark, saved(good), "marks")) == long(good)
    narrow = good.withColumn("student_id", F.col("student_id").cast("int")).withColumn("more", F.lit(1))
    assert long(read_table(spark, saved(narrow), "marks")) == long(good) and read_table(spark, saved(narrow), "marks").schema == S.MARKS
    for bad, says in ((good.drop("test_marks"), "no column test_marks"), (good.withColumn("group_id", F.col("group_id").cast("bigint")), "group_id is bigint"),
                      (good.withColumn("student_id", F.col("student_id").cast("string")), "student_id is string"),
                      (good.withColumn("test_marks", F.transform_values("test_marks", lambda k, v: v.cast("string"))), "test_marks is map"),
                      (good.withColumn("student_id", F.when(F.col("student_id") != 5, F.col("student_id"))), "a row without subject_id or student_id")):
        with pytest.raises(SchemaMismatch, match=says):
            read_table(spark, saved(bad), "marks")
    mixed = saved(good)
    good.withColumn("student_id", F.col("student_id").cast("string")).write.mode("append").parquet(mixed)
    with pytest.raises(SchemaMismatch):
        read_table(spark, mixed, "marks")


def test_a_store_checks_the_types_of_its_files(spark, store, monkeypatch):
    # a folder from elsewhere is looked at when it is committed
    for df, ok in ((store.classes, True), (store.classes.withColumnRenamed("class_name", "name"), False)):
        df.coalesce(1).write.parquet(f"{store.base}/classes/write=given-{ok}")
        if ok:
            assert some(store.commit({"classes": [f"write=given-{ok}"]}).classes) == some(store.classes)
        else:
            with pytest.raises(SchemaMismatch, match="no column class_name"):
                StoredTables(spark, store.base).commit({"classes": [f"write=given-{ok}"]})
    # and a store of other types than the declared ones is not opened
    wider = S.T.StructType([*S.CLASSES.fields, S.T.StructField("teacher", S.T.StringType())])
    monkeypatch.setitem(S.SCHEMAS, "classes", wider)
    with pytest.raises(SchemaMismatch, match="classes in version 1 .*: no column teacher"):
        StoredTables(spark, store.base)


# -- C1: lifetime of derived tables ------------------------------------------------------


def test_scratch_tables_go_with_their_block(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    new = lambda: {f.rsplit("-", 1)[0] for f in set(os.listdir(root)) - before}
    with scratch_tables(spark):
        a = materialize(spark.range(5), "a")
        with scratch_tables(spark):
            assert materialize(spark.range(3), "b").count() == 3 and new() == {"a", "b"}
        assert new() == {"a"} and a.count() == 5
        c = materialize(a, "c", lasting=True)
        release(a.where("id > 1"))
        assert new() == {"c"}
    with pytest.raises(RuntimeError), scratch_tables(spark):
        materialize(spark.range(3), "d")
        raise RuntimeError
    assert new() == {"c"} and c.count() == 5
    release(c, spark.read.parquet(f"{SF_SMALL}/region.parquet"))
    assert new() == set() and os.path.exists(f"{SF_SMALL}/region.parquet")


def test_the_session_gives_its_tables_back(spark):
    t = load(spark, SF_SMALL, fresh=True)
    names = ("classes", "subjects", "tests", "subject_group_mapper", "class_group_mapper", "pass_percentage")
    files = {f.removeprefix("file://") for n in names for f in t.table(n).inputFiles() if "/tables/" in f}
    want = rows(t.classes)
    assert len(files) >= 6 and all(map(os.path.exists, files))
    t.release()
    assert not any(map(os.path.exists, files)) and rows(t.classes) == want
    x = materialize(spark.range(2), "x")
    release_session(spark)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in x.inputFiles())
    forget(spark)


# -- C3: several outputs of one execution ------------------------------------------------


def scans(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [x for x in final.splitlines() if "FileScan parquet" in x and "test_marks" in x]


def test_both_top_lists_from_one_scan(spark, store):
    both = jobs.top_students(store, k=4)
    lists = jobs.top_lists(store, k=4)
    assert len(scans(lists)) == 1
    in_class = "class_id IS NOT NULL"  # a member without a class is in no class's list
    assert some(lists.where("test_id IS NOT NULL").select("class_id", "test_id", "rank", "student_id", "average")) == some(both["per_test"].where(in_class))
    assert some(lists.where("test_id IS NULL").select("class_id", "rank", "student_id", "average")) == some(both["overall"].where(in_class))
    one = jobs.store_top_students(store, k=4)
    assert some(one.top_students) == some(lists)
    after = jobs.store_top_students(jobs.store_archive_student(one, 10, "2024-06-30"), class_id=2)
    assert some(after.top_students.where("class_id <> 2")) == some(lists.where("class_id <> 2"))
    assert some(after.top_students.where("class_id = 2")) == some(jobs.top_lists(after, class_id=2))
    assert after.top_students.where("student_id = 10").isEmpty() and after.top_students.where("class_id = 2").count() == 9


def test_statistics_of_tests_from_one_scan(spark, store):
    done = jobs.store_test_statistics(store)
    means = stats.test_means(store.marks)
    assert len(scans(jobs.test_statistics(store))) == 1
    ranked = stats.ranked_test_means(means)
    assert some(done.test_statistics.select(*ranked.columns)) == some(ranked)
    best = stats.best_worst_test(means)
    shared = [c for c in best.columns if c not in ("best_mean", "worst_mean")]
    assert some(done.test_statistics.select(*shared).distinct()) == some(best.select(*shared))
    pair = jobs.test_statistics(store, subject_name="SUBJECT 3", class_name="Class 2")
    assert some(pair) == some(done.test_statistics.where("class_id = 2 AND subject_id = 3"))


# -- P4, J9 -------------------------------------------------------------------------------


def test_lookup_in_the_stored_rates_reads_one_partition_with_a_pushed_filter(spark, store):
    rated = jobs.store_pass_percentage(store)
    found = stats.stored_pass_rate(jobs.stored_rates(rated), 2, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(subject_id,3)" in plan and "PartitionFilters: [isnotnull(class_id" in plan and "test_marks" not in plan
    assert some(found) == some(stats.pass_rate(store.marks).where("class_id = 2 AND subject_id = 3"))
    t = load(spark, SF_SMALL)
    looked_up = stats.stored_pass_rate(jobs.stored_rates(t), 2, 3)
    plan = looked_up._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(class_id,2), EqualTo(subject_id,3)" in plan and "lineitem" not in plan and "Exchange" not in plan
    assert some(looked_up) == some(stats.pass_rate(t.marks).where("class_id = 2 AND subject_id = 3"))


def test_members_without_a_class_have_names(spark):
    marks = marks_frame(spark, [(1, None, 3, 1, {1: 90.0}), (1, 2, 3, 2, {1: 90.0}), (None, None, 3, 3, {1: 90.0})])
    members = students_frame(spark, [(1, None, 1, "ann", "a"), (1, 2, 2, "bob", "b"), (None, None, 3, "cy", None), (1, 2, 1, "no", "no")])
    names = grace.eligible_names(grace.grace_eligible(grace.flag_eligible(marks)), members)
    assert rows(names, "student_id", "full_name") == [(1, "ann a"), (2, "bob b"), (3, "cy ")]
    assert dims.member_keys(members, 1).count() == 2
