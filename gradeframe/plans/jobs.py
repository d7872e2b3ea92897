"""The user-visible jobs, parameterised instead of read from a console.

Each job returns named lazy DataFrames; the caller shows, collects or writes
them. Names are matched ignoring case. A job never collects ids to the driver:
lookups by name stay one-column DataFrames that are semi-joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeframe import schemas as S
from gradeframe.operators import dims, grace, stats, tables, topk
from gradeframe.sources.model import Tables
from gradeframe.sources.store import StoredTables, partition_of


def _ids(t: Tables, dim: str, id_col: str, name_col: str, name: str | None, id_: int | None):
    if name is not None:
        return dims.ids_by_name(t.table(dim), id_col, name_col, name)
    if id_ is not None:
        return t.table(dim).where(F.col(id_col) == F.lit(id_)).select(id_col)
    return None


def subject_mean_report(t: Tables, student_id: int, subject_name: str | None = None,
                        subject_id: int | None = None) -> dict[str, DataFrame]:
    """Profile of one member, whether the member's group takes the subject(s), and the
    member's score rows in subjects the group takes, with their means."""
    subject_ids = _ids(t, "subjects", "subject_id", "subject_name", subject_name, subject_id)
    rows = dims.restrict(t.marks, "student_id", student_id)
    rows = dims.restrict(rows, "subject_id", ids=subject_ids) if subject_ids is not None else rows
    rows = rows.join(t.subject_group_mapper.select("group_id", "subject_id").distinct(),
                     ["group_id", "subject_id"], "left_semi").select(*S.MARKS.fieldNames())
    asked = subject_ids if subject_ids is not None else t.subjects.select("subject_id")
    return {
        "member": dims.point_lookup(t.students, student_id),
        "profile": dims.member_profile(t.students, t.groups, t.classes, t.subjects,
                                       t.subject_group_mapper, student_id),
        "takes_subject": dims.group_takes_subject(t.students, t.subject_group_mapper, student_id, asked),
        "marks": rows,
        "mean": stats.subject_mean_of_student(rows),
    }


def subject_statistics(t: Tables, subject_name: str | None = None, class_name: str | None = None,
                       subject_id: int | None = None, class_id: int | None = None) -> dict[str, DataFrame]:
    """Roster, mean per test, and best/worst test for a subject in a class."""
    subject_ids = _ids(t, "subjects", "subject_id", "subject_name", subject_name, subject_id)
    class_ids = _ids(t, "classes", "class_id", "class_name", class_name, class_id)
    roster = dims.members_of_class_groups(t.students, t.subject_group_mapper)
    marks = t.marks
    if subject_ids is not None:
        roster = dims.restrict(roster, "subject_id", ids=subject_ids)
        marks = dims.restrict(marks, "subject_id", ids=subject_ids)
    if class_ids is not None:
        roster = dims.restrict(roster, "class_id", ids=class_ids)
        marks = dims.restrict(marks, "class_id", ids=class_ids)
    means = stats.test_means(marks)
    return {"roster": roster, "test_means": stats.ranked_test_means(means), "best_worst": stats.best_worst_test(means)}


def pass_percentage(t: Tables, threshold: float = S.PASS_THRESHOLD, keep_zero: bool = False) -> DataFrame:
    return stats.pass_rate(t.marks, threshold, keep_zero)


def top_students(t: Tables, class_name: str | None = None, class_id: int | None = None,
                 k: int = S.TOP_K, test_ids=S.TOP_TESTS) -> dict[str, DataFrame]:
    """Top k per test (tests 1 and 2 unless ``test_ids``; None = all) and overall
    (by mean of test means), per class or for one class."""
    class_ids = _ids(t, "classes", "class_id", "class_name", class_name, class_id)
    marks = t.marks
    if class_ids is not None:  # the rows of the class, in groups that belong to it
        pairs = dims.groups_of_class(t.class_group_mapper).join(class_ids.distinct(), "class_id", "left_semi")
        marks = marks.join(pairs, ["class_id", "group_id"], "left_semi").select(*S.MARKS.fieldNames())
    per_test = stats.student_test_means(marks)
    totals = stats.student_total_mean(per_test)
    return {"per_test": topk.top_per_test(per_test, k, test_ids), "overall": topk.top_overall(totals, k)}


def top_lists(t: Tables, class_name: str | None = None, class_id: int | None = None,
              k: int = S.TOP_K, test_ids=S.TOP_TESTS) -> DataFrame:
    """The lists of ``top_students`` as one table (test_id NULL: the overall list), from one scan of the
    marks: per class, of members in groups that belong to it by the class bridge."""
    class_ids = _ids(t, "classes", "class_id", "class_name", class_name, class_id)
    pairs = dims.groups_of_class(t.class_group_mapper)
    if class_ids is not None:
        pairs = pairs.join(class_ids.distinct(), "class_id", "left_semi")
    marks = t.marks.join(pairs, ["class_id", "group_id"], "left_semi").select(*S.MARKS.fieldNames())
    return topk.top_lists(stats.student_test_means(marks), k, test_ids)


def test_statistics(t: Tables, subject_name: str | None = None, class_name: str | None = None,
                    subject_id: int | None = None, class_id: int | None = None) -> DataFrame:
    """Ranked means and best and worst test of ``subject_statistics`` as one table, from one scan of the marks."""
    marks = t.marks
    for ids, column in ((_ids(t, "subjects", "subject_id", "subject_name", subject_name, subject_id), "subject_id"),
                        (_ids(t, "classes", "class_id", "class_name", class_name, class_id), "class_id")):
        if ids is not None:
            marks = dims.restrict(marks, column, ids=ids)
    return stats.test_statistics(stats.test_means(marks))


def stored_rates(t) -> DataFrame:
    """The stored pass percentages; where a store has none yet, those of its marks."""
    if isinstance(t, StoredTables) and not t.folders("pass_percentage"):
        return pass_percentage(t)
    return t.pass_percentage


def archive_student(t: Tables, student_id: int, leaving_date=None,
                    students_history: DataFrame | None = None,
                    marks_history: DataFrame | None = None) -> dict[str, DataFrame]:
    return tables.archive(t.students, t.marks, dims.member_keys(t.students, student_id), leaving_date,
                          students_history, marks_history)


def grace_marks(t: Tables, subject_name: str | None = None, class_name: str | None = None,
                subject_id: int | None = None, class_id: int | None = None,
                stored_pass_rate: DataFrame | None = None) -> dict[str, DataFrame]:
    """Grace marks for a subject in a class (or every pair when no names/ids are given).

    ``stored_pass_rate`` is the previously stored pass-percentage table; it
    defaults to the rate computed from the input snapshot. ``before_after`` puts
    the stored rate of the scope beside the new one, ``pass_percentage`` is the
    stored table with the new rates upserted; ``marks`` is the whole marks table
    after the job (the rows in scope rewritten, the others as they are).
    """
    # Ids given as values are literals (filters, partition pruning); only names need a lookup.
    subject_ids = _ids(t, "subjects", "subject_id", "subject_name", subject_name, None)
    class_ids = _ids(t, "classes", "class_id", "class_name", class_name, None)
    scope = {"class_id": class_id, "class_ids": class_ids, "subject_id": subject_id, "subject_ids": subject_ids}
    flagged = grace.flag_eligible(t.marks, **scope, subject_group=t.subject_group_mapper)
    adjusted = grace.grace_adjust(flagged)
    eligible = grace.grace_eligible(flagged)
    adjusted_marks = adjusted.select(*S.MARK_KEYS, "test_marks")
    after = stats.pass_rate(adjusted_marks)
    stored = stored_pass_rate if stored_pass_rate is not None else stats.pass_rate(t.marks)
    before = dims.restrict(dims.restrict(stored, "class_id", class_id, class_ids), "subject_id", subject_id, subject_ids)
    return {
        "eligible": eligible,
        "names": grace.eligible_names(eligible, t.students),
        "adjusted_marks": adjusted_marks,
        "marks": grace.next_marks(t.marks, adjusted_marks, **scope),
        "adjusted_scores": grace.adjusted_scores(adjusted),
        "before_after": grace.stored_before_after(before, after),
        "after": after,
        "pass_percentage": tables.upsert(stored, after, S.PASS_KEYS),
    }


def fill_tables(t: Tables, out_base: str) -> StoredTables:
    """Fill a new store under ``out_base``: derive students and marks once each into it, and
    the bridges from what was written. Returns the store's first version."""
    store = StoredTables(t.spark, out_base)
    if store.version >= 0:
        raise ValueError(f"there is a store at {out_base} already")
    names = ("groups", "classes", "subjects", "tests", "students", "marks")
    folders = {name: store.write(name, t.table(name)) for name in names}
    written = {name: store.rows_of(name, folders[name]) for name in ("marks", "students")}
    folders["subject_group_mapper"] = store.write("subject_group_mapper", dims.build_bridge(written["marks"], "group_id", "subject_id"))
    folders["class_group_mapper"] = store.write("class_group_mapper", dims.build_bridge(written["students"], "class_id", "group_id"))
    return store.commit(folders)


# -- jobs on a store: each returns the store's next version ---------------------

def store_rows(store: StoredTables, rows: dict[str, DataFrame]) -> StoredTables:
    """Append rows to tables of the store by key: a row replaces the stored one of its key (S5)."""
    return store.commit({name: store.upserted(name, df) for name, df in rows.items()})


def store_pass_percentage(store: StoredTables, threshold: float = S.PASS_THRESHOLD,
                          keep_zero: bool = False) -> StoredTables:
    """O3: compute the pass percentages and upsert them into the stored ones."""
    rates = store.upserted("pass_percentage", pass_percentage(store, threshold, keep_zero))
    return store.commit({"pass_percentage": rates}, reads={"marks": [""]})


def store_top_students(store: StoredTables, class_name: str | None = None, class_id: int | None = None,
                       k: int = S.TOP_K, test_ids=S.TOP_TESTS) -> StoredTables:
    """O4: write the lists per test and overall, of one class or all, in one execution.

    The lists of a class replace its stored ones; all lists are replaced without a class."""
    lists = top_lists(store, class_name, class_id, k, test_ids)
    one = class_name is not None or class_id is not None
    folders = store.replaced_partitions("top_students", lists) if one else store.replaced("top_students", lists)
    return store.commit({"top_students": folders}, reads={"marks": [""], "class_group_mapper": [""]})


def store_test_statistics(store: StoredTables) -> StoredTables:
    """O2: write the ranked test means with best and worst test of every class and subject in one execution."""
    return store.commit({"test_statistics": store.replaced("test_statistics", test_statistics(store))}, reads={"marks": [""]})


def store_grace_marks(store: StoredTables, subject_name: str | None = None, class_name: str | None = None,
                      subject_id: int | None = None, class_id: int | None = None) -> StoredTables:
    """O6: rewrite the marks of the scope's partitions and upsert the new pass percentages.

    Eligibility reads all marks of the classes in scope, so a change of any of them
    in the meantime is a conflict."""
    subject_ids = _ids(store, "subjects", "subject_id", "subject_name", subject_name, None)
    class_ids = _ids(store, "classes", "class_id", "class_name", class_name, None)
    job = grace_marks(store, subject_name, class_name, subject_id, class_id, store.pass_percentage)
    scope = store.marks.select("class_id", "subject_id")
    scope = dims.restrict(dims.restrict(scope, "class_id", class_id, class_ids), "subject_id", subject_id, subject_ids)
    folders = store.rewritten("marks", scope.distinct(), lambda rows: tables.upsert(
        rows, job["adjusted_marks"], S.MARK_KEYS))
    written = set(folders) - set(store.folders("marks"))
    rates = store.upserted("pass_percentage", job["after"])
    return store.commit({"marks": folders, "pass_percentage": rates},
                        reads={"marks": sorted({partition_of(f).split("/")[0] for f in written}), "subject_group_mapper": [""]})


def store_archive_student(store: StoredTables, student_id: int, leaving_date=None) -> StoredTables:
    """O5: put the member's rows into the histories and rewrite the partitions that held them.

    A history row takes the place of one with its key: a member who was archived, enrolled
    again and archived again stands in the histories once."""
    keys = dims.member_keys(store.students, student_id)
    moved = tables.archive(store.students, store.marks, keys, leaving_date)
    held = tables.select_by_key(store.marks, keys, S.STUDENT_KEYS).select("class_id", "subject_id").distinct()
    return store.commit({
        **{name: store.upserted(name, moved[name]) for name in ("students_history", "marks_history")},
        "students": store.rewritten("students", keys.select("class_id").distinct(),
                                    lambda rows: tables.delete_by_key(rows, keys, S.STUDENT_KEYS)),
        "marks": store.rewritten("marks", held, lambda rows: tables.delete_by_key(rows, keys, S.STUDENT_KEYS)),
    })
