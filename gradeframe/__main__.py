"""Command line: run one operation on a store of score tables.

    python -m gradeframe fill --input /root/testdata/sf0.01 --store /shared/scores
    python -m gradeframe pass-percentage --store /shared/scores
    python -m gradeframe grace --store /shared/scores --subject medium --class building
    python -m gradeframe archive --store /shared/scores --student-id 10
    python -m gradeframe top3 --store /shared/scores --class building
    python -m gradeframe vacuum --store /shared/scores --keep 2

``fill`` derives the tables from the inputs; every other operation reads the
latest version of the store (or, with ``--input`` instead of ``--store``,
derives what it needs and stores nothing). Operations with results to keep
(pass-percentage, subject-stats, top3, grace, archive) commit the next version, again from the last one if
another job has changed what they read. ``vacuum`` deletes what only older versions name.
Outputs are printed (``--show`` rows each); scratch tables are deleted at the end.
"""

from __future__ import annotations

import argparse
import sys

from gradeframe import schemas as S
from gradeframe.plans import jobs
from gradeframe.scratch import release_session, scratch_tables
from gradeframe.session import get_session
from gradeframe.sources import StoredTables, load, with_retries
from gradeframe.sources.model import forget


def _outputs(args, t) -> dict:
    op = args.operation
    if op == "profile":
        return jobs.subject_mean_report(t, args.student_id, subject_name=args.subject)
    if op == "subject-stats":
        return jobs.subject_statistics(t, subject_name=args.subject, class_name=args.class_name)
    if op == "pass-percentage":
        return {"pass_percentage": jobs.pass_percentage(t, args.threshold, args.keep_zero)}
    if op == "top3":
        return jobs.top_students(t, class_name=args.class_name, k=args.k)
    if op == "archive":
        return jobs.archive_student(t, args.student_id, args.leaving_date)
    if op == "grace":
        return jobs.grace_marks(t, subject_name=args.subject, class_name=args.class_name)
    raise ValueError(op)


def _commit(args, store):
    """The next version after an operation with results to keep; None for the others."""
    if args.operation == "pass-percentage":
        return with_retries(jobs.store_pass_percentage, store, args.threshold, args.keep_zero)
    if args.operation == "grace":
        return with_retries(jobs.store_grace_marks, store, subject_name=args.subject, class_name=args.class_name)
    if args.operation == "archive":
        return with_retries(jobs.store_archive_student, store, args.student_id, args.leaving_date)
    if args.operation == "top3":
        return with_retries(jobs.store_top_students, store, class_name=args.class_name, k=args.k)
    if args.operation == "subject-stats":
        return with_retries(jobs.store_test_statistics, store)
    return None


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="gradeframe")
    p.add_argument("operation", choices=["profile", "subject-stats", "pass-percentage", "top3",
                                         "archive", "grace", "fill", "vacuum"])
    p.add_argument("--input", help="directory with the input parquet tables")
    p.add_argument("--store", help="folder of the store")
    p.add_argument("--student-id", type=int, default=S.DEFAULT_STUDENT_ID)
    p.add_argument("--subject", help="subject name (any case)")
    p.add_argument("--class", dest="class_name", help="class name (any case)")
    p.add_argument("--threshold", type=float, default=S.PASS_THRESHOLD)
    p.add_argument("--keep-zero", action="store_true")
    p.add_argument("--k", type=int, default=S.TOP_K)
    p.add_argument("--leaving-date", help="YYYY-MM-DD (default: today)")
    p.add_argument("--keep", type=int, default=1, help="versions that vacuum keeps")
    p.add_argument("--show", type=int, default=20)
    p.add_argument("--master", help="Spark master (default: local[BENCH_CPUS or 8])")
    args = p.parse_args(argv)
    if args.operation == "fill" and not (args.store and args.input):
        p.error("fill needs --input and --store")
    if bool(args.store) == bool(args.input) and args.operation != "fill":
        p.error("give either --store or --input")

    spark = get_session(master=args.master)
    try:
        with scratch_tables(spark):
            return _run(args, p, spark)
    finally:
        release_session(spark)
        forget(spark)


def _run(args, p, spark) -> int:
    if args.operation == "fill":
        print(f"version {jobs.fill_tables(load(spark, args.input), args.store).version}")
        return 0
    t = StoredTables(spark, args.store) if args.store else load(spark, args.input)
    if args.store and t.version < 0:
        p.error(f"no store at {args.store}: run fill first")
    if args.operation == "vacuum":
        if not args.store:
            p.error("vacuum needs --store")
        print(f"deleted {len(t.vacuum(args.keep))} folders")
        return 0
    for name, df in _outputs(args, t).items():
        print(f"== {name}")
        df.show(args.show, truncate=False)
    after = _commit(args, t) if args.store else None
    if after is not None:
        print(f"version {after.version}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
