"""Command line: run one task's analysis, for use with spark-submit.

    spark-submit --py-files clickflow.zip clickflow/main.py 1 --target hdfs:///results --hive

The action and user tables come from the catalog. The task comes from a catalog table, or
from a database whose JDBC options are ``key=value`` lines of ``--jdbc-file``: a password on
the command line would show in the list of processes.
"""

import argparse

from clickflow.plans.jobs import run_task
from clickflow.sources.catalog import actions_table, users_table
from clickflow.sources.jdbc import read_task
from clickflow.sources.session import build_session


def parse_args(argv=None):
    parser = argparse.ArgumentParser(prog="clickflow")
    parser.add_argument("task_id", type=int)
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--target", help="folder for the result tables")
    where.add_argument("--database", help="catalog database for the result tables")
    parser.add_argument("--actions", default="user_visit_action", help="action table")
    parser.add_argument("--users", default="user_info", help="user table")
    parser.add_argument("--tasks", default="task", help="task table")
    parser.add_argument("--jdbc-file", help="file of key=value lines: read tasks over JDBC")
    parser.add_argument("--tiebreak", help="unique integer column of the action table, for actions of one time")
    parser.add_argument("--top", type=int, default=10, help="number of top categories")
    parser.add_argument("--top-sessions", type=int, default=10, help="top sessions of each category")
    parser.add_argument("--hive", action="store_true", help="use the Hive metastore")
    parser.add_argument("--sample-size", type=int, default=100)
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--resume", action="store_true", help="go on from the staged tables of an interrupted run")
    parser.add_argument("--input-version", help="name of the inputs' state for --resume; default: their files")
    return parser.parse_args(argv)


def jdbc_options(path):
    """The options in a file of key=value lines; empty lines and lines that begin with # are skipped."""
    with open(path, encoding="utf-8") as lines:
        kept = [line.strip() for line in lines if line.strip() and not line.startswith("#")]
    return dict(line.split("=", 1) for line in kept)


def main(argv=None):
    args = parse_args(argv)
    spark = build_session(hive=args.hive)
    options = jdbc_options(args.jdbc_file) if args.jdbc_file else None
    extra = [args.tiebreak] if args.tiebreak else []
    tasks = read_task(spark, options, args.task_id, args.tasks) if options else spark.table(args.tasks)
    paths = run_task(
        spark,
        [args.task_id],
        tasks,
        actions_table(spark, args.actions, extra),
        users_table(spark, args.users),
        args.target,
        tiebreak=args.tiebreak,
        database=args.database,
        resume=args.resume,
        input_version=args.input_version,
        sample_size=args.sample_size,
        seed=args.seed,
        top=args.top,
        top_sessions=args.top_sessions,
    )
    for name, path in paths.items():
        print(name, path)
    return paths


if __name__ == "__main__":
    main()
