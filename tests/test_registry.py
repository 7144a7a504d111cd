"""Every registered query against its SQL, and the shape of the plans."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string"}
# The optional subpackage's queries have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name != "pipeline" and not re.match(r"op\d+_", name)}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name != "pipeline" and not re.match(r"op\d+_", name)}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    kinds = {column[0]: TYPES[str(column[1])] for column in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert dict(df.dtypes) == kinds
    assert normal(df.collect(), df.columns) == normal(expected, columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan, slow


def test_entry_gives_one_row(spark):
    assert entry.entry(spark).count() == 1


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_and_columns_reach_the_scan(spark):
    plan = initial_plan(QUERIES["visit_bands"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    plan = initial_plan(QUERIES["session_aggr_stat"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-05T00:00\), LessThan\(ts,2024-01-21T00:00\)", plan)


def test_sessions_without_lists_need_one_shuffle_of_primitive_state(spark):
    plan = initial_plan(QUERIES["first_sessions"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert "TakeOrderedAndProject" in plan


def test_rank_limits_run_before_the_shuffle(spark):
    plan = initial_plan(QUERIES["top10_category_sessions"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_only_actions_of_kept_sessions_are_counted(spark):
    plan = initial_plan(QUERIES["top10_categories"](spark, SF_DIR))
    assert plan.index("partial_count") < plan.index("LeftSemi")
    assert plan.count("Scan parquet") == 2  # the actions and the staged list
    assert plan.count("Exchange hashpartitioning") <= 4
    assert "TakeOrderedAndProject" in plan
