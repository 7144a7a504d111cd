"""Partial session states by day, stored once and merged for any range of days.

A day's state of a session holds what its roll-up needs: first and last time, number of actions,
distinct keywords and categories. States of one session merge by minimum, maximum, sum and union,
so a session over midnight is whole again once its days meet, and a new day costs a scan of that
day alone. A range of days is read from the states, which are as many rows as days have sessions.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.text import any_of
from clickflow.operators.filters import category_ids, date_range, keep, user_conditions
from clickflow.operators.sessions import attach_users, in_sessions, listed, measured
from clickflow.params import TaskParams

STATE = """date date, session_id string, user_id bigint, first_time timestamp_ntz, last_time timestamp_ntz,
    steps bigint, keywords array<string>, categories array<bigint>"""


def session_states(actions: DataFrame) -> DataFrame:
    """One row per day and session, the columns of ``STATE``; an action without a session has none."""
    keyword = F.nullif(F.col("search_keyword"), F.lit(""))
    return in_sessions(actions).groupBy("date", "session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("first_time"),
        F.max("action_time").alias("last_time"),
        F.count(F.lit(1)).alias("steps"),
        F.collect_set(keyword).alias("keywords"),
        F.collect_set("click_category_id").alias("categories"),
    )


def write_states(states: DataFrame, path: str) -> None:
    """Replaces the days that ``states`` holds, others stay; so a day may be written again."""
    balanced = states.hint("rebalance", "date")
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def read_states(spark: SparkSession, path: str, params: TaskParams = TaskParams()) -> DataFrame:
    """Stored states of the task's dates; only their days are read."""
    return date_range(spark.read.schema(STATE).parquet(path), params)


def _merge(states: DataFrame, *extra) -> DataFrame:
    return states.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("first_time").alias("start_time"),
        F.max("last_time").alias("end_time"),
        F.sum("steps").alias("step_length"),
        *extra,
    )


def _united(lists: str):
    """The distinct values of all days' lists; a day's list has been made distinct before."""
    return F.array_distinct(F.flatten(F.collect_list(lists))).alias(lists)


def rollup_from_states(states: DataFrame) -> DataFrame:
    """The rows of ``session_rollup`` over the actions that the states were made of."""
    return listed(_merge(states, _united("keywords"), _united("categories")))


def measures_from_states(states: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """The rows of ``session_measures``; the keyword and category conditions are tested on each day's lists."""
    flags, tests = [], []
    if params.keywords is not None:
        tests.append(F.max(F.exists("keywords", lambda k: any_of(k, params.keywords))).alias("searched"))
        flags.append(F.col("searched"))
    if params.category_ids is not None:
        wanted = F.array(*map(F.lit, category_ids(params))).cast("array<bigint>")
        tests.append(F.max(F.arrays_overlap("categories", wanted)).alias("clicked"))
        flags.append(F.col("clicked"))
    return measured(keep(_merge(states, *tests), flags))


def kept_from_states(states: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """The rows of ``kept_sessions`` over the actions that the states were made of."""
    return attach_users(measures_from_states(states, params), keep(users, user_conditions(params)))
