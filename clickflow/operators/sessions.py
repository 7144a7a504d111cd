"""Actions rolled up to one row per session, and sessions joined with their users."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.times import format_time, seconds_between
from clickflow.operators.filters import clicked_any, keep, searched_any, user_conditions
from clickflow.params import TaskParams

USER_COLUMNS = ("age", "professional", "city", "sex")

# Lists of up to this many sessions are named in the scan's filter; longer ones only meet in the join.
PUSHED_SESSIONS = 1_000
# Parquet's filter tests values one by one up to this many, and only their range beyond.
PUSHED_AT_ONCE = 10


def measured(rolled: DataFrame, *extra) -> DataFrame:
    return rolled.select(
        "session_id",
        "user_id",
        *extra,
        seconds_between(F.col("end_time"), F.col("start_time")).alias("visit_length"),
        "step_length",
        "start_time",
    )


def in_sessions(actions: DataFrame) -> DataFrame:
    """Actions of a session; one without a session id belongs to none and is left out."""
    return actions.filter(F.col("session_id").isNotNull())


def session_rollup(actions: DataFrame) -> DataFrame:
    """One row per session with its distinct keywords and clicked categories as sorted lists.

    One shuffle: every task first merges its own actions of a session, so a session with very
    many actions sends each task's distinct values and no more.
    """
    keyword = F.nullif(F.col("search_keyword"), F.lit(""))
    rolled = in_sessions(actions).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        F.collect_set(keyword).alias("keywords"),
        F.collect_set("click_category_id").alias("categories"),
    )
    return listed(rolled)


def listed(rolled: DataFrame) -> DataFrame:
    """Sessions with their arrays of keywords and categories as sorted lists."""
    categories = F.array_sort("categories").cast("array<string>")
    return measured(
        rolled,
        F.array_join(F.array_sort("keywords"), ",").alias("search_keywords"),
        F.array_join(categories, ",").alias("click_category_ids"),
    )


def session_measures(actions: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """One row per session without its lists, kept only if its actions meet the task.

    The keyword and category conditions become flags of the same single aggregation, whose
    state per session has a fixed size however many actions the session holds.
    """
    aggregates = [
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    flags = []
    if params.keywords is not None:
        aggregates.append(F.max(searched_any(params)).alias("searched"))
        flags.append(F.col("searched"))
    if params.category_ids is not None:
        aggregates.append(F.max(clicked_any(params)).alias("clicked"))
        flags.append(F.col("clicked"))
    return measured(keep(in_sessions(actions).groupBy("session_id").agg(*aggregates), flags))


def attach_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's attributes; sessions of unknown users are dropped.

    Spark broadcasts the users only if they are below its size limit. Beyond it both sides
    are shuffled by user and a user with very many sessions is split at run time.
    """
    return sessions.join(users.select("user_id", *USER_COLUMNS), "user_id").select(
        *sessions.columns, *USER_COLUMNS
    )


def kept_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions that meet all of the task's conditions, dates excepted.

    Same sessions as ``filter_sessions`` on the full roll-up, without building the lists.
    """
    return attach_users(session_measures(actions, params), keep(users, user_conditions(params)))


def with_time_text(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("start_time", format_time(F.col("start_time")))


def actions_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions, any number of them.

    ``sessions`` should be staged: its real size then decides between a broadcast and a
    shuffle join, and Spark can split a session with very many actions at run time, which it
    does not where the join sits directly on an aggregation.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def push_sessions(actions: DataFrame, sessions: DataFrame, most: int = PUSHED_SESSIONS) -> DataFrame:
    """``actions`` with the ids of a short list of sessions as a filter that reaches the scan.

    For use before ``actions_of``, which decides what is kept. On a table that ``write_actions`` has
    laid out the scan then skips files and pages without these sessions. ``sessions`` is read
    once, so it should be staged; no more than ``most`` of its rows, and one, come to the driver.
    """
    rows = sessions.select("session_id").limit(most + 1).collect()
    if len(rows) > most:
        return actions
    ids = sorted({row.session_id for row in rows} - {None})
    groups = [F.col("session_id").isin(ids[at : at + PUSHED_AT_ONCE]) for at in range(0, len(ids), PUSHED_AT_ONCE)]
    while len(groups) > 1:  # paired, so that the condition is not as deep as it is long
        groups = [reduce(or_, groups[at : at + 2]) for at in range(0, len(groups), 2)]
    return actions.filter(groups[0] if groups else F.lit(False))


def kept_rollup(actions: DataFrame, kept: DataFrame) -> DataFrame:
    """The full rows, lists and users included, of kept sessions.

    ``kept`` is what ``kept_sessions`` gives, staged. Lists are built for these sessions only.
    """
    rolled = session_rollup(actions_of(actions, kept))
    return rolled.join(kept.select("session_id", *USER_COLUMNS), "session_id")
