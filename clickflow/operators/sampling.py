"""Time-proportional random sample of sessions, and the records written for it."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.functions.times import date_hour, format_date, format_time
from clickflow.operators.sessions import session_rollup
from clickflow.operators.staging import stage

DEFAULT_SIZE = 100
DEFAULT_SEED = 0
# How far above an hour's quota hashes are looked at, in standard deviations, and the bound's hex digits.
SPREAD = 6.0
CUT_DIGITS = 12


def _started(sessions: DataFrame) -> DataFrame:
    """Sessions with a known start; others have no hour and are neither counted nor drawn."""
    return sessions.filter(F.col("start_time").isNotNull())


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """(date_hour, sessions) by the hour a session starts in."""
    key = date_hour(format_time(F.col("start_time")))
    return _started(sessions).groupBy(key.alias("date_hour")).agg(F.count(F.lit(1)).alias("sessions"))


def _hour_keys():
    return [format_date(F.col("start_time")).alias("date"), F.hour("start_time").alias("hour")]


def _with_quota(counted: DataFrame, count: str, size: int) -> DataFrame:
    """Adds ``sessions`` of the (date, hour) and its ``quota`` to counts per date, hour or finer.

    Each day gets an equal share of ``size``, split over its hours by their sessions.
    """
    # One task sees all rows here, one for each hour, so that what was counted is not counted again.
    days = F.size(F.collect_set("date").over(W.partitionBy(F.lit(0))))
    per_day = F.call_function("div", F.lit(size).cast("bigint"), F.col("days").cast("bigint"))
    in_day = F.sum(count).over(W.partitionBy("date"))
    in_hour = F.sum(count).over(W.partitionBy("date", "hour"))
    share = F.col("sessions").cast("double") / F.col("in_day").cast("double") * per_day
    return (
        counted.withColumns({"in_day": in_day, "sessions": in_hour})
        .withColumn("days", days)
        .withColumn("quota", F.least(F.floor(share), F.col("sessions")))
        .drop("in_day", "days")
    )


def sample_quota(sessions: DataFrame, size: int = DEFAULT_SIZE) -> DataFrame:
    """(date, hour, sessions, quota)."""
    hours = _started(sessions).groupBy(*_hour_keys()).agg(F.count(F.lit(1)).alias("members"))
    return _with_quota(hours, "members", size).drop("members")


def _cut(share):
    """The hash below which ``share`` of all hashes lie, as text of as many digits as a double can tell apart."""
    digits = F.lpad(F.lower(F.hex((share * 16.0**CUT_DIGITS).cast("bigint"))), CUT_DIGITS, "0")
    # All hashes are below "g".
    return F.when(share >= 1, "g").otherwise(digits)


def sample_sessions(sessions: DataFrame, size: int = DEFAULT_SIZE, seed: int = DEFAULT_SEED, spread: float = SPREAD) -> DataFrame:
    """``quota`` sessions of every (date, hour), uniformly and without replacement, as a staged table.

    Sessions of an hour are taken in the order of a seeded hash. How many an hour has tells closely
    below which hash its quota lies: sessions well above that, by ``spread`` standard deviations, are
    left out as they are read, and no more than the quota and a few times its root are shuffled
    and ranked. Too few candidates in any hour show as rows that are missing in the end; then
    all bounds are raised, up to whole hours.

    ``sessions`` is read once for the counts and once for the candidates, and should be staged.
    """
    started = _started(sessions).filter(F.col("session_id").isNotNull())
    hours = started.groupBy(*_hour_keys()).agg(F.count(F.lit(1)).alias("members"))
    hours = stage(_with_quota(hours, "members", size).filter(F.col("quota") > 0), "sample_hours")
    wanted = hours.agg(F.sum("quota")).first()[0] or 0
    key = F.md5(F.concat(F.col("session_id"), F.lit(str(seed))))
    keyed = started.select("*", *_hour_keys(), key.alias("key"))
    in_hour = W.partitionBy("date", "hour").orderBy("key", "session_id")
    while True:
        reach = F.col("quota") + F.lit(float(spread)) * (F.sqrt("quota") + 3)
        bounds = hours.select("date", "hour", "quota", _cut(reach / F.col("sessions")).alias("high"))
        candidates = keyed.join(bounds, ["date", "hour"]).filter(F.col("key") < F.col("high"))
        ranked = candidates.withColumn("rank", F.row_number().over(in_hour)).filter(F.col("rank") <= F.col("quota"))
        drawn = stage(ranked.select(*sessions.columns), "sample")
        if drawn.count() == wanted:
            return drawn
        spread = 4 * spread


def detail_records(actions: DataFrame, task_id: int) -> DataFrame:
    """Actions as the 12 columns of the detail table."""
    names = [name for name in schemas.SESSION_DETAIL.names if name not in ("task_id", "action_time")]
    columns = {name: F.col(name) for name in names}
    columns["task_id"] = F.lit(task_id).cast("bigint")
    columns["action_time"] = format_time(F.col("action_time"))
    return actions.select(*[columns[name].alias(name) for name in schemas.SESSION_DETAIL.names])


def extract_records(sample_actions: DataFrame, task_id: int) -> DataFrame:
    """The sampled sessions' actions rolled up to the 5 columns of the extract table."""
    rolled = session_rollup(sample_actions)
    return rolled.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "session_id",
        format_time(F.col("start_time")).alias("start_time"),
        F.nullif("search_keywords", F.lit("")).alias("search_keywords"),
        F.nullif("click_category_ids", F.lit("")).alias("click_category_ids"),
    )
