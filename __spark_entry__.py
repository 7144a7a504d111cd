
from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from clickflow import schemas  # noqa: E402
from clickflow.functions import jsons, numbers, text, times  # noqa: E402
from clickflow.operators import bands, categories, pageflow, sampling, sessions, states  # noqa: E402
from clickflow.operators.filters import (  # noqa: E402
    clicks,
    date_range,
    orders,
    pays,
)
from clickflow.operators.staging import fresh_path, stage  # noqa: E402
from clickflow.params import TaskParams, task_id_from_args, task_params  # noqa: E402
from clickflow.plans import jobs  # noqa: E402
from clickflow.sinks import results, versions  # noqa: E402
from clickflow.sources import events  # noqa: E402
from clickflow.sources.catalog import actions_table, register_view  # noqa: E402

try:
    import corpus_pipeline
    from clickflow.llm import queries as llm_queries
    from clickflow.llm import sql as llm_sql
except ModuleNotFoundError as missing:
    # The subpackage is optional; anything else that is missing is a fault.
    if missing.name not in ("corpus_pipeline", "clickflow.llm"):
        raise
    corpus_pipeline = llm_queries = llm_sql = None

SMOKE_DIR = "/root/testdata/sf0.001"
TASK_ID = 1
SAMPLE_SIZE = 3000
FLOW = (0, 1, 2, 3, 4, 5)

TASK_JSON = {
    "startDate": ["2024-01-05"],
    "endDate": ["2024-01-20"],
    "startAge": ["20"],
    "endAge": ["50"],
    "professionals": ["BUILDING,MACHINERY,HOUSEHOLD,FURNITURE"],
    "cities": [
        "NATION_0,NATION_2,NATION_4,NATION_6,NATION_8,NATION_10,NATION_12,NATION_16,NATION_19,NATION_20"
    ],
    "sex": ["male"],
    "keywords": ["kw1,kw2,kw3,kw4,kw5"],
    "categoryIds": ["3,7,11,15,22,28,31,36,42,47,50,54,59,63,68,72,77,81,88,93"],
}
ALL = TaskParams.from_texts({name: values[0] for name, values in TASK_JSON.items()})
SIX = ALL.with_(category_ids=None)
# Dates, age, professions and sex: wide enough to leave many sessions.
WIDE = SIX.with_(cities=None, keywords=None)
DATES = TaskParams(start_date=ALL.start_date, end_date=ALL.end_date)


def _actions(spark, sf_dir, params=TaskParams()):
    return date_range(events.load_actions(spark, sf_dir), params)


def _kept(spark, sf_dir, params):
    return sessions.kept_sessions(_actions(spark, sf_dir, params), events.load_users(spark, sf_dir), params)


def _full(spark, sf_dir, params=TaskParams()):
    rolled = sessions.session_rollup(_actions(spark, sf_dir, params))
    return sessions.attach_users(rolled, events.load_users(spark, sf_dir))


def _plain(actions):
    """The 12 action columns with date and time as text."""
    return actions.select(*schemas.USER_VISIT_ACTION.names).withColumns(
        {"date": times.format_date(F.col("date")), "action_time": times.format_time(F.col("action_time"))}
    )


def actions_date_range(spark, sf_dir):
    return _plain(_actions(spark, sf_dir, DATES))


def session_rollup(spark, sf_dir):
    return sessions.with_time_text(sessions.session_rollup(_actions(spark, sf_dir)))


def session_full(spark, sf_dir):
    return sessions.with_time_text(_full(spark, sf_dir))


def _filter_query(**changes):
    params = TaskParams(start_date=ALL.start_date, end_date=ALL.end_date, **changes)
    return lambda spark, sf_dir: _kept(spark, sf_dir, params).select("session_id")


def filter_all(spark, sf_dir):
    kept = stage(_kept(spark, sf_dir, SIX), "kept_sessions")
    return sessions.with_time_text(sessions.kept_rollup(_actions(spark, sf_dir, DATES), kept))


def _tasks(spark, param):
    row = (TASK_ID, "task", None, None, None, None, None, json.dumps(param))
    return register_view(spark, [row], schemas.TASK, "task")


def task_filter(spark, sf_dir):
    params = task_params(_tasks(spark, TASK_JSON), task_id_from_args([str(TASK_ID)]))
    return _kept(spark, sf_dir, params).select("session_id")


def _job(spark, sf_dir, target=None):
    """The whole job, from the task's JSON to the paths of the written tables."""
    names = ("startDate", "endDate", "startAge", "endAge", "professionals", "sex")
    param = {name: TASK_JSON[name] for name in names}
    param["targetPageFlow"] = [",".join(map(str, FLOW))]
    return jobs.run_task(
        spark,
        [str(TASK_ID)],
        _tasks(spark, param),
        events.load_actions(spark, sf_dir),
        events.load_users(spark, sf_dir),
        target or fresh_path(spark, "results"),
        tiebreak="event_id",
        sample_size=SAMPLE_SIZE,
    )


def session_analysis(spark, sf_dir):
    """The whole job as rows per written table."""
    return results.row_counts({name: spark.read.parquet(path) for name, path in _job(spark, sf_dir).items()})


JOB_TABLES = {
    "session_aggr_stat": schemas.SESSION_AGGR_STAT,
    "session_random_extract": schemas.SESSION_RANDOM_EXTRACT,
    "session_detail": schemas.SESSION_DETAIL,
    "top10_category": schemas.TOP_CATEGORY,
    "top10_session": schemas.TOP_SESSION,
    "top10_session_detail": schemas.SESSION_DETAIL,
    "page_conversion": schemas.PAGE_CONVERSION,
}


def _job_table(name):
    """One table of the version that the whole job has committed."""

    def run(spark, sf_dir):
        target = fresh_path(spark, "results")
        _job(spark, sf_dir, target)
        return versions.read_table(spark, target, name, JOB_TABLES[name])

    return run


def _stored_states(spark, actions):
    path = fresh_path(spark, "session_states")
    states.write_states(states.session_states(actions), path)
    return path


def rollup_from_states(spark, sf_dir):
    path = _stored_states(spark, _actions(spark, sf_dir))
    return sessions.with_time_text(states.rollup_from_states(states.read_states(spark, path)))


def weekly_rollup_from_states(spark, sf_dir):
    """Sessions of a user's week: each is merged from several days."""
    week = F.concat("user_id", F.lit("_w"), F.weekofyear("date"))
    path = _stored_states(spark, _actions(spark, sf_dir).withColumn("session_id", week))
    return sessions.with_time_text(states.rollup_from_states(states.read_states(spark, path)))


def filter_from_states(spark, sf_dir):
    """All of the task's conditions on states stored for every day."""
    path = _stored_states(spark, _actions(spark, sf_dir))
    return states.kept_from_states(states.read_states(spark, path, ALL), events.load_users(spark, sf_dir), ALL).select("session_id")


def _stored_counters(spark, sf_dir):
    """Counters by day, written in two goes of which the second repeats some days."""
    path = fresh_path(spark, "counter_states")
    found = stage(bands.counter_states(_kept(spark, sf_dir, WIDE)), "counters")
    bands.write_counter_states(found, path)
    bands.write_counter_states(found.filter("day(date) % 2 = 0"), path)
    return bands.read_counter_states(spark, path)


def merged_counters(spark, sf_dir):
    return bands.merge_counters(_stored_counters(spark, sf_dir))


def stat_from_counters(spark, sf_dir):
    return bands.stat_of_counters(_stored_counters(spark, sf_dir), TASK_ID)


def few_session_actions(spark, sf_dir):
    """The actions of a hundred sessions, looked up in an action table laid out for that."""
    path = fresh_path(spark, "user_visit_action")
    results.write_actions(_actions(spark, sf_dir).select(*schemas.USER_VISIT_ACTION.names), path)
    stored = results.read_result(spark, path, schemas.USER_VISIT_ACTION)
    few = results.preview(sessions.session_measures(stored).select("session_id"), 100, F.md5("session_id"), "session_id")
    few = stage(few, "few_sessions")
    return _plain(sessions.actions_of(sessions.push_sessions(stored, few), few))


def visit_bands(spark, sf_dir):
    return bands.visit_bands(sessions.session_measures(_actions(spark, sf_dir)))


def step_bands(spark, sf_dir):
    return bands.step_bands(sessions.session_measures(_actions(spark, sf_dir)))


def band_counters(spark, sf_dir):
    return bands.counters(_kept(spark, sf_dir, WIDE))


def session_aggr_stat(spark, sf_dir):
    return jobs.band_statistics(_kept(spark, sf_dir, WIDE), TASK_ID)


def sessions_per_hour(spark, sf_dir):
    return sampling.sessions_per_hour(_kept(spark, sf_dir, TaskParams()))


def sample_quota(spark, sf_dir):
    return sampling.sample_quota(_kept(spark, sf_dir, TaskParams()), SAMPLE_SIZE)


def _sample_actions(spark, sf_dir):
    kept = stage(_kept(spark, sf_dir, TaskParams()), "kept_sessions")
    sample = sampling.sample_sessions(kept, SAMPLE_SIZE)
    return sessions.actions_of(_actions(spark, sf_dir), sample)


def session_random_extract(spark, sf_dir):
    return sampling.extract_records(_sample_actions(spark, sf_dir), TASK_ID)


def session_detail(spark, sf_dir):
    return sampling.detail_records(_sample_actions(spark, sf_dir), TASK_ID)


def kept_session_actions(spark, sf_dir):
    kept = stage(_kept(spark, sf_dir, WIDE), "kept_sessions")
    return _plain(sessions.actions_of(_actions(spark, sf_dir, WIDE), kept))


def _counts(spark, sf_dir, only=lambda actions: actions):
    kept = stage(_kept(spark, sf_dir, WIDE), "kept_sessions")
    return categories.kept_category_counts(only(_actions(spark, sf_dir, WIDE)), kept)


def category_touches(spark, sf_dir):
    return categories.category_touches(_actions(spark, sf_dir))


def categories_touched(spark, sf_dir):
    return categories.categories_touched(_counts(spark, sf_dir))


def category_clicks(spark, sf_dir):
    return categories.category_count(_counts(spark, sf_dir, clicks), "click")


def category_orders(spark, sf_dir):
    return categories.category_count(_counts(spark, sf_dir, orders), "order")


def category_pays(spark, sf_dir):
    return categories.category_count(_counts(spark, sf_dir, pays), "pay")


def top10_categories(spark, sf_dir):
    return categories.top_categories(_counts(spark, sf_dir))


def _ranked(spark, sf_dir, **tops):
    kept = stage(_kept(spark, sf_dir, WIDE), "kept_sessions")
    return jobs.ranked_sessions(_actions(spark, sf_dir, WIDE), kept, **tops)


def top10_category_sessions(spark, sf_dir):
    return _ranked(spark, sf_dir)[1]


def top5_sessions_of_top20(spark, sf_dir):
    return _ranked(spark, sf_dir, top=20, top_sessions=5)[1]


def top10_session_detail(spark, sf_dir):
    active = stage(_ranked(spark, sf_dir)[1], "top_sessions")
    return sampling.detail_records(sessions.actions_of(_actions(spark, sf_dir, WIDE), active), TASK_ID)


def _gapped(spark, sf_dir):
    """Actions of which some have no session and some no time."""
    return _actions(spark, sf_dir).withColumns(
        {
            "session_id": F.expr("if(event_id % 50 = 0, NULL, session_id)"),
            "action_time": F.expr("if(user_id % 7 = 0 OR event_id % 31 = 0, NULL, action_time)"),
        }
    )


def _gapped_kept(spark, sf_dir):
    return sessions.kept_sessions(_gapped(spark, sf_dir), events.load_users(spark, sf_dir), TaskParams())


def gaps_band_counters(spark, sf_dir):
    return bands.counters(_gapped_kept(spark, sf_dir))


def gaps_sample(spark, sf_dir):
    """Per hour, its quota and how many sessions were drawn."""
    kept = stage(_gapped_kept(spark, sf_dir), "kept_sessions")
    drawn = sampling.sample_quota(sampling.sample_sessions(kept, SAMPLE_SIZE), SAMPLE_SIZE)
    drawn = drawn.select("date", "hour", F.col("sessions").alias("drawn"))
    quota = sampling.sample_quota(kept, SAMPLE_SIZE)
    return quota.join(drawn, ["date", "hour"], "left").na.fill(0, ["drawn"])


def gaps_page_slices(spark, sf_dir):
    steps = pageflow.page_steps(_gapped(spark, sf_dir), tiebreak="event_id")
    return pageflow.page_slices(steps)


def sink_bucketed_roundtrip(spark, sf_dir):
    table = f"clickflow_actions_{uuid.uuid4().hex}"
    results.write_bucketed_actions(_actions(spark, sf_dir).select(*schemas.USER_VISIT_ACTION.names), table, 8)
    return _plain(actions_table(spark, table))


def _steps(spark, sf_dir):
    return pageflow.page_steps(_actions(spark, sf_dir), tiebreak="event_id")


def page_slices(spark, sf_dir):
    return pageflow.page_slices(_steps(spark, sf_dir))


def page_slices_by_page(spark, sf_dir):
    """Without a tiebreak column: actions of the same second are ordered by page."""
    return pageflow.page_slices(pageflow.page_steps(_actions(spark, sf_dir)))


def page_flow_matches(spark, sf_dir):
    return pageflow.page_flow_matches(_steps(spark, sf_dir), FLOW)


def page_conversion(spark, sf_dir):
    return pageflow.page_conversion(_steps(spark, sf_dir), FLOW)


def row_counts(spark, sf_dir):
    actions = _actions(spark, sf_dir)
    return results.row_counts(
        {
            "user_visit_action": actions,
            "user_info": events.load_users(spark, sf_dir),
            "session": sessions.session_measures(actions),
        }
    )


def first_sessions(spark, sf_dir):
    rolled = sessions.with_time_text(sessions.session_measures(_actions(spark, sf_dir)))
    return results.preview(rolled, 10, "session_id")


def _encoded(spark, sf_dir):
    full = sessions.with_time_text(_full(spark, sf_dir))
    fields = {
        "sessionId": "session_id",
        "searchKeyWords": "search_keywords",
        "clickCategoryIds": "click_category_ids",
        "visitLength": "visit_length",
        "stepLength": "step_length",
        "startTime": "start_time",
        "age": "age",
        "professional": "professional",
        "city": "city",
        "sex": "sex",
    }
    record = text.kv_encode([(key, F.col(name)) for key, name in fields.items()])
    return full.select("session_id", record.alias("text"))


def kv_encode(spark, sf_dir):
    return _encoded(spark, sf_dir)


def kv_get(spark, sf_dir):
    def field(name):
        return text.kv_get(F.col("text"), "|", name)

    return _encoded(spark, sf_dir).select(
        "session_id",
        field("searchKeyWords").alias("search_keywords"),
        field("visitLength").alias("visit_length"),
        field("city").alias("city"),
        field("missing").alias("missing"),
    )


def kv_set(spark, sf_dir):
    changed = text.kv_set(F.col("text"), "|", "stepLength", "0")
    return _encoded(spark, sf_dir).select(
        "session_id",
        changed.alias("text"),
        text.kv_set(F.col("text"), "|", "missing", "0").alias("unchanged"),
    )


def string_exprs(spark, sf_dir):
    keyword = F.col("search_keyword")
    order = F.coalesce("order_category_ids", F.lit(""))
    return _actions(spark, sf_dir).select(
        "event_id",
        text.is_empty(keyword).cast("int").alias("empty"),
        text.is_not_empty(keyword).cast("int").alias("not_empty"),
        text.trim_comma(F.concat(F.lit(","), order, F.lit(","))).alias("trimmed"),
        text.pad_two(F.col("user_id").cast("string")).alias("padded"),
        F.array_join(text.csv_to_ids(F.concat("order_category_ids", F.lit(",,"))).cast("array<string>"), ";").alias("ids"),
    )


def date_exprs(spark, sf_dir):
    time = times.format_time(F.col("action_time"))
    unpadded = F.date_format("action_time", "yyyy-MM-dd H:mm:ss")
    noon = F.concat(times.format_date(F.col("date")), F.lit(" 12:00:00"))
    return _actions(spark, sf_dir).select(
        "event_id",
        times.before(time, noon).cast("int").alias("before"),
        times.after(unpadded, noon).cast("int").alias("after"),
        times.minus(unpadded, noon).alias("minus"),
        times.minus(time, F.lit("not a time")).alias("minus_bad"),
        times.date_hour(time).alias("date_hour"),
        times.format_date(F.col("date")).alias("date"),
        times.format_time(times.parse_time(unpadded)).alias("time"),
        times.today(F.col("date")).alias("today"),
        times.yesterday(F.col("date")).alias("yesterday"),
    )


def ratio_half_up(spark, sf_dir):
    counted = _actions(spark, sf_dir).groupBy("user_id").agg(
        F.count("click_category_id").alias("clicks"), F.count(F.lit(1)).alias("actions")
    )
    return counted.withColumn("rate", numbers.ratio("clicks", "actions"))


def format_double(spark, sf_dir):
    value = F.col("value")
    return events.read(spark, sf_dir, "events").select(
        "event_id",
        numbers.format_double(value / 8, 2).alias("eighth"),
        numbers.format_double(-value / 1000, 2).alias("small"),
    )


def json_exprs(spark, sf_dir):
    props = F.col("props")
    listed = F.concat(F.lit('{"field":["'), F.col("event_type"), F.lit('","other"]}'))
    return events.read(spark, sf_dir, "events").select(
        "event_id",
        jsons.first_of_array(listed, "field").alias("first"),
        jsons.first_of_array(listed, "missing").alias("missing"),
        jsons.field_of_first(F.concat(F.lit("["), props, F.lit("]")), "k").alias("k"),
    )


def view_roundtrip(spark, sf_dir):
    register_view(spark, _actions(spark, sf_dir), schemas.USER_VISIT_ACTION, "user_visit_action")
    return _plain(actions_table(spark))


def _written(spark, name, df, schema):
    path = fresh_path(spark, name)
    results.write_result(df, path, TASK_ID, jobs.TASK_KEYS[name])
    return results.read_result(spark, path, schema)


def sink_roundtrip(spark, sf_dir):
    stat = session_aggr_stat(spark, sf_dir)
    return _written(spark, "session_aggr_stat", stat, schemas.SESSION_AGGR_STAT)


def sink_extract_roundtrip(spark, sf_dir):
    extract = session_random_extract(spark, sf_dir)
    return _written(spark, "session_random_extract", extract, schemas.SESSION_RANDOM_EXTRACT)


def sink_detail_roundtrip(spark, sf_dir):
    detail = session_detail(spark, sf_dir)
    return _written(spark, "session_detail", detail, schemas.SESSION_DETAIL)


def sink_actions_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "user_visit_action")
    results.write_actions(_actions(spark, sf_dir).select(*schemas.USER_VISIT_ACTION.names), path)
    return _plain(results.read_result(spark, path, schemas.USER_VISIT_ACTION))


def sink_users_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "user_info")
    results.write_users(events.load_users(spark, sf_dir), path)
    return results.read_result(spark, path, schemas.USER_INFO)


def sink_users_merged(spark, sf_dir):
    """All users, then those of one sex once more under new names."""
    path = fresh_path(spark, "user_info")
    users = events.load_users(spark, sf_dir)
    results.write_users(users, path)
    results.write_users(users.filter("sex = 'female'").withColumn("name", F.concat(F.lit("new "), "name")), path)
    return results.read_result(spark, path, schemas.USER_INFO)


def sink_actions_rewritten(spark, sf_dir):
    """All days, then every second one once more with its clicks only."""
    path = fresh_path(spark, "user_visit_action")
    actions = _actions(spark, sf_dir).select(*schemas.USER_VISIT_ACTION.names)
    results.write_actions(actions, path)
    results.write_actions(clicks(actions).filter("day(date) % 2 = 0"), path)
    return _plain(results.read_result(spark, path, schemas.USER_VISIT_ACTION))


def entry(spark: SparkSession) -> DataFrame:
    """Band statistics of the kept sessions."""
    return session_aggr_stat(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        actions_date_range,
        session_rollup,
        session_full,
        filter_all,
        task_filter,
        visit_bands,
        step_bands,
        band_counters,
        session_aggr_stat,
        sessions_per_hour,
        sample_quota,
        session_random_extract,
        session_detail,
        kept_session_actions,
        category_touches,
        categories_touched,
        category_clicks,
        category_orders,
        category_pays,
        top10_categories,
        top10_category_sessions,
        top5_sessions_of_top20,
        top10_session_detail,
        gaps_band_counters,
        gaps_sample,
        gaps_page_slices,
        page_slices,
        page_slices_by_page,
        page_flow_matches,
        page_conversion,
        row_counts,
        first_sessions,
        kv_encode,
        kv_get,
        kv_set,
        string_exprs,
        date_exprs,
        ratio_half_up,
        format_double,
        json_exprs,
        view_roundtrip,
        sink_roundtrip,
        sink_extract_roundtrip,
        sink_detail_roundtrip,
        sink_actions_roundtrip,
        sink_bucketed_roundtrip,
        sink_users_roundtrip,
        sink_users_merged,
        sink_actions_rewritten,
        rollup_from_states,
        weekly_rollup_from_states,
        filter_from_states,
        merged_counters,
        stat_from_counters,
        few_session_actions,
        session_analysis,
    ]
    found = {function.__name__: function for function in named}
    found |= {f"job_{name}": _job_table(name) for name in JOB_TABLES}
    found["filter_age"] = _filter_query(start_age=ALL.start_age, end_age=ALL.end_age)
    found["filter_professional_city"] = _filter_query(professionals=ALL.professionals, cities=ALL.cities)
    found["filter_sex"] = _filter_query(sex=ALL.sex)
    found["filter_keywords"] = _filter_query(keywords=ALL.keywords)
    found["filter_categories"] = _filter_query(category_ids=ALL.category_ids)
    if llm_queries is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.build(TASK_JSON, TASK_ID, SAMPLE_SIZE, sampling.DEFAULT_SEED, FLOW)
    if llm_sql is not None:
        found |= llm_sql.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
