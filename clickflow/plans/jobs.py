"""Session analysis and page conversion for one task."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.operators import bands, categories, pageflow, sampling
from clickflow.operators.filters import date_range
from clickflow.operators.sessions import actions_of, kept_sessions, push_sessions
from clickflow.operators.states import kept_from_states
from clickflow.operators.staging import run_folder, run_key, stage
from clickflow.params import TaskParams, task_id_from_args, task_params
from clickflow.sinks import versions
from clickflow.sinks.results import write_result_table

# Result table: its task column.
TASK_KEYS = {
    "session_aggr_stat": "taskid",
    "session_random_extract": "task_id",
    "session_detail": "task_id",
    "top10_category": "task_id",
    "top10_session": "task_id",
    "top10_session_detail": "task_id",
    "page_conversion": "task_id",
}


def _for_task(df: DataFrame, task_id: int, schema) -> DataFrame:
    return df.withColumn("task_id", F.lit(task_id).cast("bigint")).select(*schema.names)


def band_statistics(kept: DataFrame, task_id: int) -> DataFrame:
    return bands.aggr_stat(kept, task_id)


def ranked_sessions(
    actions: DataFrame,
    kept: DataFrame,
    top: int = categories.DEFAULT_TOP,
    top_sessions: int = categories.DEFAULT_TOP,
):
    """(top categories, the top sessions of each). ``kept`` should be staged.

    Counts per (session, category) are written once; both rankings read them.
    """
    counts = stage(categories.kept_category_counts(actions, kept), "category_counts")
    popular = stage(categories.top_categories(counts, top), "top_categories")
    return popular, categories.top_category_sessions(counts, popular, top_sessions)


def session_analysis(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    task_id: int,
    sample_size: int = sampling.DEFAULT_SIZE,
    seed: int = sampling.DEFAULT_SEED,
    top: int = categories.DEFAULT_TOP,
    top_sessions: int = categories.DEFAULT_TOP,
    states: DataFrame = None,
) -> dict:
    """All result tables of a task by name.

    The action table is scanned three times: for the sessions, for the category counts and
    for the details of the sampled and the most active sessions together. With stored ``states``
    of the same actions, see ``operators.states``, sessions come from these without a scan.
    """
    actions = date_range(actions, params)
    if states is None:
        kept = kept_sessions(actions, users, params)
    else:
        kept = kept_from_states(date_range(states, params), users, params)
    kept = stage(kept, "kept_sessions")
    sample = sampling.sample_sessions(kept, sample_size, seed)
    popular, active = ranked_sessions(actions, kept, top, top_sessions)
    active = stage(active, "top_sessions")

    # Staged, so that its real size decides how it meets the actions.
    chosen = sample.select("session_id").unionByName(active.select("session_id"))
    chosen = stage(chosen.distinct(), "chosen_sessions")
    detail = stage(actions_of(push_sessions(actions, chosen), chosen), "detail")
    sampled = actions_of(detail, sample)
    return {
        "session_aggr_stat": band_statistics(kept, task_id),
        "session_random_extract": sampling.extract_records(sampled, task_id),
        "session_detail": sampling.detail_records(sampled, task_id),
        "top10_category": _for_task(popular, task_id, schemas.TOP_CATEGORY),
        "top10_session": _for_task(active, task_id, schemas.TOP_SESSION),
        "top10_session_detail": sampling.detail_records(actions_of(detail, active), task_id),
    }


def page_conversion_analysis(actions: DataFrame, params: TaskParams, task_id: int, tiebreak: str = None) -> DataFrame:
    """Conversion along the task's page flow over all sessions of its date range."""
    steps = pageflow.page_steps(date_range(actions, params), tiebreak)
    rates = pageflow.page_conversion(steps, params.page_flow)
    return _for_task(rates, task_id, schemas.PAGE_CONVERSION)


def run_task(
    spark: SparkSession,
    args,
    tasks: DataFrame,
    actions: DataFrame,
    users: DataFrame,
    target: str = None,
    tiebreak: str = None,
    database: str = None,
    resume: bool = False,
    input_version: str = None,
    **options,
) -> dict:
    """Run the task named by ``args`` and write all of its result tables.

    Under ``target`` all tables of the task appear at once, as its next version, see ``versions``;
    until then readers see the version before. In the catalog database ``database`` tables are
    replaced one by one, after all of them have been computed. Returns each table's path or name.

    Staged tables are deleted at the end. With ``resume`` those of a run that failed or lost
    its driver stay, and running the same task on the same inputs goes on from there; see ``run_key``
    for what counts as the same. Only one such run of a task may be under way.
    """
    if (target is None) == (database is None):
        raise ValueError("name either a target folder or a database")
    task_id = task_id_from_args(args)
    if task_id is None:
        raise ValueError("the first argument must be a task id")
    params = task_params(tasks, task_id)
    key = None
    if resume:
        settings = {"task": task_id, "params": vars(params), "tiebreak": tiebreak, "place": target or database, **options}
        states = settings.pop("states", None)
        key = run_key([actions, users, *([] if states is None else [states])], settings, input_version)
    with run_folder(spark, key):
        results = session_analysis(actions, users, params, task_id, **options)
        if params.page_flow is not None:
            results["page_conversion"] = page_conversion_analysis(actions, params, task_id, tiebreak)
        if database is not None:
            return _replace_tables(results, task_id, database)
        version = versions.new_version(spark, target, task_id, key)
        written = {name: versions.write_table(df, target, name, task_id, version) for name, df in results.items()}
        return versions.commit(spark, target, task_id, version, written).paths(target)


def _replace_tables(results: dict, task_id: int, database: str) -> dict:
    """The task's partition of every table in ``database`` replaced; results are complete before the first is."""
    results = {name: stage(df, name) for name, df in results.items()}
    for name, df in results.items():
        write_result_table(df, f"{database}.{name}", task_id, TASK_KEYS[name])
    return {name: f"{database}.{name}" for name in results}
