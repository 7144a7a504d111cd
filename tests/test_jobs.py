import datetime as dt
import json
import pathlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickflow import main, schemas
from clickflow.operators import staging
from clickflow.params import TaskParams
from clickflow.plans import jobs
from clickflow.sinks.results import read_result
from clickflow.sources import session

SCHEMAS = {
    "session_aggr_stat": schemas.SESSION_AGGR_STAT,
    "session_random_extract": schemas.SESSION_RANDOM_EXTRACT,
    "session_detail": schemas.SESSION_DETAIL,
    "top10_category": schemas.TOP_CATEGORY,
    "top10_session": schemas.TOP_SESSION,
    "top10_session_detail": schemas.SESSION_DETAIL,
    "page_conversion": schemas.PAGE_CONVERSION,
}
PARAMS = TaskParams(
    start_date=dt.date(2019, 1, 2), end_date=dt.date(2019, 1, 4), start_age=20, end_age=40, page_flow=(0, 1, 2)
)


@pytest.fixture
def world(actions, users):
    """About 1,000 actions; one session holds a third of them."""
    random.seed(11)
    rows = []
    for i in range(1000):
        hot = i % 3 == 0
        number = 0 if hot else random.randint(1, 120)
        day = 3 if hot else number % 5 + 1
        second = random.randint(0, 3000)
        row = dict(
            session_id=f"s{number}",
            user_id=number % 20,
            page_id=random.randint(0, 4),
            time=f"2019-01-{day:02d} {number % 4 + 8:02d}:{second // 60:02d}:{second % 60:02d}",
        )
        kind = random.choice(("search", "click", "order", "pay", "view"))
        if kind == "search":
            row["search_keyword"] = f"k{random.randint(0, 5)}"
        if kind == "click":
            row["click_category_id"] = random.randint(0, 30)
        if kind in ("order", "pay"):
            row[f"{kind}_category_ids"] = f"{random.randint(0, 30)},{random.randint(0, 30)}"
        rows.append(row)
    people = [dict(user_id=u, age=15 + u * 2, professional="p", city="c", sex="male") for u in range(18)]
    return rows, people, actions(*rows), users(*people)


def kept_ids(rows, people):
    ages = {p["user_id"]: p["age"] for p in people}
    in_range = [r for r in rows if "2019-01-02" <= r["time"][:10] <= "2019-01-04"]
    return {r["session_id"] for r in in_range if 20 <= ages.get(r["user_id"], 0) <= 40}, in_range


def test_session_analysis(world):
    rows, people, table, users = world
    found = jobs.session_analysis(table, users, PARAMS, 7, sample_size=60, top=5)
    for name, df in found.items():
        assert df.schema.names == SCHEMAS[name].names
        assert [f.dataType for f in df.schema] == [f.dataType for f in SCHEMAS[name]]
    kept, in_range = kept_ids(rows, people)
    assert "s0" not in kept or people[0]["age"] >= 20
    assert found["session_aggr_stat"].first().session_count == len(kept)

    extract = [r.session_id for r in found["session_random_extract"].collect()]
    assert 0 < len(extract) <= 60
    assert len(extract) == len(set(extract)) and set(extract) <= kept
    steps = Counter(r["session_id"] for r in in_range)
    detail = Counter(r.session_id for r in found["session_detail"].collect())
    assert detail == {s: steps[s] for s in extract}

    counts = defaultdict(lambda: [0, 0, 0])
    clicks = Counter()
    for row in in_range:
        if row["session_id"] not in kept:
            continue
        if "click_category_id" in row:
            counts[row["click_category_id"]][0] += 1
            clicks[row["click_category_id"], row["session_id"]] += 1
        for place, kind in ((1, "order"), (2, "pay")):
            for c in row.get(f"{kind}_category_ids", "").split(","):
                if c:
                    counts[int(c)][place] += 1
    best = sorted(counts.items(), key=lambda item: ([-n for n in item[1]], item[0]))[:5]
    assert sorted(map(tuple, found["top10_category"].collect())) == sorted((7, c, *n) for c, n in best)
    active = set()
    for category, _ in best:
        ranked = sorted((-n, s) for (c, s), n in clicks.items() if c == category)[:5]
        active |= {(7, category, s, -n) for n, s in ranked}
    assert {tuple(r) for r in found["top10_session"].collect()} == active
    top_detail = Counter(r.session_id for r in found["top10_session_detail"].collect())
    assert top_detail == {s: steps[s] for _, _, s, _ in active}


def test_large_kept_lists_give_the_same_ranking(world):
    _, _, table, users = world
    small = jobs.session_analysis(table, users, PARAMS, 7)
    spark = table.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = jobs.session_analysis(table.repartition(11), users, PARAMS, 7)
        large = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in large.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in small:
        assert sorted(map(repr, small[name].collect())) == sorted(map(repr, large[name].collect())), name


def task_table(spark):
    param = {
        "startDate": ["2019-01-02"], "endDate": ["2019-01-04"], "startAge": ["20"], "endAge": ["40"],
        "targetPageFlow": ["0,1,2"],
    }
    row = (7, "t", None, None, None, None, None, json.dumps(param))
    return spark.createDataFrame([row], schemas.TASK)


def test_run_task_writes_every_table_and_can_be_repeated(spark, world, tmp_path):
    _, _, table, users = world

    def run():
        paths = jobs.run_task(spark, ["7"], task_table(spark), table, users, str(tmp_path), sample_size=60)
        assert set(paths) == set(SCHEMAS) == set(jobs.TASK_KEYS)
        return {
            name: sorted(map(repr, read_result(spark, path, SCHEMAS[name]).collect())) for name, path in paths.items()
        }

    first = run()
    assert all(first.values())
    assert run() == first


def test_run_task_needs_a_task_id(spark, world, tmp_path):
    _, _, table, users = world
    with pytest.raises(ValueError):
        jobs.run_task(spark, [], task_table(spark), table, users, str(tmp_path))
    with pytest.raises(LookupError):
        jobs.run_task(spark, ["8"], task_table(spark), table, users, str(tmp_path))


def test_page_conversion_covers_all_sessions_of_the_dates(world):
    rows, _, table, _ = world
    in_range = [r for r in rows if "2019-01-02" <= r["time"][:10] <= "2019-01-04"]
    groups = defaultdict(list)
    for row in in_range:
        groups[row["session_id"]].append((row["time"], row["page_id"]))
    hops = Counter()
    for group in groups.values():
        pages = [p for _, p in sorted(group)]
        hops.update(zip(pages, pages[1:]))
    views = sum(r["page_id"] == 0 for r in in_range)
    found = [tuple(r) for r in jobs.page_conversion_analysis(table, PARAMS, 7).collect()]
    assert [(f[0], f[1], f[2]) for f in found] == [(7, "0_1", hops[0, 1]), (7, "1_2", hops[1, 2])]
    assert found[0][3] == pytest.approx(hops[0, 1] / views, abs=0.0051)


def test_staged_tables_of_a_run_are_deleted(spark):
    with staging.run_folder(spark) as path:
        staged = staging.stage(spark.range(3), "numbers")
        assert staged.count() == 3
        assert path.split(":")[-1] in staged.inputFiles()[0]
        local = pathlib.Path(path.split(":")[-1])
        assert local.exists()
    assert not local.exists()


def test_staged_tables_are_deleted_after_a_failure(spark):
    with pytest.raises(RuntimeError):
        with staging.run_folder(spark) as path:
            staging.stage(spark.range(3), "numbers")
            raise RuntimeError
    assert not pathlib.Path(path.split(":")[-1]).exists()


def test_command_line_runs_a_task_on_catalog_tables(spark, world, tmp_path):
    _, _, table, users = world
    table.createOrReplaceTempView("cli_actions")
    users.createOrReplaceTempView("cli_users")
    task_table(spark).createOrReplaceTempView("cli_tasks")
    paths = main.main(
        ["7", "--target", str(tmp_path), "--actions", "cli_actions", "--users", "cli_users", "--tasks", "cli_tasks"]
    )
    assert set(paths) == set(SCHEMAS)
    assert read_result(spark, paths["session_aggr_stat"], schemas.SESSION_AGGR_STAT).first().taskid == 7


def test_command_line_options():
    args = main.parse_args(["3", "--target", "t", "--tiebreak", "event_id", "--top", "20", "--top-sessions", "5", "--hive"])
    assert (args.task_id, args.hive, args.tiebreak, args.top, args.top_sessions) == (3, True, "event_id", 20, 5)
    with pytest.raises(SystemExit):
        main.parse_args(["3"])


def test_jdbc_options_come_from_a_file(tmp_path):
    (tmp_path / "options").write_text("# of the task database\nurl=jdbc:x?a=b\n\nuser=u\n")
    assert main.jdbc_options(tmp_path / "options") == {"url": "jdbc:x?a=b", "user": "u"}


def test_command_line_with_tiebreak_writes_catalog_tables(spark, world):
    _, _, table, users = world
    numbered = table.withColumn("event_id", F.monotonically_increasing_id())
    numbered.createOrReplaceTempView("numbered_actions")
    users.createOrReplaceTempView("cli_users")
    task_table(spark).createOrReplaceTempView("cli_tasks")
    spark.sql("CREATE DATABASE IF NOT EXISTS run_results")
    names = ["--actions", "numbered_actions", "--users", "cli_users", "--tasks", "cli_tasks"]
    tables = main.main(["7", "--database", "run_results", "--tiebreak", "event_id", "--top", "3", *names])
    assert set(tables) == set(SCHEMAS)
    assert spark.table(tables["top10_category"]).count() == 3
    assert spark.table(tables["page_conversion"]).filter("task_id = 7").count() == 2


def test_a_bad_page_flow_is_found_before_any_work():
    with pytest.raises(ValueError):
        TaskParams.from_texts({"targetPageFlow": "1,2,1"})


class Fixed:
    """A context whose master is not this process."""

    applicationId = "app"

    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_clusters_need_a_shared_folder(master):
    class Session:
        conf = {}
        sparkContext = Fixed(master)

    with pytest.raises(ValueError):
        staging.shared_folder(Session())


def test_session_settings(spark):
    for key, value in session.SETTINGS.items():
        assert spark.conf.get(key) == value
