import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.operators import staging
from clickflow.operators.filters import date_range
from clickflow.operators.sessions import actions_of, push_sessions, session_measures
from clickflow.operators.staging import stage
from clickflow.params import TaskParams
from clickflow.sinks import results
from clickflow.sources import catalog, jdbc


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_view_with_explicit_schema(spark, actions):
    rows = [tuple(r) for r in actions(dict(session_id="a", time="2019-01-20 08:00:00", page_id=3)).collect()]
    catalog.register_view(spark, rows, schemas.USER_VISIT_ACTION, "user_visit_action")
    table = catalog.actions_table(spark)
    assert table.schema.names == schemas.USER_VISIT_ACTION.names
    assert table.first().page_id == 3


def test_conform_reads_text_times_with_one_digit_hours(spark):
    row = ("2019-01-20", "1", "s", "7", "2019-01-20 8:12:33") + (None,) * 7
    names = schemas.USER_VISIT_ACTION.names
    table = spark.createDataFrame([row], ", ".join(f"{name} string" for name in names))
    found = catalog.conform(table, schemas.USER_VISIT_ACTION)
    assert found.schema == schemas.USER_VISIT_ACTION
    assert tuple(found.first())[:5] == (
        dt.date(2019, 1, 20), 1, "s", 7, dt.datetime(2019, 1, 20, 8, 12, 33),
    )


def test_bad_times_raise(spark):
    names = schemas.USER_VISIT_ACTION.names
    row = tuple("soon" if name == "action_time" else None for name in names)
    table = spark.createDataFrame([row], ", ".join(f"{name} string" for name in names))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        catalog.conform(table, schemas.USER_VISIT_ACTION).collect()


def test_users_table_by_name(spark, users):
    users(dict(user_id=1, age=3)).createOrReplaceTempView("user_info")
    assert catalog.users_table(spark).first().age == 3


def stat(spark, task, count):
    return spark.createDataFrame([(task, "s", count)], "task_id bigint, session_id string, n bigint")


def test_writing_a_task_again_replaces_only_that_task(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = stat(spark, 1, 1).schema
    results.write_result(stat(spark, 1, 10), path, 1)
    results.write_result(stat(spark, 2, 20), path, 2)
    results.write_result(stat(spark, 1, 11), path, 1)
    found = results.read_result(spark, path, schema)
    assert found.schema == schema
    assert sorted(map(tuple, found.collect())) == [(1, "s", 11), (2, "s", 20)]
    results.write_result(stat(spark, 1, 0).limit(0), path, 1)
    assert [tuple(r) for r in results.read_result(spark, path, schema).collect()] == [(2, "s", 20)]


def test_writing_a_task_again_into_a_catalog_table(spark):
    for task, count in ((1, 10), (2, 20), (1, 11)):
        results.write_result_table(stat(spark, task, count), "stat_result", task)
    found = spark.table("stat_result").select("task_id", "n")
    assert sorted(map(tuple, found.collect())) == [(1, 11), (2, 20)]


def many_actions(actions):
    return actions(
        *[
            dict(session_id=f"s{i % 9}", user_id=i % 4, time=f"2019-01-{20 + i % 3} 08:00:{i % 60:02d}", page_id=i)
            for i in range(120)
        ]
    )


def test_action_table_by_day_prunes_days(spark, actions, tmp_path):
    path = str(tmp_path / "actions")
    table = many_actions(actions)
    results.write_actions(table, path)
    back = results.read_result(spark, path, schemas.USER_VISIT_ACTION)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, table.collect()))
    one_day = back.filter(F.col("date") == F.lit(dt.date(2019, 1, 21)))
    assert one_day.count() == 40
    assert "PartitionFilters: [isnotnull(date" in plan(one_day)


def test_bucketed_action_table_rolls_up_without_a_shuffle(spark, actions):
    table = many_actions(actions)
    results.write_bucketed_actions(table, "bucketed_actions", 4)
    rolled = session_measures(spark.table("bucketed_actions"))
    assert "Exchange" not in plan(rolled)
    assert sorted(map(tuple, rolled.collect())) == sorted(map(tuple, session_measures(table).collect()))


def test_bucketed_writes_make_one_file_per_day_and_bucket(spark, actions):
    rows = [dict(session_id=f"s{i}", time=f"2019-01-{20 + i % 3} 08:00:00") for i in range(300)]
    results.write_bucketed_actions(actions(*rows).repartition(7), "few_files", 4)
    assert len(spark.table("few_files").inputFiles()) <= 3 * 4


def days(spark, path):
    rows = results.read_result(spark, path, schemas.USER_VISIT_ACTION).collect()
    return sorted((str(r.date), r.session_id) for r in rows)


def test_action_writes_replace_their_days(spark, actions, tmp_path):
    path = str(tmp_path / "actions")

    def day(number, *names):
        return actions(*(dict(session_id=n, time=f"2019-01-{number} 08:00:00") for n in names))

    results.write_actions(day(20, "a", "b").union(day(21, "c")), path)
    results.write_actions(day(20, "a", "b").union(day(21, "c")), path)
    assert days(spark, path) == [("2019-01-20", "a"), ("2019-01-20", "b"), ("2019-01-21", "c")]
    results.write_actions(day(21, "d").union(day(22, "e", "e")), path)
    assert days(spark, path) == [
        ("2019-01-20", "a"), ("2019-01-20", "b"), ("2019-01-21", "d"), ("2019-01-22", "e"), ("2019-01-22", "e"),
    ]
    results.write_actions(actions(), path)
    assert len(days(spark, path)) == 5


def test_bucketed_writes_replace_their_days(spark, actions):
    def write(*rows):
        results.write_bucketed_actions(actions(*(dict(session_id=n, time=f"2019-01-{d} 08:00:00") for d, n in rows)), "again", 2)

    write((20, "a"), (21, "b"))
    write((20, "a"), (21, "b"))
    write((21, "c"), (22, "d"))
    assert sorted((r.date.day, r.session_id) for r in spark.table("again").collect()) == [(20, "a"), (21, "c"), (22, "d")]
    rolled = session_measures(spark.table("again"))
    assert "Exchange" not in plan(rolled) and rolled.count() == 3


def test_user_writes_merge_by_id(spark, users, tmp_path):
    path = str(tmp_path / "users")

    def write(*rows):
        results.write_users(users(*(dict(user_id=i, city=c) for i, c in rows)), path)

    def there():
        return sorted((str(r.user_id), r.city) for r in results.read_result(spark, path, schemas.USER_INFO).collect())

    write((1, "a"), (2, "b"), (None, "n"))
    write((1, "a"), (2, "b"), (None, "n"))
    assert there() == [("1", "a"), ("2", "b"), ("None", "n")]
    write((2, "c"), (3, "d"), (3, "e"), (None, "m"))
    assert there() == [("1", "a"), ("2", "c"), ("3", "d"), ("3", "e"), ("None", "m")]
    write()
    assert len(there()) == 5


def scanned(df):
    """(rows, rows that the scan gave out)."""
    spark = df.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        leaves = execution.executedPlan().collectLeaves()
        found = [leaves.apply(i) for i in range(leaves.size())]
        scans = [leaf for leaf in found if "FileSourceScan" in leaf.getClass().getName()]
        return sum(scan.metrics().apply("numOutputRows").value() for scan in scans)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_few_sessions_are_looked_up_without_a_full_scan(spark, tmp_path):
    """A hundred of 100,000 sessions, one of which holds a third of all rows."""
    rows = spark.range(600_000).selectExpr(
        "DATE'2019-01-20' + CAST(id % 3 AS INT) AS date",
        "id % 100 AS user_id",
        "if(id % 3 = 0, 's0', concat('s', md5(string(id % 100000)))) AS session_id",
        "id % 10 AS page_id",
    )
    names = {field.name: field.dataType for field in schemas.USER_VISIT_ACTION}
    full = rows.select(*(F.col(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in names.items()))
    path = str(tmp_path / "actions")
    results.write_actions(full, path, page_rows=200)
    stored = spark.read.schema(schemas.USER_VISIT_ACTION).parquet(path)
    few = stage(stored.filter("session_id <> 's0'").select("session_id").distinct().orderBy(F.md5("session_id")).limit(100), "few")
    wanted = actions_of(stored, few)
    found = actions_of(push_sessions(stored, few), few)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect())) != []
    all_rows, read = scanned(stored), scanned(push_sessions(stored, few))
    assert all_rows == 600_000 and read < 0.1 * all_rows
    # The one hot session is found too, in its own files.
    hot = stage(spark.createDataFrame([("s0",), (None,)], "session_id string"), "hot")
    assert actions_of(push_sessions(stored, hot), hot).count() == 200_000


def test_lists_are_pushed_up_to_a_bound(spark):
    actions = spark.range(100).selectExpr("string(id) AS session_id")
    for count, pushed in ((0, True), (1, True), (25, True), (26, False)):
        few = stage(spark.range(count).selectExpr("string(id) AS session_id"), "few")
        narrowed = push_sessions(actions, few, most=25)
        assert narrowed.count() == (count if pushed else 100)
        assert actions_of(narrowed, few).count() == count


def test_text_dates_reach_the_scan(spark, actions, tmp_path):
    rows = [dict(session_id=f"s{i}", time=f"2019-01-{10 + i:02d} 08:00:00") for i in range(20)]
    table = actions(*rows)
    path = str(tmp_path / "text_dates")
    table.withColumn("date", F.col("date").cast("string")).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("text_dates")
    params = TaskParams(start_date=dt.date(2019, 1, 12), end_date=dt.date(2019, 1, 14))
    found = date_range(catalog.actions_table(spark, "text_dates"), params)
    assert "GreaterThanOrEqual(date,2019-01-12), LessThanOrEqual(date,2019-01-14)" in plan(found)
    kept = found.select(*schemas.USER_VISIT_ACTION.names)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, date_range(table, params).collect()))


def test_extra_columns_come_along(spark, actions):
    actions(dict(session_id="a", time="2019-01-20 08:00:00")).withColumn("event_id", F.lit(5)).createOrReplaceTempView("numbered")
    assert catalog.actions_table(spark, "numbered", ["event_id"]).first().event_id == 5


def test_user_table(spark, users, tmp_path):
    path = str(tmp_path / "users")
    table = users(dict(user_id=1, username="u", name="n", age=3, professional="p", city="c", sex="male"))
    results.write_users(table, path)
    assert results.read_result(spark, path, schemas.USER_INFO).collect() == table.collect()


def test_preview_and_row_counts(spark):
    assert [r.id for r in results.preview(spark.range(10), 3, "id").collect()] == [0, 1, 2]
    counts = results.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert [tuple(r) for r in counts.collect()] == [("a", 3), ("b", 0)]


def test_staged_tables_live_in_the_shared_folder(spark):
    folder = staging.shared_folder(spark)
    named = spark.conf.get(staging.CHECKPOINT_DIR, None)
    assert named is None or folder == named.rstrip("/")
    first = staging.stage(spark.range(5), "numbers")
    second = staging.stage(spark.range(2), "numbers")
    assert first.inputFiles()[0].split("://")[-1].replace("file:", "").startswith(folder.replace("file:", ""))
    assert (first.count(), second.count()) == (5, 2)
    assert not staging.is_empty(first) and staging.is_empty(staging.stage(spark.range(0), "nothing"))
    assert spark.sparkContext.applicationId in first.inputFiles()[0]


class Conf:
    def get(self, key, default=None):
        return default


class RemoteSession:
    """A session on a cluster with no shared folder named."""

    conf = Conf()

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="shared"):
        staging.shared_folder(RemoteSession())


class Recorder:
    """Stands in for a reader or writer and keeps its options."""

    def __init__(self):
        self.settings = {}

    def format(self, name):
        self.settings["format"] = name
        return self

    def options(self, **options):
        self.settings.update(options)
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def mode(self, mode):
        self.settings["mode"] = mode
        return self

    def load(self):
        return self.settings

    def save(self):
        pass


class RecordingSession:
    @property
    def read(self):
        return Recorder()


def test_jdbc_reads():
    session, options = RecordingSession(), {"url": "jdbc:x"}
    assert jdbc.read_jdbc(session, options, table="t") == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t"}
    assert jdbc.read_jdbc(session, options, query="select 1")["query"] == "select 1"
    split = jdbc.read_jdbc(session, options, table="t", split=("id", 0, 100, 8))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "0", "100", "8",
    )
    for bad in ({}, {"table": "t", "query": "q"}, {"query": "q", "split": ("id", 0, 1, 2)}):
        with pytest.raises(ValueError):
            jdbc.read_jdbc(session, options, **bad)


def test_jdbc_writes_in_batches():
    class Frame:
        write = Recorder()

    results.write_jdbc(Frame, {"url": "jdbc:x"}, "t", batch_size=500, connections=3)
    assert Frame.write.settings == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "batchsize": "500", "numPartitions": "3", "mode": "append",
    }


def test_read_task_picks_one_key(spark, monkeypatch):
    rows = [(i, f"t{i}") + (None,) * 6 for i in (1, 2)]
    tasks = spark.createDataFrame(rows, schemas.TASK)
    monkeypatch.setattr(jdbc, "read_jdbc", lambda *args, **kwargs: tasks)
    found = jdbc.read_task(spark, {}, 2)
    assert found.schema == schemas.TASK
    assert [r.name for r in found.collect()] == ["t2"]
