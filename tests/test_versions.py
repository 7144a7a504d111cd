"""Result tables of a task appear together, and an interrupted run is taken up again."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_jobs import PARAMS, SCHEMAS, task_table, world  # noqa: F401

from clickflow import schemas
from clickflow.operators import staging
from clickflow.plans import jobs
from clickflow.sinks import versions

KINDS = "task_id long, x long"


def table(spark, task_id, *values):
    return spark.createDataFrame([(task_id, v) for v in values], KINDS)


def put(spark, target, task_id, **tables):
    version = versions.new_version(spark, target, task_id)
    folders = {name: versions.write_table(df, target, name, task_id, version) for name, df in tables.items()}
    return versions.commit(spark, target, task_id, version, folders)


def rows(spark, target, name, schema=None, **options):
    schema = schema or spark.createDataFrame([], KINDS).schema
    return sorted(map(tuple, versions.read_table(spark, target, name, schema, **options).collect()))


def all_tables(spark, target):
    return {name: rows(spark, target, name, schema) for name, schema in SCHEMAS.items()}


def test_readers_see_the_newest_version_of_every_task(spark, tmp_path):
    target = str(tmp_path / "results")
    assert rows(spark, target, "a") == [] and versions.current(spark, target, 1) is None
    put(spark, target, 1, a=table(spark, 1, 5, 6), b=table(spark, 1, 9))
    put(spark, target, 2, a=table(spark, 2, 7))
    assert rows(spark, target, "a") == [(1, 5), (1, 6), (2, 7)]
    assert rows(spark, target, "b") == [(1, 9)]
    second = put(spark, target, 1, a=table(spark, 1))
    assert second.number == 2
    assert rows(spark, target, "a") == [(2, 7)] and rows(spark, target, "b") == []
    assert rows(spark, target, "a", task_ids=[1]) == []
    assert rows(spark, target, "a", task_ids=[2, 3]) == [(2, 7)]


def test_tables_without_a_manifest_are_not_seen(spark, tmp_path):
    target = str(tmp_path / "results")
    put(spark, target, 1, a=table(spark, 1, 5))
    versions.write_table(table(spark, 1, 6), target, "a", 1, versions.new_version(spark, target, 1))
    assert rows(spark, target, "a") == [(1, 5)]


def test_a_number_is_given_once(spark, tmp_path):
    target = str(tmp_path / "results")
    first = put(spark, target, 1, a=table(spark, 1, 5))
    # Another run's manifest under the next number.
    folder = tmp_path / "results" / "_versions" / "1"
    shutil.copy(folder / "00000001.json", folder / "00000002.json")
    third = put(spark, target, 1, a=table(spark, 1, 6))
    assert (first.number, third.number) == (1, 3)
    assert rows(spark, target, "a") == [(1, 6)]
    assert not [name for name in os.listdir(folder) if name.startswith(".draft")]


def test_old_versions_are_dropped(spark, tmp_path):
    target = str(tmp_path / "results")
    put(spark, target, 2, a=table(spark, 2, 1))
    done = [put(spark, target, 1, a=table(spark, 1, i)) for i in range(4)]
    left = versions.write_table(table(spark, 1, 9), target, "a", 1, "unfinished")
    gone = versions.drop_old_versions(spark, target, 1, keep=2)
    assert sorted(gone) == sorted(m.tables["a"] for m in done[:2])
    assert rows(spark, target, "a") == [(1, 3), (2, 1)]
    assert os.path.exists(tmp_path / "results" / left)
    gone = versions.drop_old_versions(spark, target, 1, keep=0, idle_seconds=-1)
    assert sorted(gone) == sorted([left, done[2].tables["a"]])
    assert rows(spark, target, "a") == [(1, 3), (2, 1)]
    assert not os.path.exists(tmp_path / "results" / left)


def failing_write(monkeypatch, number):
    """The ``number``-th result table of a run is written halfway, then the run fails."""
    real, calls = versions.write_table, []

    def write(df, target, name, task_id, version):
        calls.append(name)
        if len(calls) == number:
            half = f"{target}/{versions.DATA}/{name}/{task_id}/{version}"
            df.write.parquet(half)
            os.remove(f"{half}/_SUCCESS")
            raise RuntimeError("driver lost")
        return real(df, target, name, task_id, version)

    monkeypatch.setattr(versions, "write_table", write)
    return calls


def test_a_run_that_fails_halfway_leaves_the_old_tables(spark, world, tmp_path, monkeypatch):  # noqa: F811
    _, _, actions, users = world
    target = str(tmp_path / "results")

    def run(seed):
        return jobs.run_task(spark, ["7"], task_table(spark), actions, users, target, sample_size=20, seed=seed)

    run(0)
    before = all_tables(spark, target)
    assert len(before) == 7 and all(before.values())
    with monkeypatch.context() as patched:
        failing_write(patched, 5)
        with pytest.raises(RuntimeError):
            run(1)
    assert all_tables(spark, target) == before
    run(1)
    after = all_tables(spark, target)
    assert after["session_random_extract"] != before["session_random_extract"]
    assert after["session_aggr_stat"] == before["session_aggr_stat"]


@pytest.fixture
def stored(spark, world, tmp_path):  # noqa: F811
    """Paths of the action and user tables as files."""
    _, _, actions, users = world
    paths = str(tmp_path / "actions"), str(tmp_path / "users")
    actions.write.parquet(paths[0])
    users.write.parquet(paths[1])
    return paths


def read(spark, paths):
    return spark.read.schema(schemas.USER_VISIT_ACTION).parquet(paths[0]), spark.read.parquet(paths[1])


def run_folders(spark):
    folder, files = staging.files_of(spark, f"{staging.shared_folder(spark)}/clickflow/runs")
    return {s.getPath().getName() for s in files.listStatus(folder)} if files.exists(folder) else set()


def test_an_interrupted_run_goes_on_without_its_inputs(spark, stored, tmp_path, monkeypatch):
    target, plain = str(tmp_path / "results"), str(tmp_path / "plain")
    tasks = task_table(spark)
    jobs.run_task(spark, ["7"], tasks, *read(spark, stored), plain, sample_size=60)

    def run():
        return jobs.run_task(spark, ["7"], tasks, *read(spark, stored), target, sample_size=60, resume=True, input_version="v1")

    before = run_folders(spark)
    with monkeypatch.context() as patched:
        written = failing_write(patched, 5)
        with pytest.raises(RuntimeError):
            run()
    assert len(written) == 5 and len(run_folders(spark) - before) == 1
    assert versions.current(spark, target, 7) is None

    # What was staged and written is there: neither is made again.
    staged, real = [], staging.is_written
    monkeypatch.setattr(staging, "is_written", lambda s, p: staged.append(real(s, p)) or staged[-1])
    kept, known = [], versions.is_written
    monkeypatch.setattr(versions, "is_written", lambda s, p: kept.append(known(s, p)) or kept[-1])
    # All but page conversion comes from staged tables, so the actions are read by it alone.
    shutil.copytree(f"{plain}/data/page_conversion/7", f"{tmp_path}/pages")
    monkeypatch.setattr(jobs, "page_conversion_analysis", lambda *_: spark.read.schema(schemas.PAGE_CONVERSION).parquet(f"{tmp_path}/pages/*"))
    for name in os.listdir(stored[0]):
        if name.endswith(".parquet"):
            os.truncate(os.path.join(stored[0], name), 0)
    run()
    assert staged and all(staged)
    assert kept == [True] * 4 + [False] * 3
    assert all_tables(spark, target) == all_tables(spark, plain)
    assert run_folders(spark) == before


def test_a_new_run_after_a_commit_writes_anew(spark, stored, tmp_path):
    target = str(tmp_path / "results")
    for number in (1, 2):
        jobs.run_task(spark, ["7"], task_table(spark), *read(spark, stored), target, sample_size=60, resume=True)
        assert versions.current(spark, target, 7).number == number
    first, second = (versions._load(spark, target, 7, n).version for n in (1, 2))
    assert first != second


def test_run_keys(spark, stored):
    actions, users = read(spark, stored)
    key = staging.run_key([actions, users], {"a": 1})
    again = staging.run_key(list(read(spark, stored)), {"a": 1})
    assert key == again and len(key) == 32
    assert staging.run_key([actions, users], {"a": 2}) != key
    assert staging.run_key([actions.filter("page_id > 1"), users], {"a": 1}) != key
    assert staging.run_key([actions.filter("page_id > 2"), users], {"a": 1}) != staging.run_key([actions.filter("page_id > 1"), users], {"a": 1})
    assert staging.run_key([actions, users], {"a": 1}, "v1") not in (key, staging.run_key([actions, users], {"a": 1}, "v2"))
    actions.limit(5).write.mode("append").parquet(stored[0])
    assert staging.run_key(list(read(spark, stored)), {"a": 1}) != key
    in_memory = spark.createDataFrame([(1,)], "user_id long")
    assert staging.run_key([actions, in_memory], {}) is None
    assert staging.run_key([actions.join(in_memory, "user_id")], {}) is None
    assert staging.run_key([actions, in_memory], {}, "v1") is not None


def test_stages_of_a_keyed_run(spark):
    key = "test-key"

    def run(fail):
        with staging.run_folder(spark, key) as path:
            first = staging.stage(spark.range(3), "numbers")
            second = staging.stage(spark.range(3, 5), "numbers")
            if fail:
                raise RuntimeError
            return path, first.union(second).agg(F.sum("id")).first()[0]

    with pytest.raises(RuntimeError):
        run(True)
    path, total = run(False)
    assert total == 10
    folder, files = staging.files_of(spark, path)
    assert not files.exists(folder)


def test_command_line_can_resume():
    from clickflow import main

    args = main.parse_args(["3", "--target", "t", "--resume", "--input-version", "v1"])
    assert (args.resume, args.input_version) == (True, "v1")
