import datetime as dt
import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.operators import sampling
from clickflow.operators.sessions import actions_of

SCHEMA = "session_id string, start_time timestamp_ntz"


@pytest.fixture
def sessions(spark):
    """Sessions from {(day, hour): count}."""

    def build(strata, partitions=3):
        rows = [
            (f"{day}-{hour}-{i}", dt.datetime(2024, 1, day, hour, i % 60))
            for (day, hour), count in strata.items()
            for i in range(count)
        ]
        return spark.createDataFrame(rows, SCHEMA).repartition(partitions)

    return build


STRATA = {(1, 8): 100, (1, 9): 50, (1, 23): 50, (2, 0): 3, (3, 5): 900, (3, 6): 100}


def expected_quota(strata, size):
    days = Counter()
    for (day, _), count in strata.items():
        days[day] += count
    per_day = size // len(days)
    return {k: min(int(count / days[k[0]] * per_day), count) for k, count in strata.items()}


def brute_force(strata, size, seed):
    quota = expected_quota(strata, size)
    chosen = set()
    for (day, hour), count in strata.items():
        ids = [f"{day}-{hour}-{i}" for i in range(count)]
        ids.sort(key=lambda s: (hashlib.md5(f"{s}{seed}".encode()).hexdigest(), s))
        chosen.update(ids[: quota[day, hour]])
    return chosen


def test_sessions_per_hour(sessions):
    found = {r.date_hour: r.sessions for r in sampling.sessions_per_hour(sessions({(1, 8): 2, (2, 0): 1})).collect()}
    assert found == {"2024-01-01_08": 2, "2024-01-02_00": 1}


@pytest.mark.parametrize("size", [2, 30, 100, 300, 3000])
def test_quota(sessions, size):
    found = {
        (int(r.date[-2:]), r.hour): (r.sessions, r.quota)
        for r in sampling.sample_quota(sessions(STRATA), size).collect()
    }
    quota = expected_quota(STRATA, size)
    assert found == {key: (count, quota[key]) for key, count in STRATA.items()}


@pytest.mark.parametrize("size, seed", [(30, 0), (100, 5), (300, 0), (3000, 1), (30000, 0)])
def test_sample_matches_brute_force(sessions, size, seed):
    found = [r.session_id for r in sampling.sample_sessions(sessions(STRATA), size, seed).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute_force(STRATA, size, seed)


@pytest.mark.parametrize("spread", [0.001, 0.2, 1.0, 50.0])
def test_bands_that_miss_the_quota_are_made_wider(sessions, spread):
    for size in (30, 300, 3000):
        found = [r.session_id for r in sampling.sample_sessions(sessions(STRATA), size, 2, spread).collect()]
        assert len(found) == len(set(found)) and set(found) == brute_force(STRATA, size, 2)


def test_only_candidates_of_a_large_hour_are_ranked(spark):
    rows = spark.range(60_000).selectExpr("string(id) AS session_id", "TIMESTAMP_NTZ'2024-01-01 08:00:00' AS start_time")
    drawn = {r.session_id for r in sampling.sample_sessions(rows, 10_000).collect()}
    order = sorted(range(60_000), key=lambda i: hashlib.md5(f"{i}0".encode()).hexdigest())
    assert drawn == {str(i) for i in order[:10_000]}
    # The hash that the bound of such an hour stands for.
    bound = spark.range(1).select(sampling._cut(F.lit((10_000 + 6 * 103) / 60_000))).first()[0]
    below = sum(hashlib.md5(f"{i}0".encode()).hexdigest() < bound for i in range(60_000))
    assert 10_000 < below < 11_500


def test_sessions_without_an_id_take_no_part(spark, sessions):
    table = sessions(STRATA).unionByName(spark.createDataFrame([(None, dt.datetime(2024, 1, 1, 8))] * 50, SCHEMA))
    assert {r.session_id for r in sampling.sample_sessions(table, 300).collect()} == brute_force(STRATA, 300, 0)


def test_sessions_without_a_start_take_no_part(spark, sessions):
    table = sessions(STRATA).unionByName(spark.createDataFrame([(f"none{i}", None) for i in range(200)], SCHEMA))
    assert sampling.sample_quota(table, 300).count() == len(STRATA)
    assert sampling.sessions_per_hour(table).count() == len(STRATA)
    drawn = [r.session_id for r in sampling.sample_sessions(table, 300).collect()]
    assert set(drawn) == brute_force(STRATA, 300, 0)
    assert len(drawn) == sum(expected_quota(STRATA, 300).values())


def test_sample_does_not_depend_on_partitions_but_on_the_seed(sessions):
    def draw(partitions, seed):
        return {r.session_id for r in sampling.sample_sessions(sessions(STRATA, partitions), 100, seed).collect()}

    assert draw(1, 3) == draw(9, 3)
    assert draw(1, 3) != draw(1, 4)


def test_sample_is_spread_evenly(sessions):
    """Over many seeds every session of an hour is drawn about equally often."""
    drawn = defaultdict(int)
    table = sessions({(1, 8): 8}).cache()
    for seed in range(40):
        for row in sampling.sample_sessions(table, 4, seed).collect():
            drawn[row.session_id] += 1
    assert sum(drawn.values()) == 160
    assert len(drawn) == 8
    assert max(drawn.values()) <= 32


def test_no_session_gives_an_empty_sample(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sampling.sample_quota(empty, 10).collect() == []
    assert sampling.sample_sessions(empty, 10).collect() == []


def test_detail_and_extract_records(actions):
    table = actions(
        dict(session_id="a", time="2019-01-20 08:00:03", page_id=1, search_keyword="k"),
        dict(session_id="a", time="2019-01-20 08:00:01", page_id=2, click_category_id=4, click_product_id=5),
        dict(session_id="b", time="2019-01-20 09:00:00", page_id=3, order_category_ids="1,2"),
        dict(session_id="c", time="2019-01-20 09:00:00", page_id=3),
    )
    chosen = table.filter("session_id <> 'c'").select("session_id")
    picked = actions_of(table, chosen)
    detail = sampling.detail_records(picked, 7)
    assert [(f.name, f.dataType) for f in detail.schema] == [(f.name, f.dataType) for f in schemas.SESSION_DETAIL]
    assert sorted((r.task_id, r.session_id, r.action_time) for r in detail.collect()) == [
        (7, "a", "2019-01-20 08:00:01"),
        (7, "a", "2019-01-20 08:00:03"),
        (7, "b", "2019-01-20 09:00:00"),
    ]
    extract = sampling.extract_records(picked, 7)
    assert [(f.name, f.dataType) for f in extract.schema] == [
        (f.name, f.dataType) for f in schemas.SESSION_RANDOM_EXTRACT
    ]
    assert sorted(map(tuple, extract.collect())) == [
        (7, "a", "2019-01-20 08:00:01", "k", "4"),
        (7, "b", "2019-01-20 09:00:00", None, None),
    ]
