import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from clickflow.operators import hotkeys, pageflow
from clickflow.operators.hotkeys import hot_keys, likely_hot_keys

SCHEMA = "session_id string, page_id bigint, action_time timestamp_ntz, event_id bigint"


def brute_force(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    steps = Counter()
    for group in groups.values():
        pages = [row[1] for row in sorted(group, key=key)]
        steps.update(zip(pages, pages[1:] + [None]))
    return steps


def by_event(row):
    return row[2], row[3]


def by_page(row):
    return row[2], row[1]


def random_rows(seed, count=600, busy=0.4):
    """A third and more of the actions fall to one session, many in the same second."""
    random.seed(seed)
    rows = []
    for i in range(count):
        session = "busy" if random.random() < busy else f"s{random.randint(0, 60)}"
        second = random.randint(0, 40) if session == "busy" else random.randint(0, 3000)
        time = dt.datetime(2024, 1, 1, 8) + dt.timedelta(seconds=second)
        rows.append((session, random.randint(0, 5), time, i))
    random.shuffle(rows)
    return rows


def steps_of(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return Counter({(r.page_id, r.next_page_id): r.n for r in pageflow.page_steps(table, **options).collect()})


@pytest.mark.parametrize("hot_rows, piece", [(10**9, 100), (50, 100), (50, 7), (3, 2), (0, 1)])
def test_steps_match_brute_force_however_sessions_are_cut(spark, hot_rows, piece):
    rows = random_rows(1)
    found = steps_of(spark, rows, tiebreak="event_id", hot_rows=hot_rows, piece=piece)
    assert found == brute_force(rows, by_event)


@pytest.mark.parametrize("piece", [1, 50])
def test_pieces_are_joined_up_over_seconds_hours_and_days(spark, piece):
    random.seed(5)
    rows = [
        ("busy", random.randint(0, 5), dt.datetime(2024, 1, random.randint(1, 3), random.randint(0, 23), 0, second), i)
        for i in range(500)
        for second in (random.randint(0, 2),)
    ]
    found = steps_of(spark, rows, tiebreak="event_id", hot_rows=100, piece=piece)
    assert found == brute_force(rows, by_event)


@pytest.mark.parametrize("hot_rows", [10**9, 20])
def test_fractions_of_a_second_count_before_the_tiebreak(spark, hot_rows):
    random.seed(8)
    start = dt.datetime(2024, 1, 1, 8)
    rows = [
        ("busy", random.randint(0, 5), start + dt.timedelta(milliseconds=random.randint(0, 40) * 100), i)
        for i in range(400)
    ]
    found = steps_of(spark, rows, tiebreak="event_id", hot_rows=hot_rows, piece=30)
    assert found == brute_force(rows, by_event)


@pytest.mark.parametrize("hot_rows", [10**9, 50, 0])
def test_steps_without_tiebreak_go_by_page(spark, hot_rows):
    rows = random_rows(2)
    assert steps_of(spark, rows, hot_rows=hot_rows) == brute_force(rows, by_page)


@pytest.mark.parametrize("hot_rows", [10**9, 10])
def test_copies_of_one_action(spark, hot_rows):
    time = dt.datetime(2024, 1, 1, 8)
    rows = [("s", 4, time, i) for i in range(500)] + [("s", 5, time, 500), ("t", 4, time, 501)]
    assert steps_of(spark, rows, hot_rows=hot_rows) == {(4, 4): 499, (4, 5): 1, (5, None): 1, (4, None): 1}


@pytest.mark.parametrize("hot_rows", [10**9, 2])
def test_actions_outside_a_session_have_no_next_page(spark, hot_rows):
    time = dt.datetime(2024, 1, 1, 8)
    rows = [(None, 1, time, i) for i in range(5)] + [("s", 1, time, 6), ("s", 2, time, 7), ("s", 3, time, 8)]
    found = steps_of(spark, rows, tiebreak="event_id", hot_rows=hot_rows)
    assert found == {(1, None): 5, (1, 2): 1, (2, 3): 1, (3, None): 1}


def nulls_first(value):
    return (value is not None, value or 0) if not isinstance(value, dt.datetime) else (True, value)


def ordered(key):
    def of(row):
        time, rest = key(row)
        return (time is not None, time or dt.datetime.min), nulls_first(rest)

    return of


@pytest.mark.parametrize("tiebreak, key", [("event_id", by_event), (None, by_page)])
@pytest.mark.parametrize("hot_rows", [10**9, 20, 1])
def test_null_times_and_pages_come_first_at_every_size(spark, tiebreak, key, hot_rows):
    rows = [
        (session, None if i % 7 == 0 else page, None if i % 5 == 0 else time, i)
        for i, (session, page, time, _) in enumerate(random_rows(3, 300))
    ]
    rows += [("tiny", 1, None, 1001), ("tiny", 2, dt.datetime(2024, 1, 1), 1002), ("tiny", 3, dt.datetime(2024, 1, 2), 1003)]
    found = steps_of(spark, rows, tiebreak=tiebreak, hot_rows=hot_rows, piece=30)
    assert found == brute_force(rows, ordered(key))


def test_a_hot_session_adds_one_scan_and_no_shuffle_of_the_others(spark):
    rows = random_rows(6)
    table = spark.createDataFrame(rows, SCHEMA)

    def exchanges(hot_rows):
        paired = []
        stage = pageflow.stage
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(pageflow, "stage", lambda df, name: paired.append(df) or stage(df, name))
            steps = pageflow.page_steps(table, hot_rows=hot_rows)
        frame = paired[-1] if paired else steps
        return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(50) == exchanges(10**9) == 2


def test_hot_keys_are_all_above_the_limit(spark):
    table = spark.createDataFrame([(k,) for k in "aaaabbbccd"], "k string")
    assert [r.k for r in hot_keys(table, "k", rows=1).orderBy("k").collect()] == ["a", "b", "c"]
    assert hot_keys(table, "k", rows=4).collect() == []


@pytest.mark.parametrize("tracked", [2, 64, 4_096])
def test_likely_hot_keys_miss_none(spark, tracked):
    """With few tracked keys they are counted, with many they come from the sketch."""
    random.seed(tracked)
    keys = [f"k{min(int(random.expovariate(0.02)), 900)}" for _ in range(5_000)] + ["big"] * 2_500 + [None] * 3_000
    table = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    for rows in (2_400, 60, 30):
        wanted = {k for k, n in Counter(keys).items() if n > rows and k is not None}
        found = likely_hot_keys(table, "k", rows, tracked)
        names = [r.k for r in found.collect()]
        assert len(names) == len(set(names)) and set(names) >= wanted and None not in names
    assert likely_hot_keys(table, "k", 10**9) is None
    assert likely_hot_keys(table.filter("k IS NULL"), "k", 0) is None


def test_a_sketch_shuffles_no_keys(spark, monkeypatch):
    staged = {}
    real = hotkeys.stage
    monkeypatch.setattr(hotkeys, "stage", lambda df, name: staged.setdefault(name, df) and real(df, name))
    table = spark.range(1000).selectExpr("string(id % 50) AS k")
    assert likely_hot_keys(table, "k", 100) is None
    plan = staged["hot_keys"]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan and list(staged) == ["hot_keys"]


@pytest.mark.parametrize("tiebreak, key", [("event_id", by_event), (None, by_page)])
def test_sessions_taken_for_hot_give_the_same_steps(spark, monkeypatch, tiebreak, key):
    rows = random_rows(8)
    names = [(f"s{i}",) for i in range(0, 60, 2)] + [("nobody",)]
    wrong = spark.createDataFrame(names, "session_id string")
    monkeypatch.setattr(pageflow, "likely_hot_keys", lambda *_: wrong)
    assert steps_of(spark, rows, tiebreak=tiebreak, piece=20) == brute_force(rows, key)


def test_worked_sample_order(spark):
    def at(text):
        return dt.datetime.strptime("2019-01-20 " + text, "%Y-%m-%d %H:%M:%S")

    times = [(7, "20:39:42"), (3, "20:50:07"), (5, "20:47:02"), (5, "20:48:02"), (2, "20:27:46")]
    rows = [("s", page, at(time), i) for i, (page, time) in enumerate(times)]
    found = steps_of(spark, rows, tiebreak="event_id")
    assert found == {(2, 7): 1, (7, 5): 1, (5, 5): 1, (5, 3): 1, (3, None): 1}


@pytest.fixture
def steps(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "page_id bigint, next_page_id bigint, n bigint")

    return build


def test_slices_leave_out_session_ends(steps):
    found = pageflow.page_slices(steps((1, 2, 3), (2, None, 5)))
    assert [tuple(r) for r in found.collect()] == [(1, 2, 3)]


def test_flow_matches(steps):
    found = pageflow.page_flow_matches(steps((1, 2, 3), (2, 1, 4), (2, 3, 5), (1, 3, 6), (2, None, 7)), (1, 2, 3))
    assert sorted(map(tuple, found.collect())) == [("1_2", 3), ("2_3", 5)]


def test_conversion_chains_from_hop_to_hop(steps):
    table = steps((1, 2, 20), (1, 5, 10), (1, None, 10), (2, 3, 5), (3, 4, 0), (2, None, 9))
    found = pageflow.page_conversion(table, (1, 2, 3, 4, 6))
    assert [tuple(r) for r in found.collect()] == [
        ("1_2", 20, 0.5), ("2_3", 5, 0.25), ("3_4", 0, 0.0), ("4_6", 0, 0.0),
    ]


@pytest.mark.parametrize("flow", [(), (1,), (1, 2, 1)])
def test_bad_flows_raise(steps, flow):
    with pytest.raises(ValueError):
        pageflow.page_conversion(steps((1, 2, 1)), flow)
    with pytest.raises(ValueError):
        pageflow.page_flow_matches(steps((1, 2, 1)), flow)
