import random
import re
from collections import Counter

import pytest

from clickflow.operators import categories
from clickflow.operators.staging import stage

TIME = "2019-01-20 08:00:00"
ROWS = (
    dict(session_id="a", click_category_id=1),
    dict(session_id="a", click_category_id=1),
    dict(session_id="a", order_category_ids="1,2"),
    dict(session_id="b", click_category_id=2),
    dict(session_id="b", pay_category_ids="3,3,"),
    dict(session_id="b"),
    dict(session_id="c", click_category_id=9, order_category_ids="", pay_category_ids=""),
)


@pytest.fixture
def table(actions):
    return actions(*[dict(time=TIME, **row) for row in ROWS])


def test_touches(table):
    found = sorted(map(tuple, categories.category_touches(table).collect()))
    assert found == [
        ("a", "click", 1), ("a", "click", 1), ("a", "order", 1), ("a", "order", 2),
        ("b", "click", 2), ("b", "pay", 3), ("b", "pay", 3), ("c", "click", 9),
    ]


def test_counts_per_session_and_category(table):
    found = sorted(map(tuple, categories.session_category_counts(table).collect()))
    assert found == [
        ("a", 1, 2, 1, 0), ("a", 2, 0, 1, 0), ("b", 2, 1, 0, 0), ("b", 3, 0, 0, 2), ("c", 9, 1, 0, 0),
    ]


def test_only_kept_sessions_count(table):
    kept = stage(table.select("session_id").filter("session_id <> 'c'").distinct(), "kept")
    counts = categories.kept_category_counts(table, kept)
    assert sorted(r.category_id for r in categories.categories_touched(counts).collect()) == [1, 2, 3]
    assert sorted(map(tuple, categories.category_count(counts, "click").collect())) == [(1, 2), (2, 1)]
    assert sorted(map(tuple, categories.category_count(counts, "order").collect())) == [(1, 1), (2, 1)]
    assert sorted(map(tuple, categories.category_count(counts, "pay").collect())) == [(3, 2)]


def test_top_categories_sort_by_clicks_orders_pays_and_id(spark):
    rows = [("s", 5, 1, 0, 0), ("s", 4, 1, 0, 0), ("s", 3, 1, 1, 0), ("s", 2, 1, 1, 1), ("t", 9, 2, 0, 0)]
    counts = spark.createDataFrame(
        rows, "session_id string, category_id bigint, click_count bigint, order_count bigint, pay_count bigint"
    )
    assert [r.category_id for r in categories.top_categories(counts, 4).collect()] == [9, 2, 3, 4]


def test_top_sessions_match_brute_force(actions):
    random.seed(3)
    rows = [
        dict(session_id=f"s{random.randint(0, 40)}", time=TIME, click_category_id=random.randint(0, 30) % 17)
        for _ in range(1500)
    ]
    counts = categories.session_category_counts(actions(*rows))
    totals = Counter(r["click_category_id"] for r in rows)
    best = sorted(totals, key=lambda c: (-totals[c], c))[:10]
    top = categories.top_categories(counts)
    assert [r.category_id for r in top.collect()] == best
    pairs = Counter((r["click_category_id"], r["session_id"]) for r in rows)
    expected = set()
    for category in best:
        ranked = sorted((-n, s) for (c, s), n in pairs.items() if c == category)
        expected |= {(category, s, -n) for n, s in ranked[:10]}
    found = categories.top_category_sessions(counts, top)
    assert {tuple(r) for r in found.collect()} == expected
    assert sum(r.click_count for r in categories.category_totals(counts).collect()) == 1500


def test_sessions_without_clicks_are_not_active(table):
    counts = categories.session_category_counts(table)
    found = categories.top_category_sessions(counts, categories.top_categories(counts))
    assert {tuple(r) for r in found.collect()} == {(1, "a", 2), (2, "b", 1), (9, "c", 1)}


COUNTS = "session_id string, category_id bigint, click_count bigint, order_count bigint, pay_count bigint"


def test_every_top_category_keeps_its_own_sessions(spark):
    rows = [(f"s{i}", c, 10 * c + i, 0, 0) for c in range(1, 5) for i in range(3)]
    counts = spark.createDataFrame(rows, COUNTS)
    found = categories.top_category_sessions(counts, categories.top_categories(counts, 4), 2)
    assert {tuple(r) for r in found.collect()} == {(c, f"s{i}", 10 * c + i) for c in range(1, 5) for i in (1, 2)}


def test_large_ranks_are_limited_before_the_last_shuffle(spark, monkeypatch):
    random.seed(4)
    rows = [(f"s{i:03d}", i % 3, random.randint(1, 9), 0, 0) for i in range(400)]
    counts = spark.createDataFrame(rows, COUNTS)
    top = stage(categories.top_categories(counts), "top")
    plain = categories.top_category_sessions(counts, top, 20).collect()
    monkeypatch.setattr(categories, "LIMITED_RANK", 10)
    sliced = categories.top_category_sessions(counts, top, 20)
    assert sorted(map(tuple, sliced.collect())) == sorted(map(tuple, plain))
    monkeypatch.undo()
    plan = categories.top_category_sessions(counts, top, 2000)._jdf.queryExecution().executedPlan().toString()
    last, first = [m.start() for m in re.finditer("Exchange hashpartitioning", plan)][:2]
    assert re.search(r"Filter \(rank#\d+ <= 2000\)", plan[last:first])


def test_malformed_ids_of_dropped_sessions_do_no_harm(actions):
    table = actions(
        dict(session_id="a", time=TIME, order_category_ids="1,2"), dict(session_id="b", time=TIME, order_category_ids="1,x")
    )
    kept = stage(table.filter("session_id = 'a'").select("session_id"), "kept")
    counts = categories.kept_category_counts(table, kept)
    assert sorted(r.category_id for r in counts.collect()) == [1, 2]
