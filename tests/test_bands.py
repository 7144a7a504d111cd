import pytest

from clickflow import schemas
from clickflow.operators import bands


@pytest.fixture
def measured(spark):
    def build(visits, steps=(1,)):
        rows = [(f"v{i}", v, 0) for i, v in enumerate(visits)] + [(f"s{i}", 0, s) for i, s in enumerate(steps)]
        return spark.createDataFrame(rows, "session_id string, visit_length bigint, step_length bigint")

    return build


EDGES = [0, 1, 2, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]


def test_visit_band_edges(measured):
    found = {r.band: r.sessions for r in bands.visit_bands(measured(EDGES, steps=())).collect()}
    assert found == {
        "1s_3s": 3, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2,
        "1m_3m": 2, "3m_10m": 2, "10m_30m": 2, "30m": 1,
    }


def test_step_band_edges(measured):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    found = {r.band: r.sessions for r in bands.step_bands(measured([], steps)).collect()}
    assert found == {"1_3": 2, "4_6": 2, "7_9": 2, "10_30": 2, "30_60": 2, "60": 1}


def test_empty_bands_are_shown(measured):
    found = bands.visit_bands(measured([5], steps=())).collect()
    assert len(found) == 9
    assert sum(r.sessions for r in found) == 1


def test_counters_show_zeros(measured):
    found = {r.counter: r.value for r in bands.counters(measured([5], steps=(2, 2))).collect()}
    assert len(found) == 16
    assert {name: n for name, n in found.items() if n} == {"session_count": 3, "4s_6s": 1, "1_3": 2}


def test_bands_are_a_parameter(measured):
    own = (bands.Band("low", 0, 9), bands.Band("high", 10))
    found = bands.visit_bands(measured([0, 9, 10, 99], steps=()), own)
    assert {r.band: r.sessions for r in found.collect()} == {"low": 2, "high": 2}


def test_stat_row_has_the_table_schema(measured):
    stat = bands.aggr_stat(measured([2] * 57 + [5] * 143, steps=()), 7)
    assert [(f.name, f.dataType) for f in stat.schema] == [
        (f.name, f.dataType) for f in schemas.SESSION_AGGR_STAT
    ]
    row = stat.first()
    assert (row.taskid, row.session_count) == (7, 200)
    assert row.visit_length_1s_3s_ratio == 0.29
    assert row.visit_length_4s_6s_ratio == 0.72
    assert row.step_length_1_3_ratio == 0.0


def test_no_session_gives_zero_ratios(measured):
    row = bands.aggr_stat(measured([], steps=()), 1).first()
    assert row.session_count == 0
    assert set(row[2:]) == {0.0}
