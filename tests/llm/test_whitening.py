"""Whitening against numpy's eigenvectors of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickflow.llm import queries, whitening
from clickflow.llm.common import read_table
from clickflow.llm.whitening import Spectrum, rank_one


def scatter(points):
    away = points - points.mean(axis=0)
    return away.T @ away


def checked(spectrum, points):
    wanted = scatter(points)
    scale = max(1.0, np.abs(wanted).max()) * points.shape[1]
    assert spectrum.n == len(points)
    assert np.abs(spectrum.mean - points.mean(axis=0)).max() <= 1e-12 * max(1.0, np.abs(points).max())
    assert np.abs(spectrum.vectors.T @ spectrum.vectors - np.eye(points.shape[1])).max() < 1e-12
    assert np.abs(spectrum.vectors * spectrum.values @ spectrum.vectors.T - wanted).max() < 1e-12 * scale
    assert (np.diff(spectrum.values) >= 0).all()


def spectrum_of(points):
    found = Spectrum(points.shape[1])
    for point in points:
        found.add(point)
    return found


CLOUDS = {
    "round": lambda r: np.floor(r.normal(size=(300, 24)) * 60),
    "few": lambda r: np.floor(r.normal(size=(3, 16)) * 60),
    "flat": lambda r: np.round(r.normal(size=(200, 2)) * 9) @ np.round(r.normal(size=(2, 9)) * 3),
    "equal columns": lambda r: np.repeat(np.floor(r.normal(size=(200, 3)) * 60), 3, axis=1),
    "one point": lambda r: np.full((50, 4), 7.0),
    "two points": lambda r: np.repeat([[1.0, 2.0, 3.0], [4.0, 2.0, 0.0]], 40, axis=0),
    "corners": lambda r: np.vstack([np.eye(12), -np.eye(12)]) * 256,
    "scales": lambda r: np.floor(r.normal(size=(300, 5)) * 10.0 ** np.arange(1, 10, 2)),
}


@pytest.mark.parametrize("name", sorted(CLOUDS))
def test_spectra_grow_and_merge(name):
    points = CLOUDS[name](np.random.default_rng(1))
    checked(spectrum_of(points), points)
    for cut in (0, 1, len(points) // 3):
        merged = spectrum_of(points[:cut])
        merged.merge(spectrum_of(points[cut:]))
        checked(merged, points)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=30))
def test_spectra_of_ties(rows):
    points = np.array(rows, dtype=float)
    checked(spectrum_of(points), points)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(1e-6, 1e3), st.floats(1e-6, 1)), min_size=1, max_size=12), st.floats(1e-3, 1e6))
def test_secular_roots(gaps, weight):
    d, z = np.cumsum([g for g, _ in gaps]), np.array([s for _, s in gaps])
    z = z / np.sqrt(z @ z)
    values, turn = rank_one(d, z, weight)
    wanted = np.diag(d) + weight * np.outer(z, z)
    scale = np.abs(wanted).max()
    assert np.abs(values - np.linalg.eigvalsh(wanted)).max() < 1e-12 * scale
    assert np.abs(turn.T @ turn - np.eye(len(d))).max() < 1e-10
    assert np.abs(turn * values @ turn.T - wanted).max() < 1e-10 * scale


@pytest.fixture
def embeddings(spark):
    def build(*rows):
        kinds = "vec_id long, embedding array<float>, dim int, x string, n int, part int, mean double"
        return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4.0) for i, v in rows], kinds)

    return build


def held_to_numpy(rows, found, components=4, tolerance=1e-9):
    """``rows`` (id, vector) of one length against ``found`` rows, up to a sign for each component."""
    x = np.array([np.floor(256 * np.array(v, dtype=np.float32).astype(float)) for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(scatter(fit) / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    wanted = (x - sums / n) @ vectors / np.sqrt(values)
    by = {}
    for row in found:
        by.setdefault(row.component, []).append(row)
    assert sorted(by) == list(range(1, len(values) + 1))
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for v in x]
    for at, (value, component) in enumerate(zip(values, wanted.T), 1):
        got = sorted((str(r.vec_id), r.deviation, r.whitened) for r in by[at])
        sign = np.sign(sum(w * g for (_, _, g), (_, w) in zip(got, sorted(zip([str(i) for i, _ in rows], component))))) or 1
        for (key, deviation, whitened), (same, wants, score) in zip(got, sorted((str(i), d, sign * c) for (i, _), d, c in zip(rows, exact, component))):
            assert (key, deviation) == (same, wants) and abs(whitened - score) < tolerance
        assert {r.n for r in by[at]} == {n}
        assert all(abs(r.explained - value / np.trace(scatter(fit) / n)) < 1e-12 for r in by[at])
    assert all(r.identity_error < 1e-9 for r in found)


def test_equal_to_numpy_over_many_shards(embeddings):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(700, 12)) * np.linspace(0.3, 2, 12))]
    held_to_numpy(rows, whitening.whiten(embeddings(*rows), shard_rows=30).collect())


def test_copies_change_nothing(embeddings):
    r = np.random.default_rng(6)
    vectors = [[float(x) for x in v] for v in r.normal(size=(40, 5)) * [1, 2, 3, 4, 5]]
    rows = list(enumerate(vectors)) + [(100 + i, vectors[0]) for i in range(300)]
    held_to_numpy(rows, whitening.whiten(embeddings(*rows), shard_rows=16).collect())


def test_rows_that_take_no_part_and_repeated_ids(embeddings):
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [-4.0, 0.5])]
    bad = [(9, None), (10, [1.0, None]), (11, [float("nan"), 1.0]), (12, [1.0, float("-inf")]), (13, [])]
    found = whitening.whiten(embeddings(*good, *bad)).collect()
    assert sorted(r.vec_id for r in found) == [1, 1, 1, 1, 2, 2, 3, 3]
    held_to_numpy(good, found)
    lone = whitening.whiten(embeddings(*good, (None, [2.0, 2.0]))).collect()
    assert sum(r.vec_id is None for r in lone) == 2


def test_no_variance(embeddings):
    found = whitening.whiten(embeddings((1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]))).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found] == [(1, 0, None, None, None)] * 6
    found = whitening.whiten(embeddings((1, [1.0, 2.0]), (2, [3.0, 6.0]))).collect()
    by = {r.component: r for r in found if r.vec_id == 2}
    assert abs(abs(by[1].whitened) - 1) < 1e-12 and by[2].whitened is None
    assert (by[1].explained, by[2].explained) == (pytest.approx(1), pytest.approx(0, abs=1e-12))
    assert by[1].identity_error < 1e-12


def test_lengths_are_fitted_apart(embeddings):
    r = np.random.default_rng(7)
    two = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(20, 2)) * [1, 3])]
    three = [(100 + i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(25, 3)) * [1, 3, 9])]
    found = whitening.whiten(embeddings(*two, *three), shard_rows=8).collect()
    held_to_numpy(two, [r for r in found if r.vec_id < 100])
    held_to_numpy(three, [r for r in found if r.vec_id >= 100])


def test_large_numbers_stay_exact(embeddings):
    rows = [(1, [2.0**40, 1.0]), (2, [-(2.0**40), 3.0]), (3, [5.0, 2.0**30])]
    found = {r.vec_id: r.deviation for r in whitening.whiten(embeddings(*rows)).collect()}
    points = {i: [int(Fraction(c) * 256) for c in v] for i, v in rows}
    sums = [sum(v[at] for v in points.values()) for at in range(2)]
    assert found == {i: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in points.items()}
    beyond = whitening.whiten(embeddings((1, [3e38]), (2, [-3e38]), (3, [1.0]))).collect()
    assert all(r.deviation is None or r.deviation > 0 for r in beyond) and len(beyond) == 3


def test_empty_table(embeddings):
    found = whitening.whiten(embeddings())
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_registered_query_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, sf_dir, "embeddings").collect()]
    found = queries.op13_whitening(spark, sf_dir)
    assert dict(found.dtypes)["deviation"] == "bigint"
    held_to_numpy(rows, found.collect())
