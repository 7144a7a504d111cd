import math

import numpy as np

from clickflow.llm import topk

KINDS = "vec_id long, embedding array<float>, label int, rank int"


def plain(rows, k, every):
    """Every row of another id is a candidate; rows of a repeated query id share a list."""
    vectors = []
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for q in {i for i, _ in vectors if i % every == 0}:
        asked = [v for i, v in vectors if i == q]
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for v in asked for i, w in vectors if i != q and len(w) == len(v))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, k=5, every=50, shard_rows=64):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], KINDS)
    return sorted(map(tuple, topk.top_k(df, k, every, shard_rows=shard_rows).collect()))


def test_search_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    near = rng.normal(size=(4, 8))
    rows = [(i, [float(x) for x in near[i % 4] + 0.05 * rng.normal(size=8)]) for i in range(700)]
    assert found(spark, rows) == plain(rows, 5, 50)
    assert found(spark, rows, k=3, every=7, shard_rows=4096) == plain(rows, 3, 7)


def test_ties_and_one_very_common_vector(spark):
    rows = [(i, [0.5, -0.25] if i % 3 else [0.5, 0.25 * (i % 5)]) for i in range(400)]
    assert found(spark, rows) == plain(rows, 5, 50)


def test_every_row_of_a_repeated_id_counts(spark):
    rows = [(1, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 0.0]), (50, [1.0, 0.0])]
    assert found(spark, rows) == plain(rows, 5, 50)
    assert [r[2:] for r in found(spark, rows)] == [(1, 131_072), (1, 65_536), (2, 32_768)]
    rng = np.random.default_rng(9)
    rows = [(int(rng.integers(0, 40)) * 10, [float(x) for x in rng.integers(-2, 3, size=3) / 4]) for _ in range(500)]
    rows += [(7, [0.5, 0.5, 0.5])] * 250 + [(100, [0.25, -0.5, 0.0])] * 40
    assert found(spark, rows, shard_rows=32) == plain(rows, 5, 50)
    assert found(spark, rows, k=9, every=20, shard_rows=4096) == plain(rows, 9, 20)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (50, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (150, None), (200, [None, 1.0]),
        (None, [1.0, 1.0]), (250, []), (300, []), (350, [1.0]), (3, [0.1, -0.1]), (4, [3e9, 1.0]), (400, [2e9, 0.0]),
        (5, [1.0, 1.0]), (5, [0.5, 3.0]), (5, [0.5, 3.0]), (-50, [-1.0, 0.001]),
    ]
    got = {(q, r): (v, s) for q, r, v, s in found(spark, rows)}
    expected = {(q, r): (v, min(max(s, topk.LONGS[0]), topk.LONGS[1])) for q, r, v, s in plain(rows, 5, 50)}
    assert got == expected


def test_few_or_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]


def test_pruned_nodes_hold_nothing_better():
    rng = np.random.default_rng(1)
    points = np.floor(256 * rng.normal(size=(3000, 6)))
    tree = topk.BallTree(np.arange(3000), points, 32)
    for i in range(0, 3000, 300):
        # Rows are reordered by the tree, so the query is found again by its id.
        at = int(np.flatnonzero(tree.ids == i)[0])
        best = tree.search(i, tree.points[at], tree.bounds(tree.points[at : at + 1])[0], 4, [])
        scores = tree.points @ tree.points[at]
        everything = sorted(((int(s), -int(j)) for j, s in zip(tree.ids, scores) if j != i), reverse=True)
        assert sorted(best, reverse=True) == everything[:4]
