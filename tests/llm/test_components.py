import random

from clickflow.llm.common import components


def plain(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def found(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r.node: r.component for r in components(df).collect()}


def test_chains_hubs_and_random_graphs(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(40)]
    hub = [(1000, 1001 + i) for i in range(50)]
    other = [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(40)]
    other = [(a, b) for a, b in other if a != b]
    edges = chain + hub + other + chain[:5]
    assert found(spark, edges) == plain(edges)


def test_nulls_loops_and_nothing(spark):
    assert found(spark, [(1, None), (None, 2), (3, 3), (5, 4)]) == {4: 4, 5: 4}
    assert found(spark, []) == {}
