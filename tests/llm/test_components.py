import random

from terralane.llm.components import connected_components, pairs_within


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(45)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            parent[find(a)] = find(b)
    low = {}
    for x in list(parent):
        low[find(x)] = min(low.get(find(x), x), x)
    assert got == {x: low[find(x)] for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pairs_in_blocks(spark):
    rows = [(1, i) for i in range(70)] + [(2, 100), (2, 101), (3, 102)]
    df = spark.createDataFrame(rows, "g long, k long")
    want = sorted([(i, j) for i in range(70) for j in range(i + 1, 70)] + [(100, 101)])
    for block in (7, 1000):
        assert sorted(map(tuple, pairs_within(df, "g", "k", "a", "b", block).collect())) == want
