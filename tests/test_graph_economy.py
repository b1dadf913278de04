import math

import pytest

from terralane.operators import economy as ec
from terralane.operators import graph as gr


def edges(spark, rows):
    return spark.createDataFrame([(a, b, float(w)) for a, b, w in rows], "u string, v string, w double")


def nodes(spark, names):
    return spark.createDataFrame([(n,) for n in names], "node string")


@pytest.mark.parametrize("local", [gr.LOCAL_EDGES, 0])
def test_katz_on_a_path(spark, local):
    e, n = edges(spark, [("A", "B", 1), ("B", "C", 1)]), nodes(spark, "ABC")
    got = {r.node: r for r in gr.balanced_katz(e, n, local_edges=local).collect()}
    inward, outward, both = ({k: getattr(r, c) for k, r in got.items()} for c in ("katz_in", "katz_out", "centrality"))
    assert inward["C"] > inward["B"] > inward["A"] and outward["A"] > outward["B"] > outward["C"]
    assert both["A"] == pytest.approx(both["C"]) and both["B"] > both["A"] and sum(v * v for v in both.values()) == pytest.approx(1)
    assert got["A"].radius == 0 and got["A"].alpha == pytest.approx(0.85)


def test_one_sided_katz_has_length_one(spark):
    e, n = edges(spark, [("A", "B", 1), ("B", "C", 1)]), nodes(spark, "ABC")
    for incoming, last in ((True, "C"), (False, "A")):
        x = {r.node: r.x for r in gr.katz(e, n, incoming=incoming).collect()}
        assert max(x, key=x.get) == last and sum(v * v for v in x.values()) == pytest.approx(1)


def test_radius_and_acyclicity(spark):
    cycle = edges(spark, [("A", "B", 2), ("B", "A", 3)])
    r = gr.balanced_katz(cycle, nodes(spark, "AB")).first()
    assert r.alpha * math.sqrt(6) == pytest.approx(0.85, rel=1e-9) and r.scale == "spectral radius"
    assert gr.spectral_radius(cycle, nodes(spark, "AB")) == pytest.approx(math.sqrt(6), rel=1e-9)
    assert not gr.is_acyclic(cycle) and gr.is_acyclic(edges(spark, [("A", "B", 1), ("A", "C", 1)]))
    assert gr.spectral_radius(edges(spark, [("A", "B", 1)]), nodes(spark, "AB")) == 0
    equal = {r.x for r in gr.eigenvector(edges(spark, [("A", "B", 0)]), nodes(spark, "ABC")).collect()}
    assert all(v == pytest.approx(1 / math.sqrt(3)) for v in equal)
    for bad in (-1, float("nan"), float("inf")):
        with pytest.raises(Exception, match="bad weight"):
            gr.balanced_katz(edges(spark, [("A", "B", bad)]), nodes(spark, "AB")).collect()


def random_graph(seed=3, n=60):
    import numpy as np

    rng = np.random.default_rng(seed)
    w = np.where(rng.random((n, n)) < 0.08, np.exp(rng.normal(size=(n, n))) * 1e-6, 0.0)
    return w, [f"n{i:02d}" for i in range(n)], np.exp(rng.normal(size=n))


def test_katz_equals_the_solved_system(spark):
    import numpy as np

    w, names, area = random_graph()
    e, n = edges(spark, [(names[i], names[j], w[i, j]) for i, j in zip(*np.nonzero(w))]), nodes(spark, names)
    areas = spark.createDataFrame(list(zip(names, map(float, area))), "node string, area double")
    for factors, f in ((None, np.ones(60)), (gr.area_factors(areas, 0.4), area**-0.4)):
        got = {r.node: r for r in gr.balanced_katz(e, n, factors=factors).collect()}
        rho = np.abs(np.linalg.eigvals(f[:, None] * w)).max()
        assert got["n00"].radius == pytest.approx(rho, rel=1e-9)
        into = np.linalg.solve(np.eye(60) - 0.85 / rho * f[:, None] * w.T, np.ones(60))
        out = np.linalg.solve(np.eye(60) - 0.85 / rho * f[:, None] * w, np.ones(60))
        both = np.sqrt(into * out)
        assert [got[k].centrality for k in names] == pytest.approx(both / np.linalg.norm(both), rel=1e-7)
        # residual of the fixed point
        x = np.array([got[k].katz_in for k in names])
        assert np.abs(1 + got["n00"].alpha * f * (w.T @ x) - x).sum() < 60 * 1e-10


def test_joins_and_arrays_agree(spark, monkeypatch):
    """On a graph whose iterations settle after few steps."""
    monkeypatch.setattr(gr, "EVERY", 2)
    e, n = edges(spark, [(a, b, 2) for a in "ABC" for b in "ABC" if a != b]), nodes(spark, "ABC")
    for local in (0, gr.LOCAL_EDGES):
        assert gr.spectral_radius(e, n, local_edges=local) == pytest.approx(4)
        assert [r.x for r in gr.eigenvector(e, n, local_edges=local).collect()] == pytest.approx([1 / math.sqrt(3)] * 3)


def test_tempered_scores(spark):
    points = spark.createDataFrame([(i, "n", float(d)) for i, d in enumerate((0, 10, 20, 30, 100))], "id int, node string, distance double")
    c = spark.createDataFrame([("n", 2.0)], "node string, centrality double")
    got = {r.id: (r.p90, r.score) for r in gr.tempered_scores(points, c, 0.15).collect()}
    assert got[0][0] == pytest.approx(72) and [got[i][1] for i in range(5)] == pytest.approx([2.0, 1.9583333333333333, 1.9166666666666667, 1.875, 1.7])


def test_poisson_slope(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    area = np.exp(rng.normal(size=20_000))
    y = rng.poisson(np.exp(1.0 + 0.4 * np.log(area)))
    fit = gr.poisson_log_area(spark.createDataFrame(list(zip(map(float, y), map(float, area))), "y double, area double"), "y", "area")
    assert fit["slope"] == pytest.approx(0.4, abs=0.01) and 0 < fit["se"] < 0.02
    assert fit["low"] < fit["slope"] < fit["high"] and fit["n"] == 20_000 and 0 < fit["rho"] < 1
    with pytest.raises(ValueError):
        gr.poisson_log_area(spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "y double, area double"), "y", "area")


def test_area_diagnostics(spark):
    rows = [(f"n{i:02d}", float(i // 2 + 1), i, 1.0 / (i + 1)) for i in range(23)]
    got = {r.decile: r for r in gr.area_deciles(spark.createDataFrame(rows, "node string, area double, degree int, f double")).collect()}
    assert [got[k].nodes for k in range(1, 11)] == [3] * 3 + [2] * 7 and got[1].area_min == 1 and got[10].area_max == 12
    assert got[1].mean_degree == pytest.approx(1) and got[1].relative_degree == pytest.approx(1 / 11)
    c = spark.createDataFrame([(str(i), float(i)) for i in range(1, 21)], "node string, centrality double")
    assert gr.concentration(c) == {"top10_share": pytest.approx(155 / 210), "top100_share": pytest.approx(1)}


def test_acyclic_and_support(spark):
    cycle = [("A", "B", 20.0), ("B", "C", 30.0), ("C", "A", 10.0)]
    assert {e[:2] for e in ec.fast_acyclic(cycle)} == {e[:2] for e in ec.exact_acyclic(cycle)} == {("A", "B"), ("B", "C")}
    assert ec.fast_acyclic([("A", "A", 5.0), ("B", "B", 4.0), ("A", "B", 1.0)]) == [("A", "B", 1.0)]
    z = [[0, 0, 4, 0], [2, 4, 11, 0], [6, 0, 0, 15], [8, 4, 5, 0]]
    rows = [("ABCD"[i], "ABCD"[j], float(v)) for i, r in enumerate(z) for j, v in enumerate(r) if v]
    support, restored = ec.repaired_support(rows)
    assert restored == [("D", "C"), ("A", "C")] and ("B", "B") in support and ("D", "B") not in support


def test_ras_by_joins(spark):
    z = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 1.0), ("b", "x", 1.0), ("b", "y", 1.0)], "src string, dst string, value double")
    r, c = (spark.createDataFrame(x, "code string, target double") for x in ([("a", 6.0), ("b", 4.0)], [("x", 7.0), ("y", 3.0)]))
    got = {(v.src, v.dst): v.value for v in ec.ras(z, r, c, local_cells=0, every=2).collect()}
    assert got == pytest.approx({("a", "x"): 4.2, ("a", "y"): 1.8, ("b", "x"): 2.8, ("b", "y"): 1.2})


@pytest.mark.parametrize("local", [ec.LOCAL_CELLS])
def test_ras_meets_margins(spark, local):
    z = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("b", "y", 4.0), ("c", "x", 0.0)], "src string, dst string, value double")
    r = spark.createDataFrame([("a", 6.0), ("b", 4.0), ("c", 0.0)], "code string, target double")
    c = spark.createDataFrame([("x", 5.0), ("y", 5.0)], "code string, target double")
    got = ec.ras(z, r, c, local_cells=local).collect()
    for key, targets in (("src", {"a": 6, "b": 4, "c": 0}), ("dst", {"x": 5, "y": 5})):
        for code, target in targets.items():
            assert sum(v.value for v in got if v[key] == code) == pytest.approx(target, abs=1e-8 + 1e-10 * target)
    assert {v.value for v in got if v.src == "c"} == {0.0}
    with pytest.raises(Exception, match="margin"):
        ec.ras(z, spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], r.schema), c, local_cells=local).collect()
    with pytest.raises(Exception, match="not met"):
        ec.ras(z, r, spark.createDataFrame([("x", 1.0), ("y", 1.0)], r.schema), most=10, local_cells=local).collect()


def test_repaired_support_is_balanced_to_its_own_margins(spark):
    z = [[0, 0, 4, 0], [2, 4, 11, 0], [6, 0, 0, 15], [8, 4, 5, 0]]
    rows = [("ABCD"[i], "ABCD"[j], float(v)) for i, r in enumerate(z) for j, v in enumerate(r) if v]
    kept = ec.repaired_support(rows)[0]
    flows = spark.createDataFrame([(a, b, v) for a, b, v in rows if (a, b) in kept], "src string, dst string, value double")
    margin = lambda k: spark.createDataFrame([(c, sum(v for *ab, v in rows if ab[k] == c)) for c in "ABCD"], "code string, target double")
    got = ec.ras(flows, margin(0), margin(1)).collect()
    for k, key in enumerate(("src", "dst")):
        for c in "ABCD":
            target = sum(v for *ab, v in rows if ab[k] == c)
            assert abs(sum(v.value for v in got if v[key] == c) - target) <= 1e-8 + 1e-10 * target


def test_hierarchy(spark):
    leaves = spark.createDataFrame([("a", "m", "t", 10), ("b", "m", "t", 2), ("c", "m", "t", 3), ("d", "k", "t", 3), ("e", "k", "t", 3), ("f", "l", "t", 1)], "leaf string, middle string, top string, n int")
    got = {r.leaf: r.key for r in ec.hierarchical_sectors(leaves, 5).collect()}
    assert got == {"a": "leaf:a", "b": "middle:m:OTHER", "c": "middle:m:OTHER", "d": "middle:k", "e": "middle:k", "f": "top:t:REST"}


def test_eigenvector_of_parts_that_are_nearly_alike(spark):
    """Power steps need millions where the greatest eigenvalues of two parts lie this near."""
    e = edges(spark, [("A", "B", 1.0), ("C", "D", 1.00001)])
    got = {r.node: r.x for r in gr.eigenvector(e, nodes(spark, "ABCDE")).collect()}
    assert [got[k] for k in "ABCDE"] == pytest.approx([0, 0, math.sqrt(0.5), math.sqrt(0.5), 0], abs=1e-9)
    # parts that are alike share the limit
    even = {r.node: r.x for r in gr.eigenvector(edges(spark, [("A", "B", 1.0), ("C", "D", 1.0)]), nodes(spark, "ABCD")).collect()}
    assert list(even.values()) == pytest.approx([0.5] * 4)
    import numpy as np

    rng = np.random.default_rng(3)
    w = np.triu(rng.random((150, 150)) * (rng.random((150, 150)) < 0.05))
    w = w + w.T
    x = np.ones(150)
    for _ in range(20_000):
        x = x + w @ x
        x /= np.sqrt(x @ x)
    assert gr.principal(lambda v: w @ v, 150) == pytest.approx(x, abs=1e-12)
