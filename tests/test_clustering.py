import numpy as np
import pytest

from terralane.operators import network as nw
from terralane.operators.clustering import cell_budget, cluster_by_type, cluster_on_network, core_distances, hdbscan, hierarchy, gap_refinement, grid_cells, medoids, mutual_forest, seed_of, territories, territory_areas


def frame(spark, rows):
    return spark.createDataFrame([(t, int(i), float(x), float(y)) for t, i, x, y in rows], "type string, id long, x double, y double")


def test_two_blobs_on_a_line(spark):
    rows = [("A", i, x, 0) for i, x in enumerate((1, 2, 3, 4, 5, 95, 96, 97, 98, 99))]
    got = {r.id: (r.cluster, r.membership) for r in cluster_by_type(frame(spark, rows), 100.0, 3, 2).collect()}
    assert [got[i][0] for i in range(10)] == [0] * 5 + [1] * 5
    assert all(got[i][1] == pytest.approx(1.0) for i in range(10))
    turned = {r.id: r.cluster for r in cluster_by_type(frame(spark, rows[::-1]), 100.0, 3, 2).collect()}
    assert turned == {i: c for i, (c, _) in got.items()}


def test_one_blob_and_noise_and_empty(spark):
    assert {r.cluster for r in cluster_by_type(frame(spark, [("A", i, i, 0) for i in range(6)]), 100.0, 3, 2).collect()} == {-1}
    rng = np.random.default_rng(0)
    rows = [("B", i, *(rng.normal(size=2) + (0 if i < 30 else 60))) for i in range(60)] + [("B", 99, 30, 300), ("C", 1, 0, 0)]
    got = {(r.type, r.id): r.cluster for r in cluster_by_type(frame(spark, rows), 200.0, 5, 3).collect()}
    assert got["B", 99] == -1 and got["C", 1] == -1 and {got["B", i] for i in range(30)} >= {0} and got["B", 0] != got["B", 45]
    assert cluster_by_type(frame(spark, []), 10.0).count() == 0


def test_sparse_clusters_form_at_the_full_radius(spark):
    # nothing is within 11.9 or 17.8 of 40, pairs are 30 apart
    sparse = [("A", i, x, 0) for i, x in enumerate((0, 30, 60, 90, 1000, 1030, 1060, 1090))]
    got = {r.id: r.cluster for r in cluster_by_type(frame(spark, sparse), 40.0, 4, 2).collect()}
    assert [got[i] for i in range(8)] == [0] * 4 + [1] * 4


def test_core_distance_counts_own_weight():
    a, b, d = np.array([0, 1]), np.array([1, 2]), np.array([1.0, 2.0])
    assert list(core_distances(3, a, b, d, np.array([1.0, 1, 1]), 2)) == [1, 1, 2]
    assert list(core_distances(3, a, b, d, np.array([5.0, 1, 1]), 3)) == [0, 1, np.inf]


def test_medoids_and_gap(spark):
    d = np.abs(np.subtract.outer([0.0, 1, 2, 50, 51, 52], [0.0, 1, 2, 50, 51, 52]))
    assert medoids(d, 2) == ([1, 4], 4.0)
    assert seed_of("a", "b", 1) == seed_of("a", "b", 1) != seed_of("a", "b", 2)
    rng = np.random.default_rng(1)
    rows = [("A", 0, i, *(rng.normal(size=2) + (0 if i < 20 else 80))) for i in range(40)]
    df = spark.createDataFrame([(t, c, int(i), float(x), float(y)) for t, c, i, x, y in rows], "type string, cluster long, id long, x double, y double")
    got = {r.id: (r.part, r.k) for r in gap_refinement(df).collect()}
    assert got[0][1] >= 2 and got[0][0] != got[39][0]


def test_territories_conserve_area(spark):
    cells = grid_cells(spark, 0, 0, 20, 4, 1.5)
    centers = spark.createDataFrame([("A", 0, 2.0, 2.0), ("A", 1, 18.0, 2.0)], "type string, cluster int, x double, y double")
    areas = {r.cluster: r.area for r in territory_areas(territories(cells, centers)).collect()}
    assert sum(areas.values()) == pytest.approx(80.0) and set(areas) == {0, 1}
    size = cell_budget(1000, 1000, 1.0, 10_000)
    assert -(-1000 // size) ** 2 <= 10_000 and cell_budget(10, 10, 1.0, 1000) == 1.0


def snapped(spark, lines, points):
    v, a = nw.network_from_lines(spark.createDataFrame(lines, "way string, seq int, x double, y double"))
    rows = spark.createDataFrame([(t, int(i), float(x), float(y)) for t, i, x, y in points], "type string, id long, x double, y double")
    return nw.snap(rows, a, v, 50.0).join(rows.select("id", "type"), "id").select("type", "id", "u", "v", "offset"), v, a


def test_two_clusters_on_one_road(spark):
    points = [("A", i, x, 0.0) for i, x in enumerate((1, 2, 3, 4, 5, 95, 96, 97, 98, 99))]
    for some in (points, points[::-1]):
        on, v, a = snapped(spark, [("w", 0, 0.0, 0.0), ("w", 1, 100.0, 0.0)], some)
        got = {r.id: (r.cluster, r.membership) for r in cluster_on_network(on, a, v, 100.0, 3, 2, steps=1).collect()}
        assert [got[i][0] for i in range(10)] == [0] * 5 + [1] * 5 and all(m == pytest.approx(1.0) for _, m in got.values())


def brute(points, way, radius, size, samples):
    """Clusters of one type by the same rules from all pairs of the full radius."""
    ids = sorted(points)
    i, j, d = zip(*[(x, y, way(points[ids[x]], points[ids[y]])) for x in range(len(ids)) for y in range(x + 1, len(ids)) if way(points[ids[x]], points[ids[y]]) <= radius] or [((), (), ())])
    labels, _ = hdbscan(len(ids), np.array(i, int), np.array(j, int), np.array(d, float), np.ones(len(ids)), size, samples)
    return dict(zip(ids, labels.tolist()))


def test_clusters_follow_the_roads(spark):
    """Two parallel roads joined at one end: what is near in a straight line is far along the network."""
    rng = np.random.default_rng(4)
    lines = [("w", 0, 0.0, 0.0), ("w", 1, 200.0, 0.0), ("w", 2, 200.0, 10.0), ("w", 3, 0.0, 10.0)]
    points = {k: (float(c + rng.normal() * 3), float(y)) for k, (c, y) in enumerate([(40, 0)] * 12 + [(40, 10)] * 12 + [(150, 0)] * 12 + [(100, 10)] * 3)}
    place = lambda p: p[0] if p[1] < 5 else 410 - p[0]
    want = brute(points, lambda p, q: abs(place(p) - place(q)), 60.0, 5, 3)
    on, v, a = snapped(spark, lines, [("A", k, *p) for k, p in points.items()] + [("B", 1000 + k, *p) for k, p in points.items()])
    got = {r.id: r.cluster for r in cluster_on_network(on, a, v, 60.0, 5, 3, steps=0).collect()}
    assert {k: got[k] for k in points} == want and {k: got[1000 + k] for k in points} == want
    assert len({c for c in want.values() if c >= 0}) >= 3 and want[0] != want[12]


def test_bounded_searches_and_paths(spark):
    rng = np.random.default_rng(6)
    lines = [(f"r{k}", i, i * 100.0, k * 100.0) for k in range(6) for i in range(6)] + [(f"c{k}", i, k * 100.0, i * 100.0) for k in range(6) for i in range(6) if not (k == 3 and i > 3)]
    v, a = nw.network_from_lines(spark.createDataFrame(lines, "way string, seq int, x double, y double"))
    sources = spark.createDataFrame([(int(n),) for n in rng.choice(36, 9, replace=False)], "node long")
    for limit in (0.0, 150.0, 420.0):
        near = {tuple(r) for r in nw.bounded_distances(a, v, sources, limit).collect()}
        assert near == {tuple(r) for r in nw.distances(a, sources, limit).collect()}
    reach = nw.distances(a, sources)
    targets = sources.withColumnRenamed("node", "source").crossJoin(spark.createDataFrame([(0,), (35,), (999,)], "target long"))
    d = {(r.source, r.node): r.d for r in reach.collect()}
    paths = {}
    for r in nw.shortest_paths(a, reach, targets).collect():
        paths.setdefault((r.source, r.target), []).append((r.seq, r.node))
    assert len(paths) == 18
    length = {(r.u, r.v): r.length for r in a.collect()}
    for (source, target), steps in paths.items():
        nodes = [n for _, n in sorted(steps)]
        assert nodes[0] == source and nodes[-1] == target and [k for k, _ in sorted(steps)] == list(range(len(nodes)))
        assert sum(length[min(x, y), max(x, y)] for x, y in zip(nodes, nodes[1:])) == pytest.approx(d[source, target])


def test_pairs_beyond_a_settled_radius_count(spark):
    # at 17.8 of 40 the labels stand as at 11.9, yet two pairs become a cluster of four at 25
    rows = [("A", i, x, 0) for i, x in enumerate((0, 1, 2, 3, 4, 100, 101, 126, 127, 300, 301, 302, 303, 304))]
    got = {r.id: (r.cluster, r.membership) for r in cluster_by_type(frame(spark, rows), 40.0, 4, 2).collect()}
    place = {i: float(x) for _, i, x, _ in rows}
    assert {i: c for i, (c, _) in got.items()} == brute(place, lambda p, q: abs(p - q), 40.0, 4, 2)
    assert [got[i][0] for i in range(14)] == [0] * 5 + [1] * 4 + [2] * 5


def forest_inputs():
    rng = np.random.default_rng(9)
    yield np.unique(np.floor(rng.uniform(0, 12, (150, 2))), axis=0)
    yield np.exp(rng.normal(size=(200, 2)) * 3)
    yield np.concatenate([rng.normal(size=(100, 2)) * 1e-3 + p for p in ((0, 0), (3, 0), (40, 40))] + [rng.uniform(0, 50, (60, 2))])


def test_forest_stands_for_all_pairs():
    for xy in forest_inputs():
        n = len(xy)
        weight = np.arange(n) % 3 + 1.0
        i, j = np.triu_indices(n, 1)
        d = np.hypot(*(xy[j] - xy[i]).T)
        for radius in (0.5, 5.0, 1000.0):
            near = d <= radius
            for samples in (1, 2, 5):
                core, a, b, m = mutual_forest(xy, weight, samples, radius)
                assert np.array_equal(core, core_distances(n, i[near], j[near], d[near], weight, samples)) and len(a) < n
                want = hdbscan(n, i[near], j[near], d[near], weight, 4, samples)
                labels, member = hierarchy(n, a, b, m, weight, 4)
                assert np.array_equal(labels, want[0]) and np.allclose(member, want[1])


def test_more_pairs_than_a_list_may_hold():
    # 25 million pairs within the smallest of the radii that were tried before
    xy = np.random.default_rng(10).uniform(0, 1, (7_200, 2))
    core, a, b, m = mutual_forest(xy, np.ones(len(xy)), 3, 10.0)
    labels, _ = hierarchy(len(xy), a, b, m, np.ones(len(xy)), 5)
    assert len(a) == len(xy) - 1 and m.max() < 0.1 and np.isfinite(core).all() and labels.max() > 10


def test_road_clusters_count_all_pairs_of_the_radius(spark):
    """Loops, a second network, repeated places, positions at nodes; the labels stand at smaller radii before they change."""
    rng = np.random.default_rng(12)
    lines = [(f"r{k}", i, i * 100.0, k * 100.0) for k in range(4) for i in range(4)] + [(f"c{k}", i, k * 100.0, i * 100.0) for k in range(4) for i in range(4) if k != 2] + [("far", 0, 5000.0, 0.0), ("far", 1, 5400.0, 0.0)]
    spots = [(float(x), 100.0 * y) for x, y in zip(rng.integers(0, 301, 60), rng.integers(0, 4, 60))] + [(5000.0 + x, 0.0) for x in (0, 1, 26, 27, 300, 301, 302, 303)]
    on, v, a = snapped(spark, lines, [("A", k, *p) for k, p in enumerate(spots)])
    near = {(r.a, r.b): r.d for r in nw.neighbour_graph(a, on.select("id", "u", "v", "offset"), 40.0).collect()}
    i, j = np.array(sorted(near), int).T
    d = np.array([near[p] for p in zip(i, j)])
    same = np.arange(len(spots))
    for x, y in zip(i[d == 0], j[d == 0]):
        same[y] = min(same[y], same[x])
    heads = np.unique(same)
    at = np.searchsorted(heads, same)
    use = (same[i] == i) & (same[j] == j)
    for samples in (1, 2):
        labels, member = hdbscan(len(heads), at[i[use]], at[j[use]], d[use], np.bincount(at).astype(float), 4, samples)
        got = {r.id: (r.cluster, r.membership) for r in cluster_on_network(on, a, v, 40.0, 4, samples).collect()}
        assert [got[k][0] for k in range(len(spots))] == labels[at].tolist()
        assert [got[k][1] for k in range(len(spots))] == pytest.approx(member[at].tolist())
    assert got[60][0] == got[63][0] >= 0


def test_refinement_of_a_type_beyond_a_list_of_pairs(spark):
    xy = np.random.default_rng(11).uniform(0, 1, (7_200, 2))
    points = spark.createDataFrame([("A", i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "type string, id long, x double, y double")
    clusters = cluster_by_type(points, 10.0, 20, 3).filter("cluster >= 0")
    rows = gap_refinement(clusters.join(points, ["type", "id"]).select("type", "cluster", "id", "x", "y")).collect()
    assert len({r.id for r in rows}) == len(rows) > 2_000 and all(0 <= r.part < r.k for r in rows)
