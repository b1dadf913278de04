import struct

import numpy as np

from terralane.operators.proximity import _haversine, near_pairs, points_in_regions, positions


def brute(rows, d):
    k, g, y, x = (np.array(c) for c in zip(*rows))
    i, j = np.triu_indices(len(k), 1)
    keep = (_haversine(x[i], y[i], x[j], y[j]) <= d) & (g[i] != g[j]) & (k[i] != k[j])
    return sorted({(min(k[a], k[b]), max(k[a], k[b])) for a, b in zip(i[keep], j[keep])})


def found(spark, rows, d, **options):
    df = spark.createDataFrame([tuple(map(float if n > 1 else int, ())) or (int(r[0]), int(r[1]), float(r[2]), float(r[3])) for n, r in enumerate(rows)], "rec_id long, grp long, lat double, lon double")
    got = [(r.left_id, r.right_id) for r in near_pairs(df, d, **options).collect()]
    assert len(got) == len(set(got))
    return sorted(got)


def test_near_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i // 2, 10 + rng.normal() * 0.003, 120 + rng.normal() * 0.003) for i in range(900)]
    assert found(spark, rows, 50.0) == brute(rows, 50.0)


def test_poles_date_line_ties_and_hot_cells(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i, 5 + rng.normal() * 3e-4, (180 + rng.normal() * 3e-4 + 180) % 360 - 180) for i in range(200)]
    rows += [(1000 + i, i, 89.9995 + rng.random() * 5e-4, rng.random() * 360 - 180) for i in range(60)]
    rows += [(2000 + i, i, 85.0 + rng.normal() * 8e-4, 10 + rng.normal() * 2e-3) for i in range(150)]
    rows += [(3000 + i, i, -7.0, 0.0) for i in range(120)]
    rows += [(4000, 1, 5.0, 180.0), (4001, 2, 5.0, -180.0)]
    assert found(spark, rows, 50.0) == brute(rows, 50.0)
    assert found(spark, rows, 50.0, hot_cell=17) == brute(rows, 50.0)


def test_empty(spark):
    assert found(spark, [], 50.0) == []


def test_positions(spark):
    good = struct.pack("<BIdd", 1, 1, 121.5, 14.5)
    big = struct.pack(">BIdd", 0, 1, 121.25, 14.25)
    nan = float("nan")
    rows = [(1, 10.0, 120.0, good), (2, None, 120.0, good), (3, 121.0, 14.0, big), (4, 0.0, 0.0, None), (5, nan, 1.0, b"\x01"), (6, nan, 1.0, big)]
    df = spark.createDataFrame(rows, "rec_id long, latitude double, longitude double, geometry binary")
    assert sorted((r.rec_id, r.lat, r.lon) for r in positions(df).collect()) == [(1, 10.0, 120.0), (2, 14.5, 121.5), (3, 14.25, 121.25), (6, 14.25, 121.25)]


def ring(*points):
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


def test_regions(spark):
    outer = ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))
    hole = ring((4, 4), (6, 4), (6, 6), (4, 6), (4, 4))
    with_hole = struct.pack("<BII", 1, 3, 2) + outer + hole
    island = struct.pack("<BII", 1, 3, 1) + ring((20, 0), (21, 0), (21, 1), (20, 1), (20, 0))
    multi = struct.pack("<BII", 1, 6, 2) + (struct.pack("<BII", 1, 3, 1) + ring((4, 4), (6, 4), (6, 6), (4, 6), (4, 4))) + island
    regions = spark.createDataFrame([(1, with_hole), (2, multi), (3, None)], "locality_id long, geometry binary")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 0.5, 20.5), (4, 50.0, 50.0)], "rec_id long, lat double, lon double")
    want = [(1, 1), (2, 2), (3, 2)]
    assert sorted(map(tuple, points_in_regions(points, regions).collect())) == want
    assert sorted(map(tuple, points_in_regions(points, regions, region_bytes=0).collect())) == want


def test_one_region_per_point(spark):
    import struct

    from terralane.operators.proximity import assigned_regions

    def box(x0, y0, x1, y1):
        points = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return bytearray(struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in points))

    regions = spark.createDataFrame([(1, box(0, 0, 2, 2)), (2, box(2, 0, 4, 2)), (3, box(1, 1, 2, 2)), (4, None)], "locality_id long, geometry binary")
    spots = [(1, 0.5, 0.5), (2, 2.0, 0.5), (3, 1.5, 1.5), (4, 4.0, 2.0), (5, 9.0, 9.0), (6, 0.0, 0.0), (7, 1.0, 1.5), (8, None, None)]
    points = spark.createDataFrame([(k, y, x) for k, x, y in spots], "rec_id long, lat double, lon double")
    got = {r.rec_id: (r.locality_id, r.relation, r.regions) for r in assigned_regions(points, regions).collect()}
    assert got == {1: (1, "within", 1), 2: (1, "touches", 2), 3: (1, "within", 2), 4: (2, "touches", 1), 6: (1, "touches", 1), 7: (1, "within", 1)}
    assert assigned_regions(points.limit(0), regions).count() == 0
