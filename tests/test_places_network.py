import random

import pytest

from terralane.functions.similarity import lcs, similarity
from terralane.operators import network as nw
from terralane.operators import reconcile as rc

SCHEMA = "id string, name string, category string, lon double, lat double, license string, providers string"


def test_similarity():
    assert lcs("kitten", "sitting") == 4 and similarity("", "x") == 0 and similarity("a b", "b a") == 1.0


def test_reconcile_cases(spark):
    left = spark.createDataFrame([("node/1", "Alpha Coffee", "amenity=cafe | cuisine=coffee_shop", 121.0, 14.5, "ODbL-1.0", ""), ("node/2", "Beta Store House", None, 121.1, 14.5, None, None), ("node/3", None, None, None, None, None, None)], SCHEMA)
    right = spark.createDataFrame([("ov-1", "Alpha Coffee Cafe", "coffee_shop", 121.00005, 14.5, "CDLA-Permissive-2.0", "x"), ("ov-2", "Beta Store House", None, 121.11, 14.5, None, None)], SCHEMA)
    rows = rc.reconciled(left, right).collect()
    pair = [r for r in rows if r.source_count == 2]
    assert len(rows) == 4 and len(pair) == 1
    assert pair[0].name == "Alpha Coffee Cafe" and pair[0].aliases == ["Alpha Coffee"] and pair[0].licenses == "CDLA-Permissive-2.0|ODbL-1.0"
    assert rc.reconciled(left.limit(0), right).count() == 2


def test_mutual_best_is_greedy(spark):
    rng = random.Random(1)
    pairs = [(a, b, float(rng.randint(1, 3)), rng.choice([0.5, 0.75])) for a in range(14) for b in range(14) if rng.random() < 0.4]
    used_a, used_b, want = set(), set(), set()
    for a, b, d, s in sorted(pairs, key=lambda p: (-p[3], p[2], p[0], p[1])):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            want.add((a, b))
    df = spark.createDataFrame(pairs, "left_id int, right_id int, meters double, strength double")
    assert {(r.left_id, r.right_id) for r in rc.one_to_one(df).collect()} == want
    assert rc.one_to_one(df.limit(0)).count() == 0


def test_tied_groups_leave_no_pair(spark):
    tied = [(a, b, 1.0, 0.9) for a in range(130) for b in range(150)]
    # beside them a group that is not complete: 1000 goes to 1001 although 1002 is as good
    chain = [(1000, 1001, 2.0, 0.8), (1000, 1002, 2.0, 0.8), (1003, 1001, 2.0, 0.8), (1003, 1004, 3.0, 0.8), (1005, 1004, 3.0, 0.8)]
    df = spark.createDataFrame(tied + chain, "left_id int, right_id int, meters double, strength double")
    got = sorted((r.left_id, r.right_id) for r in rc.one_to_one(df).collect())
    assert got == [(i, i) for i in range(130)] + [(1000, 1001), (1003, 1004)]


def road(spark):
    return nw.network_from_lines(spark.createDataFrame([("w", 0, 0.0, 0.0), ("w", 1, 10.0, 0.0), ("w", 2, 20.0, 0.0), ("back", 0, 20.0, 0.0), ("back", 1, 10.0, 0.0)], "way string, seq int, x double, y double"))


def test_road_line(spark):
    v, a = road(spark)
    assert v.count() == 3 and sorted(map(tuple, a.collect())) == [(0, 1, 10.0), (1, 2, 10.0)]
    assert {r.component for r in nw.components(v, a).collect()} == {0}
    points = spark.createDataFrame([(0, 2.0, 1.0), (1, 8.0, -1.0), (2, 12.0, 2.0), (3, 18.0, 0.0)], "id long, x double, y double")
    on = nw.snap(points, a, v, 5.0)
    assert [r.distance for r in on.orderBy("id").collect()] == [1, 1, 2, 0]
    pairs = {(r.a, r.b): r.d for r in nw.neighbour_graph(a, on.select("id", "u", "v", "offset"), 6.0).collect()}
    assert pairs == {(0, 1): 6.0, (1, 2): 4.0, (2, 3): 6.0}
    parts = nw.split_arcs(a, on.select("u", "v", "offset")).groupBy("u", "v").sum("length").collect()
    assert all(r[2] == pytest.approx(10) for r in parts)
