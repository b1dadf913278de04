import numpy as np
import pytest
from pyspark.sql import functions as F

from terralane.operators import network as nw

DATA = "/root/testdata/sf0.001"


def sent(df):
    """Sides that a broadcast join sends to all tasks, with what is exploded in them."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin [gx" in line]


def test_points_are_never_sent_and_every_nearest_arc_is_found(spark):
    rng = np.random.default_rng(8)
    lines = [(f"w{k}", i, *map(float, rng.uniform(0, 1000, 2))) for k in range(12) for i in range(3)]
    v, a = nw.network_from_lines(spark.createDataFrame(lines, "way string, seq int, x double, y double"))
    xy = rng.uniform(-50, 1050, (400, 2))
    points = spark.range(400).select("id", F.element_at(F.array(*[F.lit(float(x)) for x in xy[:, 0]]), F.col("id").cast("int") + 1).alias("x"), F.element_at(F.array(*[F.lit(float(y)) for y in xy[:, 1]]), F.col("id").cast("int") + 1).alias("y"))
    place = {r.id: np.array((r.x, r.y)) for r in v.collect()}
    arcs, want = [tuple(r) for r in a.collect()], {}
    for k, p in enumerate(xy):
        near = []
        for u, w, _ in arcs:
            s, e = place[u], place[w]
            t = min(1.0, max(0.0, float((p - s) @ (e - s) / ((e - s) @ (e - s)))))
            near.append((float(np.hypot(*(p - s - t * (e - s)))), u, w))
        if min(near)[0] <= 40.0:
            want[k] = min(near)
    for few in (nw.SNAP_ROWS, 0):
        before, nw.SNAP_ROWS = nw.SNAP_ROWS, few
        on = nw.snap(points, a, v, 40.0)
        nw.SNAP_ROWS = before
        assert all("BuildRight" in line for line in sent(on)) and bool(sent(on)) == (few > 0)
        got = {r.id: r for r in on.collect()}
        assert set(got) == set(want) and all((r.u, r.v) == want[k][1:] and r.distance == pytest.approx(want[k][0]) for k, r in got.items())


def plan_of(spark, name):
    import __spark_entry__ as entry

    return sent(entry.queries()[name](spark, DATA))


def test_positions_of_all_parts_send_arcs_only(spark):
    lines = plan_of(spark, "j10_distinct_positions")
    assert lines and all("BuildRight" in line for line in lines)


def test_split_arcs_of_all_parts_send_arcs_only(spark):
    lines = plan_of(spark, "n03_split_arcs")
    assert lines and all("BuildRight" in line for line in lines)


def test_neighbours_of_all_parts_send_arcs_only(spark):
    lines = plan_of(spark, "n06_neighbour_graph")
    assert lines and all("BuildRight" in line for line in lines)


def test_pairs_of_neighbours_are_never_shuffled(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["n06_neighbour_graph"](spark, DATA)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join")]
    assert "Project" in above and "Aggregate" not in above
    found = [(r.a, r.b) for r in rows.collect()]
    assert len(found) == len(set(found)) > 0


def test_neighbours_of_repeated_ids_come_once(spark):
    a = spark.createDataFrame([(1, 2, 100.0), (2, 3, 50.0), (1, 3, 60.0)], "u long, v long, length double")
    on = spark.createDataFrame([(7, 1, 2, 10.0), (7, 2, 3, 5.0), (8, 1, 2, 95.0), (9, 1, 3, 0.0)], "id long, u long, v long, offset double")
    assert {(r.a, r.b): r.d for r in nw.neighbour_graph(a, on, 100.0).collect()} == {(7, 8): 10.0, (7, 9): 10.0, (8, 9): 95.0}
    assert {(r.a, r.b): r.d for r in nw.neighbour_graph(a, on, 10.0).collect()} == {(7, 8): 10.0, (7, 9): 10.0}
