"""Road networks as tables: vertices (id, x, y), arcs (u, v, length), undirected, u < v."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.functions.text import round_significant
from terralane.operators.relational import numbered
from terralane.session import cut


def network_from_lines(lines: DataFrame, digits: int = 11) -> tuple[DataFrame, DataFrame]:
    """(vertices, arcs) of lines given as (way, seq, x, y); equal points are one vertex, numbered by (x, y).

    Repeated and reversed segments are one arc; segments of no length drop out.
    """
    points = lines.select("way", "seq", round_significant("x", digits).alias("x"), round_significant("y", digits).alias("y"))
    vertices = cut(numbered(points.select("x", "y").distinct(), ["x", "y"], "id"))
    w = W.partitionBy("way").orderBy("seq")
    steps = points.select("x", "y", F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2")).filter("x2 IS NOT NULL AND (x <> x2 OR y <> y2)")
    ends = steps.join(vertices, ["x", "y"]).withColumnRenamed("id", "a").join(vertices.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("id").alias("b")), ["x2", "y2"])
    arcs = ends.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2")).alias("length"))
    return vertices, arcs.groupBy("u", "v").agg(F.min("length").alias("length"))


def both_ways(arcs: DataFrame) -> DataFrame:
    return arcs.select(F.col("u").alias("s"), F.col("v").alias("t"), "length").unionByName(arcs.select(F.col("v").alias("s"), F.col("u").alias("t"), "length"))


def components(vertices: DataFrame, arcs: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex of each component, by labels that jump to their label's label.

    Labels only fall, so the rounds end by themselves, when none has moved.
    """
    links = cut(both_ways(arcs).select("s", "t"))
    labels = cut(vertices.select("id", F.col("id").alias("component")))
    while True:
        around = links.join(labels, links["t"] == labels["id"]).groupBy(F.col("s").alias("id")).agg(F.min("component").alias("m"))
        lower = labels.join(around, "id", "left").select("id", "component", F.least("component", F.coalesce("m", "component")).alias("n"))
        jump = labels.select(F.col("id").alias("n"), F.col("component").alias("nn"))
        after = cut(lower.join(jump, "n").select("id", F.least("n", "nn").alias("component"), (F.least("n", "nn") < F.col("component")).alias("moved")))
        moved = after.filter("moved").limit(1).count()
        labels = after.select("id", "component")
        if not moved:
            return labels


def split_arcs(arcs: DataFrame, stops: DataFrame) -> DataFrame:
    """Arcs cut at interior offsets: (u, v, part, start, length); lengths of the parts add up to the arc.

    ``stops`` is (u, v, offset); repeated stops and those at the ends change nothing.
    """
    inner = stops.join(arcs, ["u", "v"]).filter("offset > 0 AND offset < length").select("u", "v", "offset").distinct()
    marks = inner.unionByName(arcs.select("u", "v", F.lit(0.0).alias("offset"))).unionByName(arcs.select("u", "v", F.col("length").alias("offset")))
    w = W.partitionBy("u", "v").orderBy("offset")
    cuts = marks.withColumn("end", F.lead("offset").over(w)).withColumn("part", F.row_number().over(w)).filter("end IS NOT NULL")
    return cuts.select("u", "v", "part", F.col("offset").alias("start"), (F.col("end") - F.col("offset")).alias("length"))


#: Listed arcs up to which ``snap`` sends them to all tasks (some 80 bytes each).
SNAP_ROWS = 200_000


def _to_segment(x, y):
    """Distance of (x, y) from the segment (x1, y1) - (x2, y2)."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - F.col("x1")) * dx + (y - F.col("y1")) * dy) / (dx * dx + dy * dy)))
    return F.hypot(x - F.col("x1") - t * dx, y - F.col("y1") - t * dy)


def snap(points: DataFrame, arcs: DataFrame, vertices: DataFrame, cell: float) -> DataFrame:
    """(id, u, v, offset, distance) of the nearest arc within one cell; ties by the smaller (u, v).

    Points and arcs meet in grid cells: a point is in its own cell, an arc is listed in the cells of which
    it comes within ``cell`` of some point, so a nearest arc at most ``cell`` away is found.  The listed arcs are
    counted: ``SNAP_ROWS`` are sent to all tasks, more are joined by cell.  The points are never sent.
    """
    a, b = vertices.select(F.col("id").alias("u"), F.col("x").alias("x1"), F.col("y").alias("y1")), vertices.select(F.col("id").alias("v"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    placed = arcs.join(a, "u").join(b, "v")
    span = lambda p, q: F.sequence(F.floor(F.least(p, q) / cell) - 1, F.floor(F.greatest(p, q) / cell) + 1)
    listed = placed.withColumn("gx", F.explode(span("x1", "x2"))).withColumn("gy", F.explode(span("y1", "y2")))
    # a cell's points lie within half its diagonal of its middle
    reach = _to_segment((F.col("gx") + 0.5) * cell, (F.col("gy") + 0.5) * cell)
    listed = cut(listed.filter(~(reach > cell * (1 + math.sqrt(0.5)) * (1 + 1e-6))))
    listed = F.broadcast(listed) if listed.limit(SNAP_ROWS + 1).count() <= SNAP_ROWS else listed.hint("shuffle_merge")
    around = points.withColumn("gx", F.floor(F.col("x") / cell)).withColumn("gy", F.floor(F.col("y") / cell))
    met = around.join(listed, ["gx", "gy"])
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / (dx * dx + dy * dy)))
    near = met.withColumn("t", along).select("id", "u", "v", (F.col("t") * F.col("length")).alias("offset"), F.hypot(F.col("x") - F.col("x1") - F.col("t") * dx, F.col("y") - F.col("y1") - F.col("t") * dy).alias("distance"))
    best = near.groupBy("id").agg(F.min(F.struct("distance", "u", "v", "offset")).alias("b")).filter(F.col("b.distance") <= cell)
    return best.select("id", "b.u", "b.v", "b.offset", "b.distance")


def distances(arcs: DataFrame, sources: DataFrame, limit: float | None = None) -> DataFrame:
    """(source, node, d): shortest network distances from every source, up to ``limit``.

    Only improved nodes push on in the next round; the rounds end when none improves, which lengths of
    at least zero guarantee.  Where a limit is small against the network, ``bounded_distances`` is faster.
    """
    links = cut(both_ways(arcs))
    known = cut(sources.select(F.col("node").alias("source"), "node", F.lit(0.0).alias("d")))
    front = known
    while True:
        step = front.join(links, front["node"] == links["s"]).select("source", F.col("t").alias("node"), (F.col("d") + F.col("length")).alias("d"))
        if limit is not None:
            step = step.filter(F.col("d") <= limit)
        step = step.groupBy("source", "node").agg(F.min("d").alias("n"))
        front = cut(step.join(known, ["source", "node"], "left").filter("d IS NULL OR n < d").select("source", "node", F.col("n").alias("d")))
        if front.isEmpty():
            return known
        known = cut(known.join(front.select("source", "node"), ["source", "node"], "left_anti").unionByName(front))


#: Sources of one tile that are searched from in one task.
TILE_SOURCES = 2_000


def _search_tile(arcs: pd.DataFrame, sources: pd.DataFrame, limit: float) -> pd.DataFrame:
    """Dijkstra from every source over the arcs of a tile and its surroundings."""
    links: dict[int, list[tuple[int, float]]] = {}
    for u, v, length in zip(arcs["u"].tolist(), arcs["v"].tolist(), arcs["length"].tolist()):
        links.setdefault(u, []).append((v, length))
        links.setdefault(v, []).append((u, length))
    out: tuple[list, list, list] = ([], [], [])
    for source in sources["source"].tolist():
        done: dict[int, float] = {}
        heap = [(0.0, source)]
        while heap:
            d, at = heapq.heappop(heap)
            if at in done:
                continue
            done[at] = d
            for node, length in links.get(at, ()):
                if node not in done and d + length <= limit:
                    heapq.heappush(heap, (d + length, node))
        for column, values in zip(out, ([source] * len(done), done.keys(), done.values())):
            column.extend(values)
    return pd.DataFrame({"source": np.array(out[0], np.int64), "node": np.array(out[1], np.int64), "d": np.array(out[2], float)})


def bounded_distances(arcs: DataFrame, vertices: DataFrame, sources: DataFrame, limit: float) -> DataFrame:
    """(source, node, d): as ``distances`` with a limit, in one pass of searches per tile of the plane.

    A way of at most ``limit`` from a source stays within ``limit`` of it, provided no arc is shorter than
    the straight line between its ends; so a tile's searches need the arcs that come within ``limit`` of the
    tile.  Tiles with many sources are cut into parts, each with a copy of the tile's arcs.
    """
    if not limit > 0:
        return sources.select(F.col("node").alias("source"), "node", F.lit(0.0).alias("d")).distinct()
    size = 2.0 * limit
    placed = sources.select(F.col("node").alias("source")).distinct().join(vertices.select(F.col("id").alias("source"), "x", "y"), "source")
    placed = placed.select("source", F.floor(F.col("x") / size).alias("tx"), F.floor(F.col("y") / size).alias("ty"))
    parts = placed.groupBy("tx", "ty").agg(F.ceil(F.count(F.lit(1)) / TILE_SOURCES).cast("int").alias("parts"))
    placed = placed.join(parts, ["tx", "ty"]).withColumn("part", F.pmod(F.xxhash64("source"), F.col("parts"))).select("tx", "ty", "part", "source")
    a, b = (vertices.select(F.col("id").alias(k), F.col("x").alias(f"x{k}"), F.col("y").alias(f"y{k}")) for k in ("u", "v"))
    ends = arcs.join(a, "u").join(b, "v")
    around = lambda c: F.sequence(F.floor((F.least(f"{c}u", f"{c}v") - limit) / size), F.floor((F.greatest(f"{c}u", f"{c}v") + limit) / size))
    listed = ends.withColumn("tx", F.explode(around("x"))).withColumn("ty", F.explode(around("y"))).join(parts, ["tx", "ty"])
    listed = listed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("tx", "ty", F.col("part").cast("long").alias("part"), "u", "v", "length")
    placed, listed = (x.select(*[F.col(c).alias(c) for c in x.columns]) for x in (placed.withColumn("part", F.col("part").cast("long")), listed))
    return placed.groupBy("tx", "ty", "part").cogroup(listed.groupBy("tx", "ty", "part")).applyInPandas(
        lambda some, near: _search_tile(near, some, limit), "source long, node long, d double")


def neighbour_graph(arcs: DataFrame, positions: DataFrame, radius: float, vertices: DataFrame | None = None, by: str | None = None) -> DataFrame:
    """(a, b, d), a < b: pairs of positions at most ``radius`` apart along the network.

    ``positions`` is (id, u, v, offset); the way leads through the arcs' ends, or along the shared arc.
    With ``vertices`` (id, x, y) the searches run tile by tile; with ``by`` only positions of one value of
    that column are paired, and the column comes out too.  Every two arcs within reach meet once, with the four
    distances of their ends, so a pair is found once and pairs are never shuffled, unless ids repeat.
    """
    group = F.col(by) if by else F.lit(0)
    lengths = arcs.groupBy("u", "v").agg(F.min("length").alias("length"))
    others = positions.select("id", "u", "v", "offset", group.alias("grp")).join(lengths, ["u", "v"]).select("id", "grp", "u", "v", F.col("offset").alias("o0"), (F.col("length") - F.col("offset")).alias("o1"))
    placed = cut(others)
    # arcs with their ends that a position comes near
    used = placed.groupBy("u", "v").agg(F.min("o0").alias("o0"), F.min("o1").alias("o1"))
    ends = cut(used.select("u", "v", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("u").alias("node"), F.col("o0").alias("o")), F.struct(F.lit(1).alias("end"), F.col("v").alias("node"), F.col("o1").alias("o")))).alias("e")).select("u", "v", "e.end", "e.node", "e.o"))
    near = ends.filter(F.col("o") <= radius)
    starts = near.select("node").distinct()
    reach = (bounded_distances(arcs, vertices, starts, radius) if vertices is not None else distances(arcs, starts, radius)).select("source", F.col("node").alias("target"), "d")
    a, b = near.alias("a"), near.alias("b")
    met = a.join(reach, F.col("a.node") == F.col("source")).join(b, F.col("b.node") == F.col("target")).filter(F.col("a.o") + F.col("d") + F.col("b.o") <= radius)
    met = met.select(F.col("a.u").alias("u"), F.col("a.v").alias("v"), F.col("b.u").alias("u2"), F.col("b.v").alias("v2"), (2 * F.col("a.end") + F.col("b.end")).alias("way"), "d")
    own = ends.filter("end = 0").select("u", "v", F.col("u").alias("u2"), F.col("v").alias("v2"), F.lit(None).cast("int").alias("way"), F.lit(None).cast("double").alias("d"))
    ways = met.unionByName(own).groupBy("u", "v", "u2", "v2").agg(*[F.min(F.when(F.col("way") == k, F.col("d"))).alias(f"d{k}") for k in range(4)])
    p, q = placed.join(ways, ["u", "v"]), others.select(F.col("id").alias("b"), "grp", F.col("u").alias("u2"), F.col("v").alias("v2"), F.col("o0").alias("q0"), F.col("o1").alias("q1"))
    same = (F.col("u") == F.col("u2")) & (F.col("v") == F.col("v2"))
    left = F.least(F.when(same, 0.0), *[F.col(f"o{k // 2}") + F.col(f"d{k}") for k in range(4)])
    p = p.filter(left <= radius).select(F.col("id").alias("a"), "grp", "u2", "v2", F.when(same, F.col("o0")).alias("o"), *[(F.col(f"o{k // 2}") + F.col(f"d{k}")).alias(f"w{k}") for k in range(4)])
    d = F.least(F.abs(F.col("o") - F.col("q0")), *[F.col(f"w{k}") + F.col(f"q{k % 2}") for k in range(4)])
    pairs = p.join(q, ["u2", "v2", "grp"]).filter(F.col("a") < F.col("b")).select("grp", "a", "b", d.alias("d")).filter(F.col("d") <= radius)
    if not placed.groupBy("grp", "id").count().filter("count > 1").isEmpty():
        pairs = pairs.groupBy("grp", "a", "b").agg(F.min("d").alias("d"))
    return pairs.withColumnRenamed("grp", by) if by else pairs.drop("grp")


def one_median(reach: DataFrame, demand: DataFrame) -> DataFrame:
    """(cluster, node, cost): the node with the least weighted distance to all demand of its cluster.

    ``reach`` is (source, node, d), ``demand`` (cluster, node, weight); only nodes that reach all the
    demand count; ties go to the smaller node.
    """
    need = demand.groupBy("cluster").agg(F.count(F.lit(1)).alias("need"))
    cost = demand.withColumnRenamed("node", "source").join(reach, "source").groupBy("cluster", "node").agg(F.sum(F.col("weight") * F.col("d")).alias("cost"), F.count(F.lit(1)).alias("have"))
    best = cost.join(need, "cluster").filter("have = need").groupBy("cluster").agg(F.min(F.struct(F.round("cost", 9).alias("cost"), "node")).alias("b"))
    return best.select("cluster", "b.node", "b.cost")


def nearest_owner(reach: DataFrame, centers: DataFrame) -> DataFrame:
    """(node, cluster, d): the nearest center's cluster of every reached node, ties to the smaller cluster."""
    owned = centers.withColumnRenamed("node", "source").join(reach, "source")
    return owned.groupBy("node").agg(F.min(F.struct(F.round("d", 9).alias("d"), "cluster")).alias("b")).select("node", "b.cluster", "b.d")


def ego_network(edges: DataFrame, start: str, depth: int, most: int = 300) -> DataFrame:
    """(node, depth, truncated) found breadth first from a node, ring by ring, each ring in order of node.

    At most ``most`` nodes come out; ``truncated`` tells in every row whether there were more.
    """
    links = cut(edges.select("u", "v").union(edges.select("v", "u")).distinct())
    found = edges.sparkSession.createDataFrame([(start, 0)], "node string, depth int")
    ring, truncated = found, False
    for k in range(1, depth + 1):
        fresh = cut(ring.join(links, ring["node"] == links["u"]).select(F.col("v").alias("node")).distinct().join(found, "node", "left_anti"))
        room = max(0, most - found.count())
        truncated = truncated or fresh.limit(room + 1).count() > room
        ring = cut(fresh.orderBy("node").limit(room).select("node", F.lit(k).alias("depth")))
        if ring.isEmpty():
            break
        found = cut(found.unionByName(ring))
    return found.withColumn("truncated", F.lit(truncated))


def distinct_positions(snapped: DataFrame) -> DataFrame:
    """(id, position, representative): one number per place on the network; the representative is the
    point snapped from nearest, ties by id.  ``snapped`` is (id, u, v, offset, distance)."""
    places = numbered(snapped.select("u", "v", "offset").distinct(), ["u", "v", "offset"], "position")
    at = W.partitionBy("u", "v", "offset").orderBy("distance", "id")
    first = snapped.withColumn("representative", F.first("id").over(at))
    return first.join(places, ["u", "v", "offset"]).select("id", (F.col("position") + 1).cast("int").alias("position"), "representative")


def shortest_paths(arcs: DataFrame, reach: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target, seq, node): a shortest path to every target (source, target) that is reached.

    Every node's predecessor is the smallest node over a tight arc.  Paths are unfolded by doubling: after
    round k the table holds 2^k steps of every path, and the jumps are 2^k steps long.
    """
    d = cut(reach.select("source", "node", "d"))
    tight = d.select("source", F.col("node").alias("s"), F.col("d").alias("ds")).join(both_ways(arcs), "s").join(d.select("source", F.col("node").alias("t"), F.col("d").alias("dt")), ["source", "t"])
    closes = (F.abs(F.col("ds") + F.col("length") - F.col("dt")) <= 1e-9 * F.greatest(F.lit(1.0), F.col("dt"))) & (F.col("ds") < F.col("dt"))
    jump = cut(tight.filter(closes).groupBy("source", F.col("t").alias("node")).agg(F.min("s").alias("to")))
    held = cut(targets.select("source", "target").distinct().join(d.select("source", F.col("node").alias("target")), ["source", "target"], "left_semi").select("source", "target", F.lit(0).alias("back"), F.col("target").alias("node")))
    step = 1
    while True:
        more = cut(held.join(jump, ["source", "node"]).select("source", "target", (F.col("back") + step).alias("back"), F.col("to").alias("node")))
        if more.isEmpty():
            break
        held = cut(held.unionByName(more))
        jump = cut(jump.join(jump.select("source", F.col("node").alias("to"), F.col("to").alias("far")), ["source", "to"]).select("source", "node", F.col("far").alias("to")))
        step *= 2
    longest = held.groupBy("source", "target").agg(F.max("back").alias("most"))
    return held.join(longest, ["source", "target"]).select("source", "target", (F.col("most") - F.col("back")).cast("int").alias("seq"), "node")


def shortest_path(arcs: DataFrame, reach: DataFrame, source: int, target: int) -> DataFrame:
    """(seq, node) of a shortest path from source to target; no rows where there is none."""
    wanted = arcs.sparkSession.createDataFrame([(source, target)], "source long, target long")
    return shortest_paths(arcs, reach.filter(F.col("source") == source), wanted).select("seq", "node")


def distance_violations(edges: DataFrame, reach: DataFrame) -> DataFrame:
    """Edges (source, node, d) whose stated distance is not the shortest one, within max(1e-6, 1e-8 d)."""
    both = edges.withColumnRenamed("d", "stated").join(reach, ["source", "node"], "left")
    return both.filter(F.col("d").isNull() | (F.abs(F.col("d") - F.col("stated")) > F.greatest(F.lit(1e-6), 1e-8 * F.col("d"))))


def contracted(arcs: DataFrame, keep: DataFrame) -> DataFrame:
    """Arcs along chains of split vertices joined into one, except at kept nodes.

    ``arcs`` is (edge, seq, u, v, length) of parts of a parent edge in order; ``keep`` is (node).
    """
    w = W.partitionBy("edge").orderBy("seq")
    starts = arcs.join(keep.select(F.col("node").alias("u"), F.lit(1).alias("k")), "u", "left")
    group = F.sum(F.coalesce("k", F.lit(0))).over(w.rowsBetween(W.unboundedPreceding, 0))
    marked = starts.withColumn("g", F.when(F.row_number().over(w) == 1, group).otherwise(group))
    return marked.groupBy("edge", "g").agg(F.min_by("u", "seq").alias("u"), F.max_by("v", "seq").alias("v"), F.sum("length").alias("length"))


def edge_split(du, dv, length):
    """Offset on an arc up to which the owner of its first end is nearer: (d_v + length - d_u) / 2, clamped."""
    return F.greatest(F.lit(0.0), F.least(length, (dv + length - du) / 2))
