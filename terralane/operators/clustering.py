"""Density clusters, medoid refinement and territories.

Each type (and each cluster to be refined) is one group of a grouped Arrow function: its neighbour
pairs within the radius, not all pairs, are what the group holds.  Territories are sets of grid cells.
"""

from __future__ import annotations

import hashlib
import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terralane.operators.network import neighbour_graph
from terralane.session import cut

#: Candidate pairs that are expanded at once.
CHUNK = 2_000_000
#: Groups that hold the clusters of one type when they are refined.
GAP_GROUPS = 48


def core_distances(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray, weight: np.ndarray, min_samples: float) -> np.ndarray:
    """Smallest radius at which own and neighbours' weight reaches ``min_samples``; 0 if the own weight
    does, infinite if it never does within the listed pairs."""
    core = np.where(weight >= min_samples, 0.0, np.inf)
    i, j, r = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((d, d))
    order = np.lexsort((r, i))
    i, j, r = i[order], j[order], r[order]
    run = np.cumsum(weight[j])
    first = np.searchsorted(i, np.arange(n), "left")
    end = np.searchsorted(i, np.arange(n), "right")
    for v in np.flatnonzero(np.isinf(core) & (end > first)):
        base = run[first[v] - 1] if first[v] else 0.0
        reach = np.flatnonzero(run[first[v] : end[v]] - base + weight[v] >= min_samples)
        if len(reach):
            core[v] = r[first[v] + reach[0]]
    return core


def hdbscan(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray, weight: np.ndarray, min_cluster_size: float, min_samples: float, leaf: bool = False, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(labels, membership) of n positions with neighbour pairs (a, b, d); -1 is noise.

    Mutual reachability, a spanning forest, a hierarchy in which all merges of one distance happen at
    once, a condensed tree by weight, and the selection of the clusters with the greatest stability (or
    of the leaves).  All positions together are no cluster, unless ``whole`` says that they are one part of several.  Labels count clusters by their smallest member.
    """
    core = core_distances(n, a, b, d, weight, min_samples)
    m = np.maximum(np.maximum(core[a], core[b]), d)
    use = np.isfinite(m)
    return hierarchy(n, a[use], b[use], m[use], weight, min_cluster_size, leaf, whole)


def hierarchy(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray, weight: np.ndarray, min_cluster_size: float, leaf: bool = False, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(labels, membership) of ``hdbscan`` from mutual reachability distances m of pairs (a, b), all pairs or a spanning forest."""
    order = np.lexsort((b, a, m))
    parent = list(range(n))
    node_of = list(range(n))
    children: list[list[int]] = [[] for _ in range(n)]
    size = list(map(float, weight))
    height = [0.0] * n

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    k = 0
    while k < len(order):
        level = m[order[k]]
        touched: dict[int, set[int]] = {}
        end = k
        while end < len(order) and m[order[end]] == level:
            x, y = find(int(a[order[end]])), find(int(b[order[end]]))
            if x != y:
                x, y = min(x, y), max(x, y)
                parts = touched.pop(x, {node_of[x]}) | touched.pop(y, {node_of[y]})
                parent[y] = x
                touched[x] = parts
            end += 1
        for root, parts in touched.items():
            children.append(sorted(parts))
            size.append(sum(size[p] for p in parts))
            height.append(float(level))
            node_of[root] = len(children) - 1
        k = end

    labels, member = np.full(n, -1), np.zeros(n)
    found: list[tuple[list[int], dict[int, float]]] = []

    def points(node: int) -> list[int]:
        out, stack = [], [node]
        while stack:
            v = stack.pop()
            if v < n:
                out.append(v)
            else:
                stack.extend(children[v])
        return out

    inverse = lambda h: math.inf if h <= 0 else 1.0 / h
    # parts that no listed pair joins meet at infinite distance
    tops = sorted({node_of[find(v)] for v in range(n)})
    if n:
        children.append(tops)
        size.append(sum(size[v] for v in tops))
        height.append(math.inf)
    for top in [len(children) - 1] if n else []:
        if size[top] < min_cluster_size:
            continue
        # condensed tree: clusters (birth, stability, falling points, child clusters)
        clusters: list[dict] = []

        waiting: list[tuple[int, float, list[int]]] = [(top, 0.0, [])]
        while waiting:
            node, birth, siblings = waiting.pop()
            me = {"birth": birth, "stability": 0.0, "fall": {}, "kids": []}
            siblings.append(len(clusters))
            clusters.append(me)
            current = [node]
            while current:
                node = current.pop()
                lam = inverse(height[node]) if node >= n else math.inf
                if node < n:
                    me["fall"][node] = math.inf
                    break
                big = [c for c in children[node] if size[c] >= min_cluster_size]
                small = [c for c in children[node] if size[c] < min_cluster_size]
                for c in small:
                    for p in points(c):
                        me["fall"][p] = lam
                if len(big) == 1:
                    current.append(big[0])
                elif len(big) > 1:
                    for c in big:
                        gain = (lam - birth) * size[c]
                        me["stability"] += gain if not math.isnan(gain) else 0.0
                    waiting += [(c, lam, me["kids"]) for c in reversed(big)]
            me["stability"] += sum((min(v, 1e300) - birth) * weight[p] for p, v in me["fall"].items())

        chosen = [False] * len(clusters)
        best = [0.0] * len(clusters)
        for c in range(len(clusters) - 1, -1, -1):
            kids = clusters[c]["kids"]
            below = sum(best[q] for q in kids)
            own = clusters[c]["stability"] if c or whole else -1.0
            chosen[c] = bool(c or whole) and (not kids if leaf else (not kids or own >= below))
            best[c] = max(own, below) if not leaf else below
        stack = [0]
        while stack:
            c = stack.pop()
            if chosen[c]:
                inside: dict[int, float] = {}
                todo = [c]
                while todo:
                    q = todo.pop()
                    inside |= clusters[q]["fall"]
                    todo += clusters[q]["kids"]
                found.append((sorted(inside), inside))
            else:
                stack += clusters[c]["kids"]
    for number, (members, lam) in enumerate(sorted(found, key=lambda f: f[0][0])):
        top = max(lam.values())
        for p in members:
            labels[p] = number
            member[p] = 1.0 if math.isinf(top) and math.isinf(lam[p]) else (lam[p] / top if not math.isinf(top) else 0.0)
    return labels, member


class _Cells:
    """Points in square cells, sorted by cell; a row of cells is one stretch."""

    def __init__(self, xy: np.ndarray, size: float, reach: int):
        at = np.floor((xy - xy.min(0)) / size).astype(np.int64) + reach
        self.span = int(at[:, 1].max()) + reach + 1
        self.key = at[:, 0] * self.span + at[:, 1]
        self.order = np.argsort(self.key, kind="stable")
        self.sorted = self.key[self.order]


def _stretches(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the stretch, position) of every member of the stretches."""
    which = np.repeat(np.arange(len(count)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)


def _portions(cost: np.ndarray):
    """Slices of consecutive items that cost about ``CHUNK`` together, one item at least."""
    total, done = np.cumsum(cost), 0
    while done < len(cost):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + CHUNK, "right")))
        yield slice(done, stop)
        done = stop


def _around(xy: np.ndarray, some: np.ndarray, radius: float):
    """(i, j, d): for every point of ``some`` all others at most ``radius`` away, in portions of whole points."""
    cells = _Cells(xy, radius * (1 + 1e-9), 1)
    rows = cells.key[some][:, None] + np.array([-1, 0, 1]) * cells.span
    start, end = np.searchsorted(cells.sorted, rows - 1, "left"), np.searchsorted(cells.sorted, rows + 1, "right")
    for part in _portions((end - start).sum(1)):
        which, at = _stretches(start[part].ravel(), (end - start)[part].ravel())
        i, j = some[part][which // 3], cells.order[at]
        d = np.hypot(*(xy[j] - xy[i]).T)
        keep = (d <= radius) & (i != j)
        yield i[keep], j[keep], d[keep]


def _kruskal(n: int, a: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Numbers of the edges of a minimum spanning forest, in order of m."""
    parent, kept = list(range(n)), []
    order = np.lexsort((b, a, m))
    for k, x, y in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return np.array(kept, int)


def _parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of every point's part."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, label[a], label[b])
        np.minimum.at(low, label[b], label[a])
        low = low[low]
        if np.array_equal(low, label):
            return label
        label = low


def _closest(xy: np.ndarray, core: np.ndarray, left: np.ndarray, right: np.ndarray, limit: float) -> tuple[float, int, int] | None:
    """(m, i, j) of the least mutual reachability of two sets, if at most ``limit``: boxes are halved, far ones skipped."""
    best: tuple[float, int, int] | None = None
    todo = [(0.0, left, right)]
    while todo:
        low, i, j = todo.pop()
        if low > limit * (1 + 1e-12):
            continue
        if len(i) * len(j) <= 4096:
            d = np.hypot(xy[i, 0][:, None] - xy[j, 0], xy[i, 1][:, None] - xy[j, 1])
            m = np.maximum(np.maximum(core[i][:, None], core[j]), d)
            k = int(np.argmin(m))
            if m.flat[k] <= limit and (best is None or m.flat[k] < best[0]):
                best = (float(m.flat[k]), int(i[k // len(j)]), int(j[k % len(j)]))
                limit = best[0]
            continue
        if len(i) < len(j):
            i, j = j, i
        axis = int(np.argmax(np.ptp(xy[i], axis=0)))
        half = np.argpartition(xy[i, axis], len(i) // 2)
        parts = []
        for some in (i[half[: len(i) // 2]], i[half[len(i) // 2 :]]):
            gap = np.maximum(0.0, np.maximum(xy[some].min(0) - xy[j].max(0), xy[j].min(0) - xy[some].max(0)))
            parts.append((max(float(np.hypot(*gap)), core[some].min(), core[j].min()), some, j))
        todo += sorted(parts, key=lambda p: -p[0])
    return best


def mutual_forest(xy: np.ndarray, weight: np.ndarray, min_samples: float, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(core, a, b, m): core distances and a minimum spanning forest of the mutual reachability of all pairs within ``radius``.

    Merges at every distance are those of the whole list of pairs, which is never made: distances double
    from a small one to ``radius``, and of two parts that smaller distances have joined only the least
    pair counts.  Points meet by cells so small that members of one cell are already joined.
    """
    n = len(xy)
    core = np.where(weight >= min_samples, 0.0, np.inf)
    if not n:
        return core, np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    extent, doublings = float(np.ptp(xy, axis=0).max()), 0
    while extent / radius * 2 ** (doublings + 1) < 2**29:
        count = np.unique(_Cells(xy, radius / 2**doublings, 1).key, return_counts=True)[1].astype(float)
        if (count * count).sum() <= 8 * n:
            break
        doublings += 1
    steps = [radius / 2**k for k in range(doublings, -1, -1)]
    for r in steps:
        some = np.flatnonzero(np.isinf(core))
        if not len(some):
            break
        for i, j, d in _around(xy, some, r):
            order = np.lexsort((d, i))
            i, j, d = i[order], j[order], d[order]
            run = np.cumsum(weight[j])
            first = np.searchsorted(i, i, "left")
            reached = np.flatnonzero(run - run[first] + weight[j[first]] + weight[i] >= min_samples)
            _, at = np.unique(i[reached], return_index=True)
            core[i[reached[at]]] = d[reached[at]]

    a, b, m = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    for i, j, d in _around(xy, np.arange(n), steps[0]):
        d = np.maximum(np.maximum(core[i], core[j]), d)
        use = (i < j) & (d <= steps[0])
        a, b, m = np.concatenate((a, i[use])), np.concatenate((b, j[use])), np.concatenate((m, d[use]))
        kept = _kruskal(n, a, b, m)
        a, b, m = a[kept], b[kept], m[kept]
    for low, high in zip(steps, steps[1:]):
        part = _parts(n, a, b)
        active = np.flatnonzero(core <= high)
        if len(active) and (part[active] == part[active[0]]).all():
            continue
        i, j, d = _joining(xy[active], core[active], part[active], low, high)
        a, b, m = np.concatenate((a, active[i])), np.concatenate((b, active[j])), np.concatenate((m, d))
        kept = _kruskal(n, a, b, m)
        a, b, m = a[kept], b[kept], m[kept]
    return core, a, b, m


def _joining(xy: np.ndarray, core: np.ndarray, part: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, m): of every two parts that lie at most ``high`` apart a least pair; parts are joined up to ``low``."""
    if not len(xy):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    reach = math.ceil(high / (low * 0.7)) + 1
    cells = _Cells(xy, low * 0.7, reach)
    order = np.lexsort((part, cells.key))
    key, own = cells.key[order], part[order]
    first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (own[1:] != own[:-1]))))
    count = np.diff(np.append(first, len(order)))
    key, own = key[first], own[first]
    least, most = np.minimum.reduceat(xy[order], first, axis=0), np.maximum.reduceat(xy[order], first, axis=0)
    slow = np.minimum.reduceat(core[order], first)
    # groups of a cell and the following cells of its window, row by row
    g, h = [], []
    for dx in range(reach + 1):
        start = np.searchsorted(key, key + dx * cells.span - (reach if dx else 0), "left")
        end = np.searchsorted(key, key + dx * cells.span + reach, "right")
        for some in _portions(end - start):
            which, at = _stretches(start[some], (end - start)[some])
            x = np.arange(len(key))[some][which]
            use = own[x] != own[at]
            x, at = x[use], at[use]
            gap = np.maximum(0.0, np.maximum(least[x] - most[at], least[at] - most[x]))
            use = np.maximum(np.hypot(*gap.T), np.maximum(slow[x], slow[at])) <= high * (1 + 1e-12)
            g.append(x[use])
            h.append(at[use])
    g, h = np.concatenate(g), np.concatenate(h)
    heavy = count[g] * count[h] > 4096
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def least_of_parts() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j, d = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        x, y = np.minimum(part[i], part[j]), np.maximum(part[i], part[j])
        by = np.lexsort((j, i, d, y, x))
        lead = by[np.flatnonzero(np.concatenate(([True], (np.diff(x[by]) != 0) | (np.diff(y[by]) != 0))))] if len(by) else by
        return i[lead], j[lead], d[lead]

    x, y = g[~heavy], h[~heavy]
    for some in _portions(count[x] * count[y]):
        which, at = _stretches(np.zeros(len(x[some]), int), count[x[some]] * count[y[some]])
        width = count[y[some]][which]
        i, j = order[first[x[some]][which] + at // width], order[first[y[some]][which] + at % width]
        d = np.maximum(np.maximum(core[i], core[j]), np.hypot(*(xy[j] - xy[i]).T))
        use = d <= high
        found.append((i[use], j[use], d[use]))
        found[:] = [least_of_parts()]
    known = {(min(part[i], part[j]), max(part[i], part[j])): d for i, j, d in zip(*least_of_parts())} if heavy.any() else {}
    for x, y in zip(g[heavy], h[heavy]):
        pair = (min(own[x], own[y]), max(own[x], own[y]))
        best = _closest(xy, core, order[first[x] : first[x] + count[x]], order[first[y] : first[y] + count[y]], known.get(pair, high))
        if best:
            known[pair] = best[0]
            found.append((np.array([best[1]]), np.array([best[2]]), np.array([best[0]])))
    return least_of_parts()


def cluster_by_type(points: DataFrame, radius: float, min_cluster_size: int = 5, min_samples: int = 3, leaf: bool = False) -> DataFrame:
    """(type, id, cluster, membership) per type; ``points`` is (type, id, x, y) with unique ids.

    Points at one spot are one weighted position.  All pairs within ``radius`` count, by their spanning
    forest (``mutual_forest``).  The order of rows makes no difference.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").reset_index(drop=True)
        spots, where = np.unique(pdf[["x", "y"]].to_numpy(float), axis=0, return_inverse=True)
        where = where.ravel()
        first = np.full(len(spots), len(pdf))
        np.minimum.at(first, where, np.arange(len(pdf)))
        rank = np.argsort(np.argsort(first, kind="stable"), kind="stable")
        where, spots = rank[where], spots[np.argsort(first, kind="stable")]
        weight = np.bincount(where, minlength=len(spots)).astype(float)
        _, a, b, m = mutual_forest(spots, weight, min_samples, radius)
        labels, member = hierarchy(len(spots), a, b, m, weight, min_cluster_size, leaf)
        return pd.DataFrame({"type": pdf["type"], "id": pdf["id"], "cluster": labels[where].astype(np.int64), "membership": member[where]})

    return points.select("type", "id", "x", "y").groupBy("type").applyInPandas(run, "type string, id long, cluster long, membership double")


def cluster_pairs(positions: DataFrame, pairs: DataFrame, min_cluster_size: int, min_samples: int, leaf: bool = False) -> DataFrame:
    """(type, id, cluster, membership, core) of weighted positions (type, id, weight) with neighbour pairs (type, a, b, d).

    Positions that no chain of pairs joins share no cluster, so every connected part is a group of its own;
    its whole is a cluster only where the type has another part of that size.  ``core`` tells whether the
    position has a core distance.  Clusters are numbered per type by their smallest id.
    """
    from terralane.operators.network import components

    key = lambda t, i: F.xxhash64(F.col(t).cast("string"), F.col(i))
    nodes = cut(positions.select("type", "id", F.col("weight").cast("double").alias("weight"), key("type", "id").alias("node")))
    links = cut(pairs.select("type", "a", "b", "d", key("type", "a").alias("u"), key("type", "b").alias("v")))
    part = cut(components(nodes.select(F.col("node").alias("id")), links.select("u", "v", F.col("d").alias("length"))).withColumnRenamed("id", "node"))
    placed = nodes.join(part, "node").select("type", "id", "weight", "component")
    joined = links.join(part.select(F.col("node").alias("u"), "component"), "u").select("type", "component", "a", "b", "d")
    return _cluster_parts(placed, joined, min_cluster_size, min_samples, leaf)


def _cluster_parts(placed: DataFrame, links: DataFrame, min_cluster_size: int, min_samples: int, leaf: bool) -> DataFrame:
    """``cluster_pairs`` from positions (type, id, weight, component) and pairs (type, component, a, b, d) of known parts."""
    sizes = placed.groupBy("type", "component").agg(F.sum("weight").alias("size"))
    big = cut(sizes.filter(F.col("size") >= min_cluster_size))
    several = big.groupBy("type").agg(F.count(F.lit(1)).alias("parts"))
    inside = placed.join(big.select("type", "component"), ["type", "component"]).join(several, "type")
    joined = links.join(big.select("type", "component"), ["type", "component"], "left_semi")

    inside, joined = (x.select(*[F.col(c).alias(c) for c in x.columns]) for x in (inside, joined))

    def run(own: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("id").reset_index(drop=True)
        ids, weight = own["id"].to_numpy(), own["weight"].to_numpy(float)
        near = near.sort_values(["a", "b"])
        pair = (np.searchsorted(ids, near["a"].to_numpy()), np.searchsorted(ids, near["b"].to_numpy()), near["d"].to_numpy(float))
        labels, member = hdbscan(len(ids), *pair, weight, min_cluster_size, min_samples, leaf, whole=bool(own["parts"].iloc[0] > 1)) if len(ids) else (np.zeros(0, int), np.zeros(0))
        core = np.isfinite(core_distances(len(ids), *pair, weight, min_samples))
        return pd.DataFrame({"type": own["type"], "id": ids, "component": own["component"], "label": labels.astype(np.int64), "membership": member, "core": core})

    kind = dict(placed.dtypes)["type"]
    local = inside.groupBy("type", "component").cogroup(joined.groupBy("type", "component")).applyInPandas(run, f"type {kind}, id long, component long, label long, membership double, core boolean")
    local = cut(local)
    clusters = local.filter("label >= 0").groupBy("type", "component", "label").agg(F.min("id").alias("first"))
    numbers = clusters.withColumn("cluster", F.row_number().over(Window.partitionBy("type").orderBy("first")).cast("long") - 1).drop("first")
    found = local.join(numbers, ["type", "component", "label"], "left").select("type", "id", "cluster", "membership", "core")
    return placed.select("type", "id").join(found, ["type", "id"], "left").select("type", "id", F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("membership", F.lit(0.0)).alias("membership"), F.coalesce("core", F.lit(False)).alias("core"))


def _network_forest(own: pd.DataFrame, arcs: pd.DataFrame, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, d): a minimum spanning forest of the network distances up to ``radius`` between positions (u, v, offset).

    Every node of the network is owned by its nearest position.  Neighbours on an arc, and the owners at both
    ends of what lies between two positions, give pairs of which a spanning forest is one of all pairs.
    """
    names, ends = np.unique(arcs[["u", "v"]].to_numpy(np.int64), return_inverse=True)
    ends, length = ends.reshape(-1, 2), arcs["length"].to_numpy(float)
    place = pd.Index(pd.MultiIndex.from_frame(arcs[["u", "v"]]))
    arc, offset = place.get_indexer(pd.MultiIndex.from_frame(own[["u", "v"]])), own["offset"].to_numpy(float)
    order = np.lexsort((offset, arc))
    by = arc[order]
    same = by[1:] == by[:-1]
    first, last = order[np.concatenate(([True], ~same))], order[np.concatenate((~same, [True]))]
    pairs = [(order[:-1][same], order[1:][same], np.abs(np.diff(offset[order]))[same])]
    empty = np.setdiff1d(np.arange(len(arcs)), by)
    links: dict[int, list[tuple[int, float]]] = {}
    for (x, y), along in zip(ends[empty].tolist(), length[empty].tolist()):
        links.setdefault(x, []).append((y, along))
        links.setdefault(y, []).append((x, along))
    at = np.concatenate((ends[arc[first], 0], ends[arc[last], 1]))
    near, gap = np.concatenate((first, last)), np.concatenate((offset[first], (length[arc] - offset)[last]))
    heap = [(d, p, x) for d, p, x in zip(gap.tolist(), near.tolist(), at.tolist()) if d <= radius]
    heapq.heapify(heap)
    reach, owner = np.full(len(names), np.inf), np.full(len(names), -1)
    while heap:
        d, p, x = heapq.heappop(heap)
        if owner[x] >= 0:
            continue
        reach[x], owner[x] = d, p
        for y, along in links.get(x, ()):
            if owner[y] < 0 and d + along <= radius:
                heapq.heappush(heap, (d + along, p, y))
    pairs.append((near, owner[at], gap + reach[at]))
    x, y = ends[empty].T
    pairs.append((owner[x], owner[y], reach[x] + length[empty] + reach[y]))
    a, b, d = (np.concatenate(c) for c in zip(*pairs))
    use = (a >= 0) & (b >= 0) & (a != b) & (d <= radius)
    a, b, d = np.minimum(a, b)[use], np.maximum(a, b)[use], d[use]
    kept = _kruskal(len(own), a, b, d)
    return a[kept], b[kept], d[kept]


def _clusters_by_forest(heads: DataFrame, arcs: DataFrame, vertices: DataFrame, radius: float, min_cluster_size: int, min_samples: int, leaf: bool) -> DataFrame:
    """Clusters of positions (type, id, weight, u, v, offset) from spanning forests, for at most two samples.

    Up to two samples a position's core distance is nothing or the way to its nearest, so mutual
    reachability is the distance and its forest that of the distances.  A task holds the positions of one
    type on one connected part of the network, and the arcs of that part.
    """
    from terralane.operators.network import components

    net = cut(arcs.join(cut(components(vertices, arcs)).select(F.col("id").alias("u"), F.col("component").alias("net")), "u").select("u", "v", "length", "net"))
    placed = cut(heads.join(net.drop("length"), ["u", "v"]))
    roads = placed.select("type", "net").distinct().join(net, "net").select("type", "net", "u", "v", "length")
    kind = dict(heads.dtypes)["type"]

    def run(own: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("id").reset_index(drop=True)
        if not len(own):
            return pd.DataFrame({"type": [], "component": [], "a": [], "b": [], "d": []})
        a, b, d = _network_forest(own, near, radius)
        part, ids = _parts(len(own), a, b), own["id"].to_numpy()
        # a row for every position (b missing, d its weight) and every pair
        first, kept = np.concatenate((np.arange(len(own)), a)), np.concatenate((own["weight"].to_numpy(float), d))
        other = pd.array(np.concatenate((ids, ids[b])), dtype="Int64")
        other[: len(own)] = pd.NA
        return pd.DataFrame({"type": np.repeat(own["type"].to_numpy()[:1], len(first)), "component": ids[part[first]], "a": ids[first], "b": other, "d": kept})

    sides = [x.select(*[F.col(c).alias(c) for c in x.columns]).groupBy("type", "net") for x in (placed.select("type", "net", "id", "weight", "u", "v", "offset"), roads)]
    rows = cut(sides[0].cogroup(sides[1]).applyInPandas(run, f"type {kind}, component long, a long, b long, d double"))
    points = rows.filter("b IS NULL").select("type", F.col("a").alias("id"), F.col("d").alias("weight"), "component")
    return _cluster_parts(points, rows.filter("b IS NOT NULL").select("type", "component", "a", "b", "d"), min_cluster_size, min_samples, leaf)


def cluster_on_network(points: DataFrame, arcs: DataFrame, vertices: DataFrame, radius: float, min_cluster_size: int = 5, min_samples: int = 3, leaf: bool = False, growth: float = 1.5, steps: int = 3) -> DataFrame:
    """(type, id, cluster, membership) by distances along a road network.

    ``points`` is (type, id, u, v, offset), snapped to arcs.  Points of one type at one place are one
    position, weighted by their number.  All pairs within the radius count: up to ``min_samples`` 2 by
    their spanning forest, beyond by their list.  ``growth`` and ``steps`` no longer change anything.
    """
    arcs = cut(arcs)
    ends = points.join(arcs, ["u", "v"])
    place = F.when(F.col("offset") <= 0, F.concat(F.lit("n"), "u")).when(F.col("offset") >= F.col("length"), F.concat(F.lit("n"), "v")).otherwise(F.concat_ws("/", "u", "v", "offset"))
    at = cut(ends.select("type", "id", "u", "v", "offset", place.alias("place")))
    spots = at.groupBy("type", "place").agg(F.min(F.struct("id", "u", "v", "offset")).alias("head"), F.count(F.lit(1)).alias("weight"))
    heads = cut(spots.select("type", "head.*", "weight", "place"))
    if min_samples <= 2:
        found = _clusters_by_forest(heads, arcs, vertices, radius, min_cluster_size, min_samples, leaf)
    else:
        pairs = neighbour_graph(arcs, heads.select("type", "id", "u", "v", "offset"), radius, vertices, by="type")
        found = cluster_pairs(heads.select("type", "id", "weight"), pairs, min_cluster_size, min_samples, leaf)
    found = heads.select("type", "place", "id").join(found.select("type", "id", "cluster", "membership"), ["type", "id"]).drop("id")
    return at.join(found, ["type", "place"]).select("type", "id", "cluster", "membership")


def seed_of(base: str, sector: str, cluster: int) -> int:
    """Seed from the first eight bytes, little endian, of a SHA-256."""
    return int.from_bytes(hashlib.sha256(f"{base}|{sector}|{cluster}".encode()).digest()[:8], "little")


def medoids(d: np.ndarray, k: int) -> tuple[list[int], float]:
    """k medoids of a distance matrix: greedy build, then best swaps until none helps; ties to smaller indices."""
    chosen = [int(np.argmin(d.sum(1)))]
    while len(chosen) < k:
        near = d[:, chosen].min(1)
        gain = np.maximum(near[:, None] - d, 0).sum(0)
        gain[chosen] = -1
        chosen.append(int(np.argmax(gain)))
    cost = float(d[:, chosen].min(1).sum())
    while True:
        best = (cost, None)
        for i in range(k):
            rest = chosen[:i] + chosen[i + 1 :]
            base = d[:, rest].min(1) if rest else np.full(len(d), np.inf)
            trial = np.minimum(base[:, None], d).sum(0)
            trial[chosen] = np.inf
            j = int(np.argmin(trial))
            if trial[j] < best[0] - 1e-12:
                best = (float(trial[j]), (i, j))
        if best[1] is None:
            return sorted(chosen), cost
        cost, (i, j) = best
        chosen[i] = j


def gap_refinement(points: DataFrame, max_k: int = 4, draws: int = 8, min_size: int = 8, base: str = "gap") -> DataFrame:
    """(type, cluster, id, part, k): clusters split into k medoid parts where the gap statistic says so.

    The curve of the points is compared with reference draws from their bounding box, made by a seed of
    the cluster; the smallest k within one standard error of the next is taken.  Noise is left alone.
    A task takes the clusters of a type in ``GAP_GROUPS`` groups, one after the other.
    """

    def refined(kind: str, cluster: int, xy: np.ndarray) -> tuple[np.ndarray, int]:
        part, k = np.zeros(len(xy), int), 1
        if cluster >= 0 and len(xy) >= min_size:
            dist = lambda p: np.hypot(p[:, None, 0] - p[None, :, 0], p[:, None, 1] - p[None, :, 1])
            own = dist(xy)
            rng = np.random.default_rng(seed_of(base, kind, cluster))
            top = min(max_k, len(xy) // 2)
            curve = [medoids(own, j)[1] for j in range(1, top + 1)]
            low, high = xy.min(0), xy.max(0)
            reference = np.log(np.maximum(1e-12, [[medoids(dist(low + rng.random(xy.shape) * (high - low)), j)[1] for j in range(1, top + 1)] for _ in range(draws)]))
            gap = reference.mean(0) - np.log(np.maximum(1e-12, curve))
            error = reference.std(0) * math.sqrt(1 + 1 / draws)
            k = next((j for j in range(1, top) if gap[j - 1] >= gap[j] - error[j]), top)
            centres = medoids(own, k)[0]
            part = np.argmin(own[:, centres], axis=1)
        return part, k

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cluster", "id"]).reset_index(drop=True)
        kind, cluster, xy = str(pdf["type"].iloc[0]), pdf["cluster"].to_numpy(), pdf[["x", "y"]].to_numpy(float)
        part, ks = np.zeros(len(pdf), np.int64), np.ones(len(pdf), np.int64)
        first = np.flatnonzero(np.concatenate(([True], cluster[1:] != cluster[:-1])))
        for a, b in zip(first, np.append(first[1:], len(pdf))):
            part[a:b], ks[a:b] = refined(kind, int(cluster[a]), xy[a:b])
        return pd.DataFrame({"type": pdf["type"], "cluster": pdf["cluster"], "id": pdf["id"], "part": part, "k": ks})

    bucket = F.pmod(F.xxhash64("cluster"), F.lit(GAP_GROUPS))
    return points.select("type", "cluster", "id", "x", "y").groupBy("type", bucket).applyInPandas(run, "type string, cluster long, id long, part long, k long")


def grid_cells(spark, x0: float, y0: float, x1: float, y1: float, size: float) -> DataFrame:
    """(col, row, x, y, area) of the cells of a box; border cells are clipped, so the areas add up to the box."""
    cols, rows = math.ceil((x1 - x0) / size), math.ceil((y1 - y0) / size)
    cells = spark.range(cols * rows).select((F.col("id") % cols).alias("col"), F.floor(F.col("id") / cols).alias("row"))
    left, low = F.lit(x0) + F.col("col") * size, F.lit(y0) + F.col("row") * size
    right, high = F.least(left + size, F.lit(x1)), F.least(low + size, F.lit(y1))
    return cells.select("col", "row", ((left + right) / 2).alias("x"), ((low + high) / 2).alias("y"), ((right - left) * (high - low)).alias("area"))


def cell_budget(width: float, height: float, size: float, most: int) -> float:
    """The given cell size, doubled and bisected as needed so that at most ``most`` cells cover the box."""
    count = lambda s: math.ceil(width / s) * math.ceil(height / s)
    if count(size) <= most:
        return size
    high = size
    while count(high) > most:
        high *= 2
    low = high / 2
    for _ in range(12):
        mid = (low + high) / 2
        low, high = (low, mid) if count(mid) <= most else (mid, high)
    return high


def territories(cells: DataFrame, centers: DataFrame) -> DataFrame:
    """(col, row, area, type, cluster) of the nearest center per type and cell; ties to the smaller cluster.

    The centers of a type are held as one array per type and matched cell by cell, without a shuffle of
    the cells; ``centers`` is (type, cluster, x, y), a table of clusters.
    """
    lists = centers.groupBy("type").agg(F.collect_list(F.struct("cluster", F.col("x").alias("cx"), F.col("y").alias("cy"))).alias("c"))
    spread = cells.withColumn("type", F.explode(F.array(*[F.lit(r["type"]) for r in lists.select("type").orderBy("type").collect()]))).join(lists, "type")
    near = F.array_min(F.transform("c", lambda c: F.struct(F.round(F.hypot(F.col("x") - c["cx"], F.col("y") - c["cy"]), 9).alias("d"), c["cluster"].alias("cluster"))))
    return spread.select("col", "row", "area", "type", near["cluster"].alias("cluster"))


def territory_areas(cells: DataFrame) -> DataFrame:
    return cells.groupBy("type", "cluster").agg(F.count(F.lit(1)).alias("cells"), F.sum("area").alias("area"))


def changed_share(coarse: DataFrame, fine: DataFrame) -> DataFrame:
    """(type, changed): the share of the area whose owner differs between a grid and its halved one."""
    parents = fine.select("type", F.floor(F.col("col") / 2).alias("col"), F.floor(F.col("row") / 2).alias("row"), F.col("cluster").alias("new"), F.col("area").alias("a"))
    both = parents.join(coarse.select("type", "col", "row", F.col("cluster").alias("old")), ["type", "col", "row"])
    return both.groupBy("type").agg((F.sum(F.when(F.col("new") == F.col("old"), 0.0).otherwise(F.col("a"))) / F.sum("a")).alias("changed"))
