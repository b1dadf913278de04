"""The sector-by-cluster graph: instantiation, centralities, area adjustment, scores, diagnostics.

Iterations are DataFrame loops of joins and partial sums whose state is written out every few steps.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.session import cut

EVERY = 8


def cluster_shares(points: DataFrame) -> DataFrame:
    """(type, cluster, n, share, radius): size, share within the type, mean distance to the centre.

    Noise (cluster -1 or null) has no cluster; ``points`` is (type, cluster, distance).
    """
    sizes = points.filter("cluster >= 0").groupBy("type", "cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("distance").alias("radius"))
    return sizes.select("type", "cluster", "n", (F.col("n") / F.sum("n").over(W.partitionBy("type"))).alias("share"), "radius")


def overlapping(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs of clusters whose territories share a grid cell, for linked types; ``cells`` is (type, cluster, cell)."""
    a = cells.select(F.col("type").alias("src"), F.col("cluster").alias("src_cluster"), "cell")
    b = cells.select(F.col("type").alias("dst"), F.col("cluster").alias("dst_cluster"), "cell")
    return edges.join(a, "src").join(b, ["dst", "cell"]).select("src", "dst", "src_cluster", "dst_cluster", "a").distinct()


def graph_edges(pairs: DataFrame, nodes: DataFrame, distances: DataFrame, decay: float) -> DataFrame:
    """Weighted edges a * q_s * q_t / max(d + r_s + r_t, 1) ** decay of overlapping clusters.

    ``distances`` is (src, src_cluster, dst, dst_cluster, d); pairs without distance are not connected
    and a self-pair at distance zero is dropped.
    """
    s = nodes.select(F.col("type").alias("src"), F.col("cluster").alias("src_cluster"), F.col("share").alias("qs"), F.col("radius").alias("rs"))
    d = nodes.select(F.col("type").alias("dst"), F.col("cluster").alias("dst_cluster"), F.col("share").alias("qt"), F.col("radius").alias("rt"))
    rows = pairs.join(distances, ["src", "src_cluster", "dst", "dst_cluster"]).join(s, ["src", "src_cluster"]).join(d, ["dst", "dst_cluster"])
    own = (F.col("src") == F.col("dst")) & (F.col("src_cluster") == F.col("dst_cluster")) & (F.col("d") == 0)
    reach = F.greatest(F.col("d") + F.col("rs") + F.col("rt"), F.lit(1.0))
    return rows.filter(~own).select("src", "src_cluster", "dst", "dst_cluster", "d", (F.col("a") * F.col("qs") * F.col("qt") * F.pow(reach, F.lit(-decay))).alias("w"))


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, out_degree, in_degree) for every node; edges is (u, v, w)."""
    out = edges.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("out_degree"))
    into = edges.groupBy(F.col("v").alias("node")).agg(F.count(F.lit(1)).alias("in_degree"))
    return nodes.select("node").join(out, "node", "left").join(into, "node", "left").fillna(0, ["out_degree", "in_degree"])


def undirected(edges: DataFrame) -> DataFrame:
    """(u, v, w) with u <= v: the weights of both directions together; only positive weights count."""
    return edges.filter("w > 0").groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.sum("w").alias("w"))


def is_acyclic(edges: DataFrame) -> bool:
    """Peels nodes without incoming edges until nothing changes; empty at the end means acyclic.

    Every round drops at least one node or is the last, so the loop ends by itself.
    """
    left = cut(edges.select("u", "v").distinct())
    before = left.count()
    while before:
        left = cut(left.join(left.select(F.col("v").alias("u")).distinct(), "u", "left_semi"))
        now = left.count()
        if now == before:
            return False
        before = now
    return True


def row_sum_bound(edges: DataFrame) -> float:
    """Greatest row sum of the weights, an upper bound of the spectral radius; 0 without edges."""
    return edges.groupBy("u").agg(F.sum("w").alias("s")).agg(F.max("s")).first()[0] or 0.0


#: Edges up to which an iteration runs in one task (three arrays, some 100 MB); more iterate as joins.
LOCAL_EDGES = 4_000_000
#: What an iteration may change per node in its last step, and steps after which it is an error.
TOLERANCE, MOST_STEPS = 1e-10, 10_000


def support(edges: DataFrame) -> DataFrame:
    """(u, v, w): weights of parallel edges together; zero weights drop, negative and non-finite ones are an error."""
    bad = F.col("w").isNull() | F.isnan("w") | (F.col("w") < 0) | (F.col("w") == float("inf"))
    checked = F.when(bad, F.raise_error(F.concat_ws(" ", F.lit("bad weight at"), "u", "v"))).otherwise(F.col("w").cast("double"))
    return edges.select("u", "v", checked.alias("w")).filter("w > 0").groupBy("u", "v").agg(F.sum("w").alias("w"))


class Arrays:
    """A graph in arrays: names of the nodes, edges (s, t, w) by number, a factor per node."""

    def __init__(self, names, s: np.ndarray, t: np.ndarray, w: np.ndarray, factor: np.ndarray):
        self.names, self.s, self.t, self.w, self.factor = names, s, t, w, factor
        self.n = len(factor)

    def out(self, x: np.ndarray) -> np.ndarray:
        """F W x."""
        return self.factor * np.bincount(self.s, self.w * x[self.t], self.n)

    def into(self, x: np.ndarray) -> np.ndarray:
        """F W' x."""
        return self.factor * np.bincount(self.t, self.w * x[self.s], self.n)

    def acyclic(self) -> bool:
        waiting = np.bincount(self.t, minlength=self.n)
        order = np.argsort(self.s, kind="stable")
        t, first = self.t[order], np.searchsorted(self.s[order], np.arange(self.n + 1))
        ready, done = list(np.flatnonzero(waiting == 0)), 0
        while ready:
            v = ready.pop()
            done += 1
            for k in range(first[v], first[v + 1]):
                waiting[t[k]] -= 1
                if not waiting[t[k]]:
                    ready.append(t[k])
        return done == self.n

    def scale(self) -> tuple[float, float, str]:
        """(spectral radius, what alpha is divided by, how it was found).

        The radius by power iteration on (F W / bound + I) / 2, which periodic graphs do not upset.  The
        greatest growth of a node is taken, since parts of the graph that are not joined grow at their own rates.
        """
        bound = float(self.out(np.ones(self.n)).max()) if len(self.s) else 0.0
        if bound <= 0:
            return 0.0, 1.0, "no edges"
        if self.acyclic():
            return 0.0, bound, "row sum of an acyclic graph"
        x, before, steady = np.full(self.n, 1.0 / self.n), 0.0, 0
        for _ in range(max(5_000, 20 * min(self.n, 10_000))):
            y = (self.out(x) / bound + x) / 2
            seen = x > 1e-250
            now = float((y[seen] / x[seen]).max())
            x = y / y.max()
            steady = steady + 1 if abs(now - before) <= 1e-15 * now else 0
            before = now
            if steady >= 20:
                break
        rho = max(0.0, 2 * before - 1)
        return (rho * bound, rho * bound, "spectral radius") if rho > 1e-15 else (0.0, bound, "row sum of a zero radius")

    def katz(self, alpha: float, beta: float, incoming: bool) -> np.ndarray:
        """x = beta + alpha F W' x (incoming) or beta + alpha F W x, until a step changes less than n * TOLERANCE."""
        x, push = np.zeros(self.n), self.into if incoming else self.out
        for _ in range(MOST_STEPS):
            y = beta + alpha * push(x)
            if np.abs(y - x).sum() < self.n * TOLERANCE:
                return y
            x = y
        raise RuntimeError(f"Katz did not converge within {MOST_STEPS} steps")


def _in_one_task(edges: DataFrame, nodes: DataFrame, kernel, schema: str, factors: DataFrame | None = None) -> DataFrame:
    """The rows that ``kernel`` gives for a graph of at most ``LOCAL_EDGES`` edges, computed in one task.

    Nodes without edges take part; ``factors`` is (node, f), 1 where a node has none.
    """
    all_nodes = nodes.select("node").distinct()
    placed = all_nodes.join(factors.select("node", F.col("f").cast("double").alias("f")), "node", "left") if factors is not None else all_nodes.withColumn("f", F.lit(1.0))
    rows = edges.select("u", "v", "w").unionByName(placed.select(F.col("node").alias("u"), F.lit(None).cast("string").alias("v"), F.coalesce("f", F.lit(1.0)).alias("w")))

    def run(batches):
        import pyarrow as pa

        table = pa.Table.from_batches(list(batches))
        if not len(table):
            return
        u, v, w = (table.column(i).combine_chunks() for i in range(3))
        is_node = v.is_null().to_numpy(zero_copy_only=False)
        names, at = np.unique(u.filter(pa.array(is_node)).to_numpy(zero_copy_only=False).astype(str), return_index=True)
        weight = w.to_numpy(zero_copy_only=False)
        s, t = (np.searchsorted(names, x.filter(pa.array(~is_node)).to_numpy(zero_copy_only=False).astype(str)) for x in (u, v))
        graph = Arrays(names, s, t, weight[~is_node], weight[is_node][at])
        columns = kernel(graph)
        yield pa.RecordBatch.from_pydict(columns)

    return rows.coalesce(1).mapInArrow(run, schema)


_KATZ = "node string, centrality double, katz_in double, katz_out double, alpha double, radius double, scale string"


def _kernel_of(alpha_factor: float, beta: float):
    def kernel(g: Arrays) -> dict:
        radius, scale, kind = g.scale()
        alpha = alpha_factor / scale
        if not math.isfinite(alpha):
            raise ValueError("the weights are too small to scale Katz")
        into, out = g.katz(alpha, beta, True), g.katz(alpha, beta, False)
        both = np.sqrt(into * out)
        both = both / np.sqrt((both * both).sum())
        n = g.n
        return {"node": g.names.tolist(), "centrality": both, "katz_in": into, "katz_out": out, "alpha": [alpha] * n, "radius": [radius] * n, "scale": [kind] * n}

    return kernel


def balanced_katz(edges: DataFrame, nodes: DataFrame, alpha_factor: float = 0.85, beta: float = 1.0, factors: DataFrame | None = None, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, centrality, katz_in, katz_out, alpha, radius, scale) of directed weighted edges (u, v, w).

    Incoming and outgoing Katz with one alpha, ``alpha_factor`` over the spectral radius, or over the
    greatest row sum where the graph has no cycle, iterated until a step changes less than
    n * ``TOLERANCE``; their geometric mean, length one over all nodes, is the centrality.  ``factors``
    (node, f) weigh the links as each node sees them: F W outgoing, F W' incoming.  Zero weights and
    parallel edges count as in ``support``; nodes without edges take part; no nodes give no rows.
    """
    if not 0 < alpha_factor < 1 or not beta > 0 or not math.isfinite(beta):
        raise ValueError("alpha_factor must lie between 0 and 1 and beta be positive")
    links = cut(support(edges))
    if links.limit(local_edges + 1).count() <= local_edges:
        return _in_one_task(links, nodes, _kernel_of(alpha_factor, beta), _KATZ, factors)
    # more edges than a task may hold: the same iteration as joins and sums
    every = cut(nodes.select("node").distinct())
    f = every.join(factors, "node", "left") if factors is not None else every.withColumn("f", F.lit(1.0))
    f = cut(f.select("node", F.coalesce(F.col("f").cast("double"), F.lit(1.0)).alias("f")))
    out = cut(links.join(f.withColumnRenamed("node", "u"), "u").select(F.col("v").alias("s"), F.col("u").alias("t"), (F.col("w") * F.col("f")).alias("w")))
    into = cut(links.join(f.withColumnRenamed("node", "v"), "v").select(F.col("u").alias("s"), F.col("v").alias("t"), (F.col("w") * F.col("f")).alias("w")))
    seen = out.select(F.col("t").alias("u"), F.col("s").alias("v"), "w")
    bound = row_sum_bound(seen)
    if is_acyclic(seen):
        radius, scale, kind = 0.0, bound, "row sum of an acyclic graph"
    else:
        radius = spectral_radius(seen, every)
        radius, scale, kind = (radius, radius, "spectral radius") if radius > 1e-15 * bound else (0.0, bound, "row sum of a zero radius")
    alpha = alpha_factor / scale
    both = _iterated(into, every, alpha, beta).withColumnRenamed("x", "katz_in").join(_iterated(out, every, alpha, beta).withColumnRenamed("x", "katz_out"), "node")
    both = cut(both.withColumn("g", F.sqrt(F.col("katz_in") * F.col("katz_out"))))
    norm = math.sqrt(both.agg(F.sum(F.col("g") * F.col("g"))).first()[0] or 1.0)
    return both.select("node", (F.col("g") / norm).alias("centrality"), "katz_in", "katz_out", F.lit(alpha).alias("alpha"), F.lit(radius).alias("radius"), F.lit(kind).alias("scale"))


def _iterated(links: DataFrame, nodes: DataFrame, alpha: float, beta: float) -> DataFrame:
    """(node, x): x = beta + alpha * sum of w x over the links (s, t, w) into a node, by joins until it stands."""
    state = nodes.select("node", F.lit(0.0).alias("x"))
    n = nodes.count()
    for _ in range(MOST_STEPS // EVERY):
        for _ in range(EVERY):
            before = state
            pushed = links.join(state.withColumnRenamed("node", "s"), "s").groupBy(F.col("t").alias("node")).agg(F.sum(F.col("w") * F.col("x")).alias("p"))
            state = nodes.select("node").join(pushed, "node", "left").select("node", (F.lit(beta) + F.lit(alpha) * F.coalesce("p", F.lit(0.0))).alias("x"))
        both = cut(state.join(before.withColumnRenamed("x", "y"), "node"))
        state = both.select("node", "x")
        if (both.agg(F.sum(F.abs(F.col("x") - F.col("y")))).first()[0] or 0.0) < n * TOLERANCE:
            return state
    raise RuntimeError(f"Katz did not converge within {MOST_STEPS} steps")


def spectral_radius(edges: DataFrame, nodes: DataFrame, local_edges: int = LOCAL_EDGES) -> float:
    """Power iteration on (W / bound + I) / 2 until it stands; 0 for an acyclic graph and without edges."""
    links = cut(support(edges))
    if links.limit(local_edges + 1).count() <= local_edges:
        row = _in_one_task(links, nodes, lambda g: {"radius": [g.scale()[0]]}, "radius double").first()
        return row[0] if row else 0.0
    if is_acyclic(links):
        return 0.0
    bound = row_sum_bound(links)
    state, value = cut(nodes.select("node").distinct().withColumn("x", F.lit(1.0))), 0.0
    for _ in range(MOST_STEPS // EVERY):
        before = state
        for _ in range(EVERY):
            pushed = links.join(state.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.sum(F.col("w") / bound * F.col("x")).alias("p"))
            state = state.join(pushed, "node", "left").select("node", ((F.col("x") + F.coalesce("p", F.lit(0.0))) / 2).alias("x"))
        state = cut(state)
        # the greatest growth of a node: parts of the graph that are not joined grow at their own rates
        growth, top = state.join(before.withColumnRenamed("x", "y"), "node").filter("y > 1e-250").agg(F.max(F.col("x") / F.col("y")), F.max("x")).first()
        state = state.select("node", (F.col("x") / top).alias("x"))
        now = growth ** (1 / EVERY)
        if abs(now - value) <= 1e-12 * now:
            return max(0.0, (2 * now - 1) * bound)
        value = now
    raise RuntimeError("the spectral radius did not converge")


def katz(edges: DataFrame, nodes: DataFrame, alpha_factor: float = 0.85, beta: float = 1.0, incoming: bool = True) -> DataFrame:
    """(node, x): one-sided Katz, incoming or outgoing, length one over all nodes."""
    side = "katz_in" if incoming else "katz_out"
    both = cut(balanced_katz(edges, nodes, alpha_factor, beta).select("node", F.col(side).alias("x")))
    norm = math.sqrt(both.agg(F.sum(F.col("x") * F.col("x"))).first()[0] or 1.0)
    return both.select("node", (F.col("x") / norm).alias("x"))


def area_factors(areas: DataFrame, gamma: float) -> DataFrame:
    """(node, f): area ** -gamma; an area that is not positive is an error."""
    checked = F.when(F.col("area") > 0, F.col("area").cast("double")).otherwise(F.raise_error(F.lit("areas must be positive")))
    return areas.select("node", F.pow(checked, F.lit(-gamma)).alias("f"))


def principal(push, n: int, most: int = 2_000) -> np.ndarray:
    """The limit of x <- x + push(x) from equal values, for a symmetric matrix without negative values, length one.

    Lanczos with full orthogonalisation, begun anew from the best vector of up to 64 products until that is
    an eigenvector to rounding; what is still farther off than ``TOLERANCE`` after ``most`` spaces is an error.
    """
    x = np.full(n, 1.0 / math.sqrt(n))
    width = max(4, min(64, n, 32_000_000 // n))
    for _ in range(most):
        basis, diagonal, beside = np.zeros((width, n)), [], []
        basis[0] = x
        for k in range(width):
            y = push(basis[k])
            diagonal.append(float(basis[k] @ y))
            for _ in range(2):
                y -= basis[: k + 1].T @ (basis[: k + 1] @ y)
            length = float(np.sqrt(y @ y))
            if k + 1 == width or length <= 1e-14 * max(map(abs, diagonal)):
                break
            beside.append(length)
            basis[k + 1] = y / length
        k = len(diagonal)
        value, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
        x = vectors[:, -1] @ basis[:k]
        x = np.maximum(x if x.sum() > 0 else -x, 0.0)
        x /= np.sqrt(x @ x)
        off = push(x) - value[-1] * x
        off = float(np.sqrt(off @ off)) / value[-1]
        if off <= 1e-13:
            return x
    if off <= TOLERANCE:
        return x
    raise RuntimeError("eigenvector centrality did not converge")


def eigenvector(edges: DataFrame, nodes: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, x) of the undirected projection: where x <- x + Ax from equal values leads, length one; equal without edges.

    In one task the limit comes from Krylov spaces, however near the greatest eigenvalues lie (parts that are
    not joined have their own).  By joins the steps end when one changes less than n * ``TOLERANCE``; 5,000
    steps without that are an error.
    """
    pairs = cut(undirected(support(edges)))

    def kernel(g: Arrays) -> dict:
        if len(g.s):
            other = g.s != g.t
            x = principal(lambda x: np.bincount(g.s, g.w * x[g.t], g.n) + np.bincount(g.t[other], (g.w * x[g.s])[other], g.n), g.n)
        else:
            x = np.full(g.n, 1.0 / math.sqrt(g.n))
        return {"node": g.names.tolist(), "x": x}

    if pairs.limit(local_edges + 1).count() <= local_edges:
        return _in_one_task(pairs, nodes, kernel, "node string, x double")
    both = cut(pairs.select("u", "v", "w").union(pairs.filter("u <> v").select("v", "u", "w")))
    every = cut(nodes.select("node").distinct())
    n = max(1, every.count())
    state = every.withColumn("x", F.lit(1.0 / n))
    for _ in range(5_000 // EVERY):
        for _ in range(EVERY):
            before = state
            pushed = both.join(state.withColumnRenamed("node", "u"), "u").groupBy(F.col("v").alias("node")).agg(F.sum(F.col("w") * F.col("x")).alias("p"))
            state = state.join(pushed, "node", "left").select("node", (F.col("x") + F.coalesce("p", F.lit(0.0))).alias("x"))
        two = cut(state.join(before.withColumnRenamed("x", "y"), "node"))
        nx, ny = (math.sqrt(v) for v in two.agg(F.sum(F.col("x") * F.col("x")), F.sum(F.col("y") * F.col("y"))).first())
        state = two.select("node", (F.col("x") / nx).alias("x"))
        if two.agg(F.sum(F.abs(F.col("x") / nx - F.col("y") / ny))).first()[0] < n * TOLERANCE:
            return state
    raise RuntimeError("eigenvector centrality did not converge")


def poisson_log_area(df: DataFrame, y: str, area: str, steps: int = 100) -> dict[str, float]:
    """Poisson regression of y on log area: Newton steps whose sums are one aggregate each.

    Returns intercept, slope, gamma (the slope's negative), the heteroskedasticity-robust (HC1) standard
    error of the slope, its 95 % interval, the rank correlation of area and y, and the rows.  Rows whose
    area is not positive and negative or missing y are an error, as is a constant area.
    """
    bad = F.col(y).isNull() | (F.col(y) < 0) | ~F.coalesce(F.col(area) > 0, F.lit(False))
    rows = cut(df.select(F.when(bad, F.raise_error(F.lit("y must be at least 0 and the area positive"))).otherwise(F.col(y).cast("double")).alias("y"), F.log(F.col(area)).alias("z")))
    n, mean, low, high = rows.agg(F.count(F.lit(1)), F.avg("y"), F.min("z"), F.max("z")).first()
    if not n or not mean or high - low < 1e-12:
        raise ValueError("the slope is not identified")
    a, b = math.log(mean), 0.0
    for _ in range(steps):
        mu = F.exp(F.lit(a) + F.lit(b) * F.col("z"))
        g0, g1, h00, h01, h11 = rows.agg(F.sum(F.col("y") - mu), F.sum((F.col("y") - mu) * F.col("z")), F.sum(mu), F.sum(mu * F.col("z")), F.sum(mu * F.col("z") * F.col("z"))).first()
        det = h00 * h11 - h01 * h01
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        a, b = a + da, b + db
        if abs(da) + abs(db) < 1e-10:
            break
    else:
        raise RuntimeError(f"the regression did not converge within {steps} steps")
    mu = F.exp(F.lit(a) + F.lit(b) * F.col("z"))
    e2 = (F.col("y") - mu) ** 2
    m00, m01, m11 = rows.agg(F.sum(e2), F.sum(e2 * F.col("z")), F.sum(e2 * F.col("z") * F.col("z"))).first()
    s0, s1 = -h01 / det, h00 / det
    se = math.sqrt((s0 * s0 * m00 + 2 * s0 * s1 * m01 + s1 * s1 * m11) * n / max(1, n - 2))
    return {"intercept": a, "slope": b, "gamma": -b, "se": se, "low": b - 1.959963984540054 * se, "high": b + 1.959963984540054 * se, "rho": rank_correlation(rows, "z", "y"), "n": n}


def inverse_distance_scores(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """centrality / max(distance, 1) per point; points is (id, node, distance)."""
    return points.join(nodes, "node").select("id", "node", (F.col("centrality") / F.greatest("distance", F.lit(1.0))).alias("score"))


def tempered_scores(points: DataFrame, nodes: DataFrame, decay: float) -> DataFrame:
    """centrality * (1 - decay * min(distance / max(p90, 1), 1)), p90 exact within the node."""
    p90 = points.groupBy("node").agg(F.percentile("distance", F.lit(0.9)).alias("p90"))
    far = F.least(F.col("distance") / F.greatest("p90", F.lit(1.0)), F.lit(1.0))
    return points.join(p90, "node").join(nodes, "node").select("id", "node", "p90", (F.col("centrality") * (1 - F.lit(decay) * far)).alias("score"))


def overlap_at(a: DataFrame, b: DataFrame, k: int) -> int:
    """How many of the k best nodes of (node, centrality) tables are the same; ties by node."""
    top = [x.orderBy(F.col("centrality").desc(), "node").limit(k).select("node") for x in (a, b)]
    return top[0].join(top[1], "node").count()


def _mid_ranks(df: DataFrame, c: str) -> DataFrame:
    """(c, rank): average rank of every distinct value.

    Values are range-partitioned and sorted where they are; the counts of the partitions before one are
    added as an offset, so no task sees all values.
    """
    values = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).repartitionByRange(c).withColumn("part", F.spark_partition_id())
    values = cut(values)
    totals = sorted((r["part"], r["n"]) for r in values.groupBy("part").agg(F.sum("n").alias("n")).collect())
    offsets, below = {}, 0
    for part, n in totals:
        offsets[part], below = below, below + n
    offset = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])[F.col("part")] if offsets else F.lit(0)
    running = F.sum("n").over(W.partitionBy("part").orderBy(c).rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    return values.select(c, (offset + running + (F.col("n") + 1) / 2).alias(f"r_{c}"))


def rank_correlation(df: DataFrame, a: str, b: str) -> float:
    """Spearman correlation with average ranks for ties; rows with a null do not count."""
    both = df.select(a, b).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.join(_mid_ranks(both, a), a).join(_mid_ranks(both, b), b).agg(F.corr(f"r_{a}", f"r_{b}")).first()[0]


def area_deciles(nodes: DataFrame) -> DataFrame:
    """(decile, nodes, area_min, area_max, mean_degree, mean_adjusted, relative_degree, relative_adjusted) of (node, area, degree, f).

    Ten groups of equal count by area, smallest first, the first groups one larger where ten does not
    divide; equal areas in the order of node; relative means are against all nodes.
    """
    from terralane.operators.relational import numbered

    n = nodes.count()
    k = min(10, max(1, n))
    small, extra = divmod(n, k)
    at = F.col("at")
    group = F.when(at < extra * (small + 1), F.floor(at / (small + 1))).otherwise(extra + F.floor((at - extra * (small + 1)) / max(1, small))) + 1
    ranked = numbered(nodes.select("area", "node", "degree", "f"), ["area", "node"], "at").withColumn("decile", group.cast("int"))
    adjusted = F.col("f") * F.col("degree")
    whole = nodes.agg(F.avg("degree"), F.avg(adjusted)).first()
    means = ranked.groupBy("decile").agg(F.count(F.lit(1)).alias("nodes"), F.min("area").alias("area_min"), F.max("area").alias("area_max"), F.avg("degree").alias("mean_degree"), F.avg(adjusted).alias("mean_adjusted"))
    ratio = lambda c, m: (F.col(c) / m if m else F.lit(None).cast("double"))
    return means.withColumn("relative_degree", ratio("mean_degree", whole[0])).withColumn("relative_adjusted", ratio("mean_adjusted", whole[1]))


def concentration(scores: DataFrame) -> dict[str, float | None]:
    """Shares of the summed centrality that the best 10 and the best 100 nodes hold."""
    total = scores.agg(F.sum("centrality")).first()[0]
    top = [r[0] for r in scores.select("centrality").orderBy(F.col("centrality").desc()).limit(100).collect()]
    return {f"top{k}_share": sum(top[:k]) / total if total else None for k in (10, 100)}


def reweighted(edges: DataFrame, nodes: DataFrame, coefficients: DataFrame, decay: float) -> DataFrame:
    """New weights for known routes (src, src_cluster, dst, dst_cluster, d): nothing but the decay changed."""
    pairs = edges.select("src", "dst", "src_cluster", "dst_cluster").join(coefficients.select("src", "dst", "a"), ["src", "dst"])
    return graph_edges(pairs, nodes, edges.select("src", "src_cluster", "dst", "dst_cluster", "d"), decay)


def strongest_parent(edges: DataFrame, rings: DataFrame) -> DataFrame:
    """(node, parent, w): of every node in a ring the strongest link to the ring before; ties to the smaller parent."""
    a = rings.select(F.col("node").alias("u"), F.col("depth").alias("du"))
    b = rings.select(F.col("node").alias("v"), F.col("depth").alias("dv"))
    both = edges.select("u", "v", "w").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "w"))
    links = both.join(a, "u").join(b, "v").filter("dv = du + 1")
    ranked = links.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy(F.col("w").desc(), "u"))).filter("n = 1")
    return ranked.select(F.col("v").alias("node"), F.col("u").alias("parent"), "w")
