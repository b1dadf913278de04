"""Transaction matrices in long form (src, dst, value): coefficients, graphs, balancing, aggregation.

Everything whose size grows with the number of sectors squared stays a DataFrame.  Three kernels are
sequential by nature (acyclic subgraphs, feasibility, repair); they run on the driver over matrices of
at most MAX_SECTORS sectors, and refuse larger ones.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralane.session import cut

MAX_SECTORS = 400


def technical_coefficients(z: DataFrame, x: DataFrame) -> DataFrame:
    """(src, dst, a): flow per unit of the buyer's output; outputs that are not positive are an error."""
    checked = x.select(F.col("sector").alias("dst"), F.when(F.col("x") > 0, F.col("x").cast("double")).otherwise(F.raise_error(F.lit("output must be positive"))).alias("x"))
    return z.join(checked, "dst").select("src", "dst", (F.col("value").cast("double") / F.col("x")).alias("a"))


def economic_edges(z: DataFrame, x: DataFrame) -> DataFrame:
    """(src, dst, value, a) for every positive flow; self-loops stay."""
    a = technical_coefficients(z, x)
    return z.filter("value > 0").join(a, ["src", "dst"]).select("src", "dst", F.col("value").cast("double").alias("value"), "a")


def aggregate(z: DataFrame, x: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flows and outputs of sector groups; ``mapping`` is (code, grp) and keeps totals."""
    from terralane.operators.relational import block_sum

    flows = block_sum(z, mapping).select(F.col("src_group").alias("src"), F.col("dst_group").alias("dst"), "value")
    totals = x.join(mapping.withColumnRenamed("code", "sector"), "sector").groupBy(F.col("grp").alias("sector")).agg(F.sum("x").alias("x"))
    return flows, totals


#: Cells up to which balancing runs in one task; more iterate as joins.
LOCAL_CELLS = 4_000_000


def balanced(src: np.ndarray, dst: np.ndarray, value: np.ndarray, rows: np.ndarray, columns: np.ndarray, absolute: float, relative: float, most: int) -> tuple[np.ndarray, int]:
    """(values, steps) of cells scaled by rows, then columns, until all sums are within the tolerances."""
    def off() -> bool:
        gaps = [(np.bincount(at, value, len(target)), target) for at, target in ((src, rows), (dst, columns))]
        return any((np.abs(have - target) > absolute + relative * np.abs(target)).any() for have, target in gaps)

    for step in range(most + 1):
        if not off():
            return value, step
        if step == most:
            break
        for at, target in ((src, rows), (dst, columns)):
            have = np.bincount(at, value, len(target))
            if ((target > 0) & (have <= 0)).any():
                raise ValueError("a positive margin has no cell that could hold it")
            value = value * np.divide(target, have, out=np.zeros(len(target)), where=have > 0)[at]
    raise ValueError(f"the margins were not met within {most} steps")


def ras(z: DataFrame, rows: DataFrame, columns: DataFrame, absolute: float = 1e-8, relative: float = 1e-10, most: int = 10_000, local_cells: int = LOCAL_CELLS, every: int = 5) -> DataFrame:
    """(src, dst, value, steps): cells scaled to the margins (code, target), rows then columns, until all are met.

    A sum is met within ``absolute`` + ``relative`` times its target.  Cells that are zero stay so; a
    positive target without cells is an error, as are ``most`` steps without meeting the margins.
    """
    cells = cut(z.select("src", "dst", F.col("value").cast("double").alias("value")))
    sides = [cut(m.select(F.col("code").alias("code"), F.col("target").cast("double").alias("target"))) for m in (rows, columns)]
    if cells.limit(local_cells + 1).count() <= local_cells and all(m.limit(local_cells + 1).count() <= local_cells for m in sides):
        every_row = cells.select("src", "dst", "value").unionByName(sides[0].select(F.col("code").alias("src"), F.lit(None).cast("string").alias("dst"), F.col("target").alias("value")))
        every_row = every_row.unionByName(sides[1].select(F.lit(None).cast("string").alias("src"), F.col("code").alias("dst"), F.col("target").alias("value")))

        def run(batches):
            pdf = pd.concat([b.to_pandas() for b in batches] or [pd.DataFrame({"src": [], "dst": [], "value": []})])
            cell, row, column = pdf[pdf["src"].notna() & pdf["dst"].notna()], pdf[pdf["dst"].isna()], pdf[pdf["src"].isna()]
            names = [pd.Index(sorted(set(m[k]) | set(cell[k]))) for m, k in ((row, "src"), (column, "dst"))]
            targets = [m.set_index(k)["value"].reindex(names[i], fill_value=0.0).to_numpy(float) for i, (m, k) in enumerate(((row, "src"), (column, "dst")))]
            value, steps = balanced(names[0].get_indexer(cell["src"]), names[1].get_indexer(cell["dst"]), cell["value"].to_numpy(float), *targets, absolute, relative, most)
            yield pa.RecordBatch.from_pydict({"src": cell["src"].tolist(), "dst": cell["dst"].tolist(), "value": value, "steps": np.full(len(cell), steps, np.int32)}, schema=pa.schema([("src", pa.string()), ("dst", pa.string()), ("value", pa.float64()), ("steps", pa.int32())]))

        return every_row.coalesce(1).mapInArrow(run, "src string, dst string, value double, steps int")
    margins = [("src", sides[0].withColumnRenamed("code", "src")), ("dst", sides[1].withColumnRenamed("code", "dst"))]
    state = cells
    for k in range(most + 1):
        if k % every == 0:
            state = cut(state)
            worst = 0
            for key, margin in margins:
                have = margin.join(state.groupBy(key).agg(F.sum("value").alias("have")), key, "left")
                gap = F.abs(F.coalesce("have", F.lit(0.0)) - F.col("target")) > absolute + relative * F.abs("target")
                if have.filter("target > 0 AND coalesce(have, 0) <= 0").limit(1).count():
                    raise ValueError("a positive margin has no cell that could hold it")
                worst += have.filter(gap).limit(1).count()
            if not worst:
                return state.withColumn("steps", F.lit(k))
        for key, margin in margins:
            sums = state.groupBy(key).agg(F.sum("value").alias("have"))
            scale = sums.join(margin, key, "left").select(key, F.when(F.col("have") > 0, F.coalesce("target", F.lit(0.0)) / F.col("have")).otherwise(0.0).alias("scale"))
            state = state.join(scale, key).select("src", "dst", (F.col("value") * F.col("scale")).alias("value"))
    raise ValueError(f"the margins were not met within {most} steps")


def _edges(z: DataFrame) -> list[tuple[str, str, float]]:
    rows = z.filter("value > 0").select("src", "dst", F.col("value").cast("double")).limit(MAX_SECTORS * MAX_SECTORS + 1).collect()
    if len(rows) > MAX_SECTORS * MAX_SECTORS:
        raise ValueError(f"more than {MAX_SECTORS} sectors; aggregate first")
    return [tuple(r) for r in rows]


def fast_acyclic(edges: list[tuple[str, str, float]]) -> list[tuple[str, str, float]]:
    """Edges kept when taken by (-weight, src, dst), each unless it closes a cycle; self-loops go."""
    out: dict[str, set[str]] = {}
    kept = []
    for src, dst, w in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if src == dst:
            continue
        seen, stack, closes = {dst}, [dst], False
        while stack and not closes:
            for nxt in out.get(stack.pop(), ()):
                if nxt == src:
                    closes = True
                    break
                if nxt not in seen:
                    seen.add(nxt)
                    stack.append(nxt)
        if not closes:
            out.setdefault(src, set()).add(dst)
            kept.append((src, dst, w))
    return kept


def exact_acyclic(edges: list[tuple[str, str, float]]) -> list[tuple[str, str, float]]:
    """The acyclic edge set of the greatest weight: the best order of at most 16 sectors by subsets."""
    nodes = sorted({e[0] for e in edges} | {e[1] for e in edges})
    n = len(nodes)
    if n > 16:
        raise ValueError("the exact form takes at most 16 sectors")
    at = {v: i for i, v in enumerate(nodes)}
    w = [[0.0] * n for _ in range(n)]
    for a, b, v in edges:
        if a != b:
            w[at[a]][at[b]] += v
    best = [float("-inf")] * (1 << n)
    last = [-1] * (1 << n)
    best[0] = 0.0
    for s in range(1 << n):
        if best[s] == float("-inf"):
            continue
        for v in range(n):
            if not s >> v & 1:
                gain = best[s] + sum(w[u][v] for u in range(n) if s >> u & 1)
                if gain > best[s | 1 << v]:
                    best[s | 1 << v], last[s | 1 << v] = gain, v
    order, s = [], (1 << n) - 1
    while s:
        order.append(last[s])
        s ^= 1 << last[s]
    rank = {nodes[v]: i for i, v in enumerate(reversed(order))}
    return sorted(e for e in edges if e[0] != e[1] and rank[e[0]] < rank[e[1]])


def acyclic_edges(z: DataFrame, exact: bool = False) -> DataFrame:
    """(src, dst, value) of the maximum-weight acyclic part of a matrix."""
    edges = _edges(z)
    kept = exact_acyclic(edges) if exact else fast_acyclic(edges)
    return z.sparkSession.createDataFrame(kept, "src string, dst string, value double")


def feasible(support: set[tuple[str, str]], rows: dict[str, float], columns: dict[str, float], tolerance: float = 1e-9) -> bool:
    """Whether margins can be met on a support: a maximum flow carries the whole total."""
    total = sum(rows.values())
    if abs(total - sum(columns.values())) > tolerance * max(1.0, total):
        return False
    cap: dict[tuple, float] = {}
    links: dict[object, set] = {}

    def arc(a, b, c):
        cap[(a, b)] = cap.get((a, b), 0.0) + c
        cap.setdefault((b, a), 0.0)
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)

    for r, v in rows.items():
        arc("S", ("r", r), v)
    for c, v in columns.items():
        arc(("c", c), "T", v)
    for r, c in support:
        if r in rows and c in columns:
            arc(("r", r), ("c", c), float("inf"))
    sent = 0.0
    eps = tolerance * max(1.0, total) / max(1, len(cap))
    while True:
        parent, queue = {"S": None}, deque(["S"])
        while queue and "T" not in parent:
            a = queue.popleft()
            for b in links.get(a, ()):
                if b not in parent and cap[(a, b)] > eps:
                    parent[b] = a
                    queue.append(b)
        if "T" not in parent:
            return sent >= total * (1 - tolerance) - eps * len(cap)
        push, b = float("inf"), "T"
        while parent[b] is not None:
            push, b = min(push, cap[(parent[b], b)]), parent[b]
        b = "T"
        while parent[b] is not None:
            cap[(parent[b], b)] -= push
            cap[(b, parent[b])] += push
            b = parent[b]
        sent += push


def repaired_support(edges: list[tuple[str, str, float]]) -> tuple[set[tuple[str, str]], list[tuple[str, str]]]:
    """(support, restored): acyclic part and diagonal plus the shortest run of removed edges, heaviest
    first, on which the original margins can be met."""
    rows: dict[str, float] = {}
    columns: dict[str, float] = {}
    for a, b, v in edges:
        rows[a] = rows.get(a, 0.0) + v
        columns[b] = columns.get(b, 0.0) + v
    kept = {(a, b) for a, b, _ in fast_acyclic(edges)} | {(a, b) for a, b, _ in edges if a == b}
    removed = [(a, b) for a, b, _ in sorted(edges, key=lambda e: (-e[2], e[0], e[1])) if (a, b) not in kept]
    low, high = 0, len(removed)
    while low < high:
        mid = (low + high) // 2
        if feasible(kept | set(removed[:mid]), rows, columns):
            high = mid
        else:
            low = mid + 1
    return kept | set(removed[:low]), removed[:low]


def hierarchical_sectors(leaves: DataFrame, min_places: int) -> DataFrame:
    """Sector keys of a three-level hierarchy from the support of its leaves.

    ``leaves``: (leaf, middle, top, n).  A leaf with at least ``min_places`` stands alone; the other
    leaves of a middle group with separate leaves form ``middle:OTHER`` if together they reach the
    bound, a middle group without separate leaves stands whole if it reaches it; what remains of a top
    group is ``top:REST``.  Result: (leaf, key, level).
    """
    by_middle, by_top = ["middle", "top"], ["top"]
    from pyspark.sql import Window as W

    alone = F.col("n") >= min_places
    rest = F.sum(F.when(~alone, F.col("n")).otherwise(0)).over(W.partitionBy(*by_middle))
    separate = F.max(alone.cast("int")).over(W.partitionBy(*by_middle))
    key = F.when(alone, F.concat(F.lit("leaf:"), "leaf")).when((F.col("rest") >= min_places) & (F.col("separate") == 1), F.concat(F.lit("middle:"), "middle", F.lit(":OTHER")))
    key = key.when(F.col("rest") >= min_places, F.concat(F.lit("middle:"), "middle")).otherwise(F.concat(F.lit("top:"), "top", F.lit(":REST")))
    return leaves.withColumn("rest", rest).withColumn("separate", separate).select("leaf", key.alias("key"), F.substring_index(key, ":", 1).alias("level"))


def sparse_key(top: str, middle: str, leaf: str):
    """``top:middle:leaf`` cut at the first missing part; a missing part below a present one is ``o``."""
    t, m, v = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (top, middle, leaf))
    return F.when(t == "", F.lit("")).when((m == "") & (v == ""), t).when(m == "", F.concat(t, F.lit(":o"))).when(v == "", F.concat(t, F.lit(":"), m)).otherwise(F.concat_ws(":", t, m, v))


def consistency(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(side, key) of the keys only one side has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").select(F.lit("left").alias("side"), key).unionByName(b.join(a, key, "left_anti").select(F.lit("right").alias("side"), key))


def reconciliation(fine: DataFrame, coarse: DataFrame, mapping: DataFrame, relative: float) -> DataFrame:
    """Per cell of ``coarse`` the aggregated value of ``fine``, the difference and whether it is accepted."""
    from terralane.operators.relational import block_sum

    up = block_sum(fine, mapping).select(F.col("src_group").alias("src"), F.col("dst_group").alias("dst"), F.col("value").cast("double").alias("built"))
    both = coarse.select("src", "dst", F.col("value").cast("double").alias("given")).join(up, ["src", "dst"], "full_outer").fillna(0.0, ["given", "built"])
    gap = F.abs(F.col("given") - F.col("built"))
    return both.select("src", "dst", "given", "built", (gap <= relative * F.greatest(F.abs("given"), F.abs("built"))).alias("accepted"))


def effective_coefficients(built: DataFrame, given: DataFrame) -> DataFrame:
    """(src, dst, a): the coefficients given explicitly, the built ones elsewhere."""
    both = built.join(given.select("src", "dst", F.col("a").alias("g")), ["src", "dst"], "full_outer")
    return both.select("src", "dst", F.coalesce("g", "a").alias("a"))


def assignment_status(places: DataFrame, keys: DataFrame) -> DataFrame:
    """(id, key, status) of places (id, leaf, middle, top) under sector keys (leaf, key, middle, top).

    A known leaf takes its leaf's key (EXACT); a place known by its middle or top group only takes the
    key if all leaves of the group share it (WHOLE), STRADDLES otherwise; NONE without any code.
    """
    def one(level: str) -> DataFrame:
        g = keys.groupBy(level).agg(F.countDistinct("key").alias(f"n_{level}"), F.min("key").alias(f"k_{level}"))
        return g

    joined = places
    for level in ("leaf", "middle", "top"):
        joined = joined.join(one(level), level, "left")
    status = F.when(F.col("k_leaf").isNotNull(), "EXACT")
    key = F.when(F.col("k_leaf").isNotNull(), F.col("k_leaf"))
    for level in ("middle", "top"):
        have = F.col(f"k_{level}").isNotNull()
        status = status.when(have & (F.col(f"n_{level}") == 1), "WHOLE").when(have, "STRADDLES")
        key = key.when(have & (F.col(f"n_{level}") == 1), F.col(f"k_{level}")).when(have, F.lit(None))
    return joined.select("id", key.alias("key"), status.otherwise("NONE").alias("status"))
