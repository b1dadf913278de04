"""Economy and graph queries on the nations' flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from terralane.operators import economy as ec
from terralane.operators import graph as gr
from terralane.operators.relational import numbered
from terralane.plans.base import X_SQL, Z_SQL, code, outputs, transactions
from terralane.session import table as t

DECAY, GAMMA = 0.5, 0.4


def regions(s, d):
    return t(s, d, "nation").select(code("n_nationkey").alias("code"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("grp"))


def points(s, d):
    """Customers as points of their nation's clusters: one cluster per market segment."""
    segments = numbered(t(s, d, "customer").select("c_mktsegment").distinct(), ["c_mktsegment"], "cluster").select("c_mktsegment", F.col("cluster").cast("int").alias("cluster"))
    return t(s, d, "customer").join(segments, "c_mktsegment").select(F.col("c_custkey").alias("id"), code("c_nationkey").alias("type"), "cluster", F.abs(F.col("c_acctbal")).alias("distance"))


def clusters(s, d):
    return gr.cluster_shares(points(s, d))


def x_edges(s, d):
    edges = ec.economic_edges(transactions(s, d), outputs(s, d)).select("src", "dst", "a")
    nodes = clusters(s, d)
    cells = nodes.select("type", "cluster", F.col("cluster").alias("cell"))
    pairs = gr.overlapping(cells, edges)
    place = lambda k, c: F.col(k).cast("int") * 100 + F.col(c) * 7
    distances = pairs.select("src", "src_cluster", "dst", "dst_cluster", F.abs(place("src", "src_cluster") - place("dst", "dst_cluster")).cast("double").alias("d"))
    return gr.graph_edges(pairs, nodes, distances, DECAY)


def uvw(s, d):
    name = lambda k, c: F.concat(F.col(k), F.lit("/"), F.col(c).cast("string"))
    return x_edges(s, d).select(name("src", "src_cluster").alias("u"), name("dst", "dst_cluster").alias("v"), (F.col("w") * 2e4).alias("w"))


def nodes(s, d):
    return clusters(s, d).select(F.concat("type", F.lit("/"), F.col("cluster").cast("string")).alias("node"))


def centrality(s, d):
    return gr.balanced_katz(uvw(s, d), nodes(s, d)).select("node", "centrality")


def x14(s, d):
    p = points(s, d).select("id", F.concat("type", F.lit("/"), F.col("cluster").cast("string")).alias("node"), "distance")
    return gr.inverse_distance_scores(p, centrality(s, d)).select("id", F.round("score", 8).alias("score"))


def x15(s, d):
    p = points(s, d).select("id", F.concat("type", F.lit("/"), F.col("cluster").cast("string")).alias("node"), "distance")
    c = nodes(s, d).select("node", (F.lit(1.0) + F.substring("node", 1, 2).cast("int")).alias("centrality"))
    return gr.tempered_scores(p, c, 0.15).select("id", "node", F.round("p90", 6).alias("p90"), F.round("score", 6).alias("score"))


def areas(s, d):
    return clusters(s, d).select(F.concat("type", F.lit("/"), F.col("cluster").cast("string")).alias("node"), F.col("n").cast("double").alias("area"))


def x12(s, d):
    return gr.balanced_katz(uvw(s, d), nodes(s, d), factors=gr.area_factors(areas(s, d), GAMMA)).select("node", F.round("centrality", 8).alias("centrality"))


def x13_deciles(s, d):
    known = gr.degrees(uvw(s, d), nodes(s, d)).join(areas(s, d), "node").join(gr.area_factors(areas(s, d), GAMMA), "node")
    rows = gr.area_deciles(known.select("node", "area", (F.col("out_degree") + F.col("in_degree")).alias("degree"), "f"))
    return rows.select("decile", "nodes", "area_min", "area_max", *[F.round(c, 9).alias(c) for c in ("mean_degree", "mean_adjusted", "relative_degree", "relative_adjusted")])


def x13_concentration(s, d):
    return one_row(s, {k: round(v, 8) for k, v in gr.concentration(centrality(s, d)).items()})


def e08(s, d):
    z = transactions(s, d)
    rows = z.groupBy(F.col("src").alias("code")).agg((F.sum("value").cast("double") * 1.1).alias("target"))
    columns = outputs(s, d).select(F.col("sector").alias("code"), F.col("x").cast("double").alias("x"))
    total = rows.agg(F.sum("target")).first()[0] / columns.agg(F.sum("x")).first()[0]
    return ec.ras(z, rows, columns.select("code", (F.col("x") * total).alias("target")), 1e-6, 1e-12).select("src", "dst", F.round("value", 2).alias("value"))


def e11(s, d):
    n = t(s, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    leaves = t(s, d, "nation").join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        code("n_nationkey").alias("leaf"), F.concat(F.col("n_regionkey").cast("string"), F.lit("-"), (F.col("n_nationkey") % 3).cast("string")).alias("middle"),
        F.col("n_regionkey").cast("string").alias("top"), F.coalesce("n", F.lit(0)).alias("n"))
    return ec.hierarchical_sectors(leaves, 62)


def q01(s, d):
    """Neighbours of every node: both directions together, the stronger weight, three strongest."""
    from pyspark.sql import Window as W

    e = uvw(s, d).filter("u <> v")
    out = e.select(F.col("u").alias("node"), F.col("v").alias("other"), F.col("w").alias("out_w"))
    into = e.select(F.col("v").alias("node"), F.col("u").alias("other"), F.col("w").alias("in_w"))
    both = out.join(into, ["node", "other"], "full_outer").withColumn("strength", F.round(F.greatest(F.coalesce("out_w", F.lit(0.0)), F.coalesce("in_w", F.lit(0.0))), 9))
    return both.withColumn("rank", F.row_number().over(W.partitionBy("node").orderBy(F.col("strength").desc(), "other"))).filter("rank <= 3").select("node", "other", "strength", "rank")


def one_row(s, values: dict):
    return s.createDataFrame([tuple(values.values())], list(values))


QUERIES = {
    "e01_technical_coefficients": lambda s, d: ec.technical_coefficients(transactions(s, d), outputs(s, d)).select("src", "dst", F.round("a", 12).alias("a")),
    "e03_economic_graph": lambda s, d: ec.economic_edges(transactions(s, d), outputs(s, d)).select("src", "dst", "value", F.round("a", 12).alias("a")),
    "e04_fast_acyclic": lambda s, d: ec.acyclic_edges(transactions(s, d)),
    "e05_exact_acyclic": lambda s, d: ec.acyclic_edges(transactions(s, d).filter("src < '12' AND dst < '12'"), exact=True),
    "e07_support_repair": lambda s, d: s.createDataFrame(sorted(ec.repaired_support(ec._edges(transactions(s, d)))[0]), "src string, dst string"),
    "e08_ras": e08,
    "e10_aggregate_economy": lambda s, d: ec.aggregate(transactions(s, d), outputs(s, d), regions(s, d))[0].select("src", "dst", F.col("value").cast("double").alias("value")),
    "e10_aggregate_output": lambda s, d: ec.aggregate(transactions(s, d), outputs(s, d), regions(s, d))[1].select("sector", F.col("x").cast("double").alias("x")),
    "e11_hierarchical_sectors": e11,
    "e13_sparse_key": lambda s, d: t(s, d, "nation").select("n_nationkey", ec.sparse_key("n_regionkey", "n_nationkey", "n_name").alias("key")),
    "e14_consistency": lambda s, d: ec.consistency(t(s, d, "customer").select(F.col("c_nationkey").alias("k")), t(s, d, "supplier").select(F.col("s_nationkey").alias("k")), "k"),
    "e16_reconciliation": lambda s, d: ec.reconciliation(transactions(s, d), ec.aggregate(transactions(s, d), outputs(s, d), regions(s, d))[0], regions(s, d), 2e-7),
    "x01_cluster_shares": lambda s, d: clusters(s, d).select("type", "cluster", "n", F.round("share", 12).alias("share"), F.round("radius", 6).alias("radius")),
    "x03_edges": lambda s, d: x_edges(s, d).select("src", "src_cluster", "dst", "dst_cluster", "d", F.round(F.col("w") * 1e6, 6).alias("w")),
    "x04_degrees": lambda s, d: gr.degrees(uvw(s, d), nodes(s, d)),
    "x05_undirected": lambda s, d: gr.undirected(uvw(s, d)).select("u", "v", F.round("w", 9).alias("w")),
    "x06_acyclic_test": lambda s, d: one_row(s, {"acyclic": gr.is_acyclic(ec.acyclic_edges(transactions(s, d)).select(F.col("src").alias("u"), F.col("dst").alias("v"))), "cyclic": not gr.is_acyclic(uvw(s, d))}),
    "x07_spectral_radius": lambda s, d: one_row(s, {"radius": round(gr.spectral_radius(uvw(s, d), nodes(s, d)), 8)}),
    "x07_row_sum_bound": lambda s, d: uvw(s, d).groupBy("u").agg(F.sum("w").alias("s")).agg(F.round(F.max("s"), 6).alias("bound")),
    "x08_katz": lambda s, d: gr.katz(uvw(s, d), nodes(s, d)).select("node", F.round("x", 8).alias("x")),
    "x09_balanced_katz": lambda s, d: centrality(s, d).select("node", F.round("centrality", 8).alias("centrality")),
    "x10_eigenvector": lambda s, d: gr.eigenvector(uvw(s, d), nodes(s, d)).select("node", F.round("x", 8).alias("x")),
    "x11_poisson_regression": lambda s, d: one_row(s, gr.poisson_log_area(t(s, d, "part").select("p_size", "p_retailprice"), "p_size", "p_retailprice")),
    "x12_area_adjusted_katz": x12,
    "x13_area_deciles": x13_deciles,
    "x13_concentration": x13_concentration,
    "x13_rank_correlation": lambda s, d: one_row(s, {"rho": round(gr.rank_correlation(t(s, d, "part").select("p_size", "p_retailprice"), "p_size", "p_retailprice"), 9)}),
    "x14_inverse_distance_scores": x14,
    "x15_tempered_scores": x15,
    "q01_strongest_links": q01,
}

_POINTS = "pts AS (SELECT c_custkey AS id, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS type, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS cluster, abs(c_acctbal) AS distance FROM customer)"
_CL = f"{_POINTS}, cl AS (SELECT type, cluster, count(*) AS n, avg(distance) AS radius FROM pts GROUP BY 1, 2), nd AS (SELECT *, n / sum(n) OVER (PARTITION BY type) AS share, type || '/' || cluster AS node FROM cl)"
_EDGES = f"""{Z_SQL}, {X_SQL}, {_CL}, xe AS (SELECT src, s.cluster AS src_cluster, dst, e.cluster AS dst_cluster, CAST(abs(CAST(src AS INTEGER) * 100 + s.cluster * 7 - CAST(dst AS INTEGER) * 100 - e.cluster * 7) AS DOUBLE) AS d,
  CAST(value AS DOUBLE) / CAST(x AS DOUBLE) * s.share * e.share AS q, s.radius AS rs, e.radius AS rt FROM z JOIN xs ON dst = sector JOIN nd s ON src = s.type JOIN nd e ON dst = e.type AND s.cluster = e.cluster WHERE value > 0),
 xw AS (SELECT *, q * pow(greatest(d + rs + rt, 1.0), -{DECAY}) AS w FROM xe WHERE NOT (src = dst AND src_cluster = dst_cluster AND d = 0)),
 uv AS (SELECT src || '/' || src_cluster AS u, dst || '/' || dst_cluster AS v, w * 2e4 AS w FROM xw), uvm AS MATERIALIZED (SELECT * FROM uv)"""


# The iterations as recursive SQL with many more steps than they need: what comes out is the fixed point.
_FAR = 400


def _radius(edges: str) -> str:
    """rho: power iteration on (W / bound + I) / 2 without normalising; the greatest growth of a node, since every part of the graph grows at its own rate."""
    return f"""rb AS (SELECT max(s) AS b FROM (SELECT sum(w) AS s FROM {edges} GROUP BY u)),
 pw AS (SELECT 0 AS i, node, 1.0::DOUBLE AS x FROM nd UNION ALL (SELECT r.i + 1, nd.node, (any_value(o.x) + coalesce(sum(e.w / (SELECT b FROM rb) * p.x), 0)) / 2 FROM (SELECT DISTINCT i FROM pw WHERE i < {_FAR}) r CROSS JOIN nd JOIN pw o ON o.node = nd.node LEFT JOIN {edges} e ON e.u = nd.node LEFT JOIN pw p ON p.node = e.v GROUP BY 1, 2)),
 rho AS MATERIALIZED (SELECT (2 * max(a.x / b.x) - 1) * (SELECT b FROM rb) AS rho FROM pw a JOIN pw b ON a.node = b.node AND a.i = {_FAR} AND b.i = {_FAR - 1})"""


def _katz(edges: str, name: str, at: str, far: str, factor: str = "1.0") -> str:
    """Katz over links from ``far`` to ``at``; the factor is the node's own."""
    return f"{name} AS (SELECT 0 AS i, node, 1.0::DOUBLE AS x FROM nd UNION ALL (SELECT r.i + 1, nd.node, 1.0 + 0.85 / (SELECT rho FROM rho) * any_value({factor}) * coalesce(sum(e.w * p.x), 0) FROM (SELECT DISTINCT i FROM {name} WHERE i < {_FAR}) r CROSS JOIN nd LEFT JOIN {edges} e ON e.{at} = nd.node LEFT JOIN {name} p ON p.node = e.{far} GROUP BY 1, 2))"


def _balanced(edges: str, factor: str = "1.0") -> str:
    return f"{_katz(edges, 'ki', 'v', 'u', factor)}, {_katz(edges, 'ko', 'u', 'v', factor)}, bal AS (SELECT node, g / sqrt(sum(g * g) OVER ()) AS centrality FROM (SELECT ki.node, sqrt(ki.x * ko.x) AS g FROM ki JOIN ko ON ki.node = ko.node AND ki.i = {_FAR} AND ko.i = {_FAR}))"


def _ras() -> str:
    return f"""WITH RECURSIVE {Z_SQL}, {X_SQL}, rt AS (SELECT src, CAST(sum(value) AS DOUBLE) * 1.1 AS target FROM z GROUP BY 1), ct AS (SELECT sector AS dst, CAST(x AS DOUBLE) * (SELECT sum(target) FROM rt) / (SELECT sum(CAST(x AS DOUBLE)) FROM xs) AS target FROM xs),
 m AS (SELECT 0 AS i, src, dst, CAST(value AS DOUBLE) AS value FROM z UNION ALL
  (SELECT i + 1, src, dst, h * ct.target / sum(h) OVER (PARTITION BY dst) FROM (SELECT i, src, dst, value * rt.target / sum(value) OVER (PARTITION BY src) AS h FROM m JOIN rt USING (src) WHERE i < {_FAR}) JOIN ct USING (dst)))
SELECT src, dst, round(value, 2) AS value FROM m WHERE i = {_FAR}"""


def _eigen() -> str:
    return f"""WITH RECURSIVE {_EDGES}, pr AS (SELECT least(u, v) AS u, greatest(u, v) AS v, sum(w) AS w FROM uv GROUP BY 1, 2), bo AS MATERIALIZED (SELECT u, v, w FROM pr UNION ALL SELECT v, u, w FROM pr WHERE u <> v),
 g AS (SELECT 0 AS i, node, 1.0::DOUBLE AS x FROM nd UNION ALL (SELECT i, node, y / sqrt(sum(y * y) OVER ()) FROM (SELECT r.i + 1 AS i, nd.node, any_value(o.x) + coalesce(sum(e.w * p.x), 0) AS y FROM (SELECT DISTINCT i FROM g WHERE i < 4000) r CROSS JOIN nd JOIN g o ON o.node = nd.node LEFT JOIN bo e ON e.v = nd.node LEFT JOIN g p ON p.node = e.u GROUP BY 1, 2)))
SELECT node, round(x, 8) AS x FROM g WHERE i = 4000"""


ORACLE = {
    "e01_technical_coefficients": f"WITH {Z_SQL}, {X_SQL} SELECT src, dst, round(CAST(value AS DOUBLE) / CAST(x AS DOUBLE), 12) AS a FROM z JOIN xs ON dst = sector",
    "e03_economic_graph": f"WITH {Z_SQL}, {X_SQL} SELECT src, dst, CAST(value AS DOUBLE) AS value, round(CAST(value AS DOUBLE) / CAST(x AS DOUBLE), 12) AS a FROM z JOIN xs ON dst = sector WHERE value > 0",
    "e08_ras": _ras(),
    "e10_aggregate_economy": f"WITH {Z_SQL} SELECT 'R' || a.n_regionkey AS src, 'R' || b.n_regionkey AS dst, CAST(sum(value) AS DOUBLE) AS value FROM z JOIN nation a ON CAST(src AS INTEGER) = a.n_nationkey JOIN nation b ON CAST(dst AS INTEGER) = b.n_nationkey GROUP BY 1, 2",
    "e10_aggregate_output": f"WITH {Z_SQL}, {X_SQL} SELECT 'R' || n_regionkey AS sector, CAST(sum(x) AS DOUBLE) AS x FROM xs JOIN nation ON CAST(sector AS INTEGER) = n_nationkey GROUP BY 1",
    "e11_hierarchical_sectors": """WITH l AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS leaf, n_regionkey || '-' || (n_nationkey % 3) AS middle, CAST(n_regionkey AS VARCHAR) AS top, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n FROM nation),
 m AS (SELECT *, sum(CASE WHEN n < 62 THEN n ELSE 0 END) OVER (PARTITION BY middle, top) AS rest, max(CASE WHEN n >= 62 THEN 1 ELSE 0 END) OVER (PARTITION BY middle, top) AS separate FROM l),
 k AS (SELECT leaf, CASE WHEN n >= 62 THEN 'leaf:' || leaf WHEN rest >= 62 AND separate = 1 THEN 'middle:' || middle || ':OTHER' WHEN rest >= 62 THEN 'middle:' || middle ELSE 'top:' || top || ':REST' END AS key FROM m) SELECT leaf, key, split_part(key, ':', 1) AS level FROM k""",
    "e13_sparse_key": "SELECT n_nationkey, n_regionkey || ':' || n_nationkey || ':' || n_name AS key FROM nation",
    "e14_consistency": "WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier) SELECT 'left' AS side, k FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT 'right', k FROM b WHERE k NOT IN (SELECT k FROM a)",
    "e16_reconciliation": f"WITH {Z_SQL} SELECT 'R' || a.n_regionkey AS src, 'R' || b.n_regionkey AS dst, CAST(sum(value) AS DOUBLE) AS given, CAST(sum(value) AS DOUBLE) AS built, true AS accepted FROM z JOIN nation a ON CAST(src AS INTEGER) = a.n_nationkey JOIN nation b ON CAST(dst AS INTEGER) = b.n_nationkey GROUP BY 1, 2",
    "x01_cluster_shares": f"WITH {_CL} SELECT type, cluster, n, round(share, 12) AS share, round(radius, 6) AS radius FROM nd",
    "x03_edges": f"WITH {_EDGES} SELECT src, src_cluster, dst, dst_cluster, d, round(w * 1e6, 6) AS w FROM xw",
    "x04_degrees": f"WITH {_EDGES} SELECT node, (SELECT count(*) FROM uv WHERE u = node) AS out_degree, (SELECT count(*) FROM uv WHERE v = node) AS in_degree FROM nd",
    "x05_undirected": f"WITH {_EDGES} SELECT least(u, v) AS u, greatest(u, v) AS v, round(sum(w), 9) AS w FROM uv WHERE w > 0 GROUP BY 1, 2",
    "x07_row_sum_bound": f"WITH {_EDGES} SELECT round(max(s), 6) AS bound FROM (SELECT sum(w) AS s FROM uv GROUP BY u)",
    "x07_spectral_radius": f"WITH RECURSIVE {_EDGES}, {_radius('uvm')} SELECT round(rho, 8) AS radius FROM rho",
    "x08_katz": f"WITH RECURSIVE {_EDGES}, {_radius('uvm')}, {_katz('uvm', 'k', 'v', 'u')} SELECT node, round(x / sqrt(sum(x * x) OVER ()), 8) AS x FROM k WHERE i = {_FAR}",
    "x09_balanced_katz": f"WITH RECURSIVE {_EDGES}, {_radius('uvm')}, {_balanced('uvm')} SELECT node, round(centrality, 8) AS centrality FROM bal",
    "x10_eigenvector": _eigen(),
    "x12_area_adjusted_katz": f"WITH RECURSIVE {_EDGES}, fw0 AS MATERIALIZED (SELECT u, v, w * pow(CAST(n AS DOUBLE), -{GAMMA}) AS w FROM uv JOIN nd ON u = node), {_radius('fw0')}, {_balanced('uvm', f'pow(CAST(nd.n AS DOUBLE), -{GAMMA})')} SELECT node, round(centrality, 8) AS centrality FROM bal",
    "x13_area_deciles": f"WITH {_EDGES}, dg AS (SELECT node, CAST(n AS DOUBLE) AS area, (SELECT count(*) FROM uv WHERE u = node) + (SELECT count(*) FROM uv WHERE v = node) AS degree, ntile(10) OVER (ORDER BY n, node) AS decile FROM nd), al AS (SELECT avg(degree) AS a, avg(degree * pow(area, -{GAMMA})) AS b FROM dg) SELECT CAST(decile AS INTEGER) AS decile, count(*) AS nodes, min(area) AS area_min, max(area) AS area_max, round(avg(degree), 9) AS mean_degree, round(avg(degree * pow(area, -{GAMMA})), 9) AS mean_adjusted, round(avg(degree) / any_value(a), 9) AS relative_degree, round(avg(degree * pow(area, -{GAMMA})) / any_value(b), 9) AS relative_adjusted FROM dg, al GROUP BY 1",
    "x13_concentration": f"WITH RECURSIVE {_EDGES}, {_radius('uvm')}, {_balanced('uvm')}, o AS (SELECT centrality AS c, row_number() OVER (ORDER BY centrality DESC) AS k FROM bal) SELECT round(sum(CASE WHEN k <= 10 THEN c END) / sum(c), 8) AS top10_share, round(sum(CASE WHEN k <= 100 THEN c END) / sum(c), 8) AS top100_share FROM o",
    "x13_rank_correlation": "WITH r AS (SELECT rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0 AS a, rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0 AS b FROM part) SELECT round(corr(a, b), 9) AS rho FROM r",
    "x14_inverse_distance_scores": f"WITH RECURSIVE {_EDGES}, {_radius('uvm')}, {_balanced('uvm')} SELECT id, round(centrality / greatest(distance, 1.0), 8) AS score FROM pts JOIN bal ON node = type || '/' || cluster",
    "x15_tempered_scores": f"WITH {_POINTS}, p AS (SELECT *, type || '/' || cluster AS node FROM pts), q AS (SELECT node, quantile_cont(distance, 0.9) AS p90 FROM p GROUP BY 1) SELECT id, node, round(p90, 6) AS p90, round((1.0 + CAST(type AS INTEGER)) * (1 - 0.15 * least(distance / greatest(p90, 1.0), 1.0)), 6) AS score FROM p JOIN q USING (node)",
    "q01_strongest_links": f"WITH {_EDGES}, e AS (SELECT * FROM uv WHERE u <> v), b AS (SELECT u AS node, v AS other, w FROM e UNION ALL SELECT v, u, w FROM e), s AS (SELECT node, other, round(max(w), 9) AS strength FROM b GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY node ORDER BY strength DESC, other) AS rank FROM s QUALIFY rank <= 3",
}
