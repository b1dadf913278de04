"""Queries of the remaining small operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from terralane.operators import economy as ec
from terralane.operators import network as nw
from terralane.operators import publish as pb
from terralane.operators import taxonomy as tx
from terralane.plans import economy, places
from terralane.plans.base import outputs, transactions
from terralane.session import table as t
from terralane.sources import readers as rd


def e12(s, d):
    n = t(s, d, "nation")
    keys = economy.e11(s, d).select("leaf", "key").join(n.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("leaf"), F.concat(F.col("n_regionkey").cast("string"), F.lit("-"), (F.col("n_nationkey") % 3).cast("string")).alias("middle"), F.col("n_regionkey").cast("string").alias("top")), "leaf")
    c = t(s, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    rows = c.select(k.alias("id"), F.when(k % 4 == 0, F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("leaf"), F.when(k % 4 == 1, F.concat(F.col("n_regionkey").cast("string"), F.lit("-"), (F.col("n_nationkey") % 3).cast("string"))).alias("middle"), F.when(k % 4 == 2, F.col("n_regionkey").cast("string")).alias("top"))
    return ec.assignment_status(rows, keys)


def e02(s, d):
    built = ec.technical_coefficients(transactions(s, d), outputs(s, d)).filter("src <> '03'")
    given = built.filter("src = '05'").select("src", "dst", (F.col("a") * 2).alias("a")).union(s.createDataFrame([("03", "03", 0.25)], "src string, dst string, a double"))
    return ec.effective_coefficients(built, given).select("src", "dst", F.round("a", 12).alias("a"))


def n08(s, d):
    _, a = places.lattice(s)
    centers = s.createDataFrame([(0, 5), (1, 100)], "cluster int, source long")
    reach = nw.distances(a, centers.select(F.col("source").alias("node")))
    points = t(s, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 2).cast("int").alias("cluster"), (F.col("p_partkey") * 3 % 196).alias("node"))
    return points.join(centers, "cluster").join(reach, ["source", "node"]).select("id", "cluster", "d")


def n12(s, d):
    _, a = places.lattice(s)
    reach = nw.distances(a, s.createDataFrame([(0,)], "node long"))
    return nw.distance_violations(reach.withColumn("d", F.when(F.col("node") % 50 == 7, F.col("d") + 1).otherwise(F.col("d"))), reach).select("node", "stated", "d")


def snk07(s, d):
    v, a = places.lattice(s)
    path = nw.shortest_path(a, nw.distances(a, s.createDataFrame([(0,)], "node long")), 0, 29).select(F.lit("r").alias("route"), "seq", "node")
    return pb.route_geometry(path, v).select("route", F.size("points").alias("points"))


def t07(s, d):
    rules = s.createDataFrame([("store", "G"), ("hardware_store", "G47"), ("clinic", "Q"), ("restaurant", "I"), ("service", "S"), ("school", "P"), ("station", "G46")], "pattern string, target string")
    return tx.longest_rule(t(s, d, "overture_places").select(F.col("rec_id").alias("id"), F.col("overture_category").alias("key")), rules)


def t20(s, d):
    decide = lambda k: k.withColumn("code", F.when(F.col("p_type").like("%O%"), F.concat("p_type", F.lit("-"), F.substring("p_brand", -1, 1))))
    return tx.by_distinct_key(t(s, d, "part").select("p_partkey", "p_type", "p_brand"), ["p_type", "p_brand"], decide).select("p_partkey", "code")


def t24(s, d):
    a = F.when(F.col("p_size") % 3 > 0, F.substring("p_type", 1, 1))
    b = F.when(F.col("p_size") % 4 > 0, F.when(F.col("p_size") % 5 == 0, "X").otherwise(F.substring("p_type", 1, 1)))
    code, status = tx.hybrid(a, b, F.col("p_size") == 7)
    return t(s, d, "part").select("p_partkey", code.alias("code"), status.alias("status"))


def t31(s, d):
    """Coverage of a fixed level: places per sector and the share with a sector."""
    rows = t(s, d, "places").select(F.coalesce(F.regexp_extract("io240_codes", "([0-9]{3})", 1), F.lit("")).alias("sector"))
    return rows.groupBy("sector").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "src10_utm_zone": lambda s, d: t(s, d, "osm_places").filter("osm_lon IS NOT NULL").select("rec_id", rd.utm_zone(F.col("osm_lon"), F.col("osm_lat")).alias("epsg")),
    "snk07_route_geometry": snk07,
    "n08_point_distances": n08,
    "n12_distance_violations": n12,
    "e02_effective_coefficients": e02,
    "e12_assignment_status": e12,
    "t07_longest_rule": t07,
    "t20_by_distinct_key": t20,
    "t24_hybrid": t24,
    "t31_level_coverage": t31,
    "a03_id_relation": lambda s, d: t(s, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.when(F.col("o_orderstatus") == "F", F.substring("o_orderpriority", 1, 1))).alias("a"), F.collect_set(F.when(F.col("o_orderstatus") == "O", F.substring("o_orderpriority", 1, 1))).alias("b")).select("o_custkey", pb.id_relation(F.col("a"), F.col("b")).alias("relation")),
}

from terralane.plans.base import X_SQL, Z_SQL  # noqa: E402
from terralane.plans.economy import ORACLE as _ECONOMY  # noqa: E402

ORACLE = {
    "src10_utm_zone": "SELECT rec_id, CAST(CASE WHEN osm_lat >= 0 THEN 32600 ELSE 32700 END + floor((osm_lon + 180) / 6) + 1 AS INTEGER) AS epsg FROM osm_places WHERE osm_lon IS NOT NULL",
    "snk07_route_geometry": "SELECT 'r' AS route, 4 AS points",
    "n08_point_distances": "WITH p AS (SELECT p_partkey AS id, CAST(p_partkey % 2 AS INTEGER) AS cluster, p_partkey * 3 % 196 AS node, CASE WHEN p_partkey % 2 = 0 THEN 5 ELSE 100 END AS c FROM part) SELECT id, cluster, CAST((abs(node // 14 - c // 14) + abs(node % 14 - c % 14)) * 100 AS DOUBLE) AS d FROM p",
    "n12_distance_violations": "SELECT CAST(n AS BIGINT) AS node, CAST((n // 14 + n % 14) * 100 + 1 AS DOUBLE) AS stated, CAST((n // 14 + n % 14) * 100 AS DOUBLE) AS d FROM range(196) r(n) WHERE n % 50 = 7",
    "e02_effective_coefficients": f"WITH {Z_SQL}, {X_SQL} SELECT src, dst, round(CAST(value AS DOUBLE) / CAST(x AS DOUBLE) * CASE WHEN src = '05' THEN 2 ELSE 1 END, 12) AS a FROM z JOIN xs ON dst = sector WHERE src <> '03' UNION ALL SELECT '03', '03', 0.25",
    "e12_assignment_status": f"""WITH k0 AS ({_ECONOMY['e11_hierarchical_sectors']}), n AS (SELECT n_nationkey, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS leaf, n_regionkey || '-' || (n_nationkey % 3) AS middle, CAST(n_regionkey AS VARCHAR) AS top FROM nation), k AS (SELECT n.*, key FROM k0 JOIN n USING (leaf)),
 g AS (SELECT c_custkey AS id, c_custkey % 4 AS r, n.* FROM customer JOIN n ON c_nationkey = n_nationkey),
 v AS (SELECT id, r, CASE r WHEN 0 THEN (SELECT min(key) FROM k WHERE k.leaf = g.leaf) WHEN 1 THEN (SELECT min(key) FROM k WHERE k.middle = g.middle) WHEN 2 THEN (SELECT min(key) FROM k WHERE k.top = g.top) END AS key, CASE r WHEN 1 THEN (SELECT count(DISTINCT key) FROM k WHERE k.middle = g.middle) WHEN 2 THEN (SELECT count(DISTINCT key) FROM k WHERE k.top = g.top) ELSE 1 END AS m FROM g)
 SELECT id, CASE WHEN m = 1 THEN key END AS key, CASE WHEN r = 3 THEN 'NONE' WHEN r = 0 THEN 'EXACT' WHEN m = 1 THEN 'WHOLE' ELSE 'STRADDLES' END AS status FROM v""",
    "t07_longest_rule": "SELECT rec_id AS id, CASE WHEN overture_category = 'hardware_store' THEN 'G47' WHEN overture_category LIKE '%\\_store' ESCAPE '\\' THEN 'G' WHEN overture_category LIKE '%\\_clinic' ESCAPE '\\' THEN 'Q' WHEN overture_category LIKE '%\\_restaurant' ESCAPE '\\' THEN 'I' WHEN overture_category LIKE '%\\_service' ESCAPE '\\' THEN 'S' WHEN overture_category LIKE '%\\_school' ESCAPE '\\' THEN 'P' WHEN overture_category LIKE '%\\_station' ESCAPE '\\' THEN 'G46' END AS target, CASE WHEN overture_category = 'hardware_store' THEN 'hardware_store' ELSE nullif(regexp_extract(overture_category, '_(store|clinic|restaurant|service|school|station)$', 1), '') END AS pattern FROM overture_places",
    "t20_by_distinct_key": "SELECT p_partkey, CASE WHEN p_type LIKE '%O%' THEN p_type || '-' || right(p_brand, 1) END AS code FROM part",
    "t24_hybrid": "WITH v AS (SELECT p_partkey, p_size, CASE WHEN p_size % 3 > 0 THEN left(p_type, 1) END AS a, CASE WHEN p_size % 4 > 0 THEN CASE WHEN p_size % 5 = 0 THEN 'X' ELSE left(p_type, 1) END END AS b FROM part) SELECT p_partkey, CASE WHEN p_size = 7 OR a <> b THEN NULL ELSE coalesce(a, b) END AS code, CASE WHEN p_size = 7 THEN 'BLOCKED' WHEN a = b THEN 'AGREE' WHEN a <> b THEN 'DISAGREE' WHEN a IS NOT NULL THEN 'FIRST' WHEN b IS NOT NULL THEN 'SECOND' ELSE 'NONE' END AS status FROM v",
    "t31_level_coverage": "SELECT coalesce(regexp_extract(io240_codes, '([0-9]{3})', 1), '') AS sector, count(*) AS n FROM places GROUP BY 1",
    "a03_id_relation": "WITH g AS (SELECT o_custkey, coalesce(list_sort(list(DISTINCT substr(o_orderpriority, 1, 1)) FILTER (o_orderstatus = 'F')), []) AS a, coalesce(list_sort(list(DISTINCT substr(o_orderpriority, 1, 1)) FILTER (o_orderstatus = 'O')), []) AS b FROM orders GROUP BY 1) SELECT o_custkey, CASE WHEN len(a) = 0 AND len(b) = 0 THEN 'none' WHEN len(a) = 0 OR len(b) = 0 THEN 'one-sided' WHEN a = b THEN 'equal' ELSE 'different' END AS relation FROM g",
}
