"""Queries over places and networks: reconciliation, lookups, provinces, lattice roads."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.functions.text import institution_key
from terralane.operators import clustering as cl
from terralane.operators import network as nw
from terralane.operators import reconcile as rc
from terralane.session import table as t

SIDE, GAP = 14, 100.0


def source(s, d, name):
    p = name.split("_")[0]
    rows = t(s, d, name).groupBy("source_id").agg(F.min(F.struct("rec_id", f"{p}_name", f"{p}_category", f"{p}_lon", f"{p}_lat", "upstream_license", "overture_providers")).alias("r"))
    return rows.select(F.col("source_id").alias("id"), F.col(f"r.{p}_name").alias("name"), F.col(f"r.{p}_category").alias("category"), F.col(f"r.{p}_lon").alias("lon"), F.col(f"r.{p}_lat").alias("lat"), F.col("r.upstream_license").alias("license"), F.col("r.overture_providers").alias("providers"))


def pair(s, d):
    return source(s, d, "osm_places"), source(s, d, "overture_places")


def j12(s, d):
    registry = t(s, d, "registry_qc_official_sources").select(F.col("rec_id").alias("id"), institution_key("name").alias("key"), F.lower(F.trim("city")).alias("city"))
    records = t(s, d, "philhealth_level3").select(F.col("rec_id").alias("id"), institution_key("name_of_health_facility").alias("key"), F.lower(F.trim("municipality")).alias("city"))
    return rc.registry_match(records, registry)


def lines(s):
    """A lattice of straight roads, one way per row and per column."""
    grid = s.range(SIDE * SIDE).select(F.floor(F.col("id") / SIDE).alias("a"), (F.col("id") % SIDE).alias("seq"))
    rows = grid.select(F.concat(F.lit("r"), "a").alias("way"), "seq", (F.col("seq") * GAP).alias("x"), (F.col("a") * GAP).alias("y"))
    return rows.unionByName(grid.select(F.concat(F.lit("c"), "a").alias("way"), "seq", (F.col("a") * GAP).alias("x"), (F.col("seq") * GAP).alias("y")))


def lattice(s):
    return nw.network_from_lines(lines(s))


def spots(s, d):
    """Parts as points near the lattice: position from the key."""
    return t(s, d, "part").select(F.col("p_partkey").alias("id"), ((F.col("p_partkey") * 37) % 1300 + 0.25).alias("x"), ((F.col("p_partkey") * 53) % 1290 + 7.0).alias("y"))


def snapped(s, d):
    v, a = lattice(s)
    return nw.snap(spots(s, d), a, v, 60.0), v, a


def roads(s, d):
    """A network over the localities: per province a way through its localities from west to east, and one through all from south to north."""
    k = 111_195.0
    mid = lambda c: (F.col(f"min_{c}") + F.col(f"max_{c}")) / 2
    spots = t(s, d, "area_localities").select("province", (mid("lon") * F.cos(F.radians(F.lit(9.0))) * k).alias("x"), (mid("lat") * k).alias("y"), F.col("locality_id").alias("seq"), mid("lon").alias("lon"), mid("lat").alias("lat"))
    along = spots.select(F.concat(F.lit("p"), F.coalesce("province", F.lit(""))).alias("way"), F.row_number().over(W.partitionBy("province").orderBy("lon", "seq")).alias("seq"), "x", "y")
    # as many rows as there are localities
    across = spots.select(F.lit("all").alias("way"), F.row_number().over(W.partitionBy(F.lit(1)).orderBy("lat", "seq")).alias("seq"), "x", "y")
    return nw.network_from_lines(along.unionByName(across))


def on_roads(s, d):
    """Places of the second source snapped to the roads over the localities."""
    from terralane.plans.classes import spots as metres

    v, a = roads(s, d)
    rows = metres(s, d)
    on = nw.snap(rows.select("id", "x", "y"), a, v, 30_000.0)
    return on.join(rows.select("id", "type"), "id"), v, a


def c06(s, d):
    on, v, a = on_roads(s, d)
    return cl.cluster_on_network(on.select("type", "id", "u", "v", "offset"), a, v, 40_000.0, 4, 2).select("type", "id", "cluster", F.round("membership", 6).alias("membership"))


def n06_roads(s, d):
    on, v, a = on_roads(s, d)
    return nw.neighbour_graph(a, on.select("type", "id", "u", "v", "offset"), 4_000.0, v, by="type").select("type", "a", "b", F.round("d", 3).alias("d"))


def n03(s, d):
    on, _, a = snapped(s, d)
    parts = nw.split_arcs(a, on)
    return parts.groupBy("u", "v").agg(F.count(F.lit(1)).alias("parts"), F.round(F.sum("length"), 6).alias("length"))


def n04(s, d):
    _, a = lattice(s)
    return nw.distances(a, s.createDataFrame([(0,), (45,)], "node long")).select("source", "node", "d")


def n07(s, d):
    v, a = lattice(s)
    demand = v.filter("id % 11 = 3").select((F.col("id") % 3).alias("cluster"), F.col("id").alias("node"), F.lit(1.0).alias("weight"))
    return nw.one_median(nw.distances(a, demand.select("node")), demand)


def n09(s, d):
    _, a = lattice(s)
    centers = s.createDataFrame([(5, 1), (100, 2), (190, 3)], "node long, cluster int")
    return nw.nearest_owner(nw.distances(a, centers.select("node")), centers)


def n11(s, d):
    e = t(s, d, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey") % 200).alias("u"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("v")).distinct()
    return nw.ego_network(e, "p7", 2)


QUERIES = {
    "j01_candidate_pairs": lambda s, d: rc.candidate_pairs(*pair(s, d)).select("left_id", "right_id", F.round("meters", 3).alias("meters"), F.round("score", 6).alias("score")),
    "j02_one_to_one": lambda s, d: rc.one_to_one(rc.candidate_pairs(*pair(s, d))).select("left_id", "right_id"),
    "j03_reconcile": lambda s, d: rc.reconciled(*pair(s, d)),
    "j08_provinces": lambda s, d: rc.provinces(t(s, d, "area_localities")),
    "j09_snap": lambda s, d: snapped(s, d)[0].select("id", F.round("distance", 6).alias("distance")),
    "j12_registry_match": j12,
    "j16_layered": lambda s, d: rc.layered(j12(s, d), j12(s, d).filter("id % 2 = 0")),
    "n01_vertices": lambda s, d: lattice(s)[0],
    "n01_arcs": lambda s, d: lattice(s)[1],
    "n02_components": lambda s, d: nw.components(lattice(s)[0], lattice(s)[1].filter("NOT (u < 70 AND v >= 70)")),
    "n03_split_arcs": n03,
    "n04_distances": n04,
    "n06_neighbour_graph": lambda s, d: (lambda on, v, a: nw.neighbour_graph(a, on.select("id", "u", "v", "offset"), 150.0))(*snapped(s, d)).select("a", "b", F.round("d", 6).alias("d")),
    "n06_neighbours_on_roads": n06_roads,
    "c06_network_clusters": c06,
    "n07_one_median": n07,
    "n09_nearest_owner": n09,
    "n11_ego_network": n11,
}

_LAT = f"g AS (SELECT i * {SIDE} + j AS id, i * {GAP} AS x, j * {GAP} AS y, i, j FROM range({SIDE}) a(i), range({SIDE}) b(j))"
_KEY = "trim(regexp_replace(replace(replace(replace(replace(' ' || trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({c}, ''))), '[''’]', '', 'g'), '[^a-z0-9]+', ' ', 'g')) || ' ', ' es ', ' elementary school '), ' nhs ', ' national high school '), ' hs ', ' high school '), ' st ', ' saint '), ' (inc|corp|incorporated|corporation) $', ''))"
_J12 = f"""p AS (SELECT rec_id AS id, {_KEY.format(c='name_of_health_facility')} AS key, lower(trim(municipality)) AS city FROM philhealth_level3), r AS (SELECT rec_id AS entry, {_KEY.format(c='name')} AS key, lower(trim(city)) AS entry_city FROM registry_qc_official_sources),
 c AS (SELECT id, count(DISTINCT CASE WHEN coalesce(city, '') = '' OR coalesce(entry_city, '') = '' OR city = entry_city THEN entry END) AS good, count(DISTINCT entry) AS n FROM p LEFT JOIN r ON p.key = r.key AND r.key <> '' GROUP BY 1),
 m AS (SELECT id, CASE WHEN n = 0 THEN 'NONE' WHEN good = 1 THEN 'MATCH' WHEN good > 1 THEN 'AMBIGUOUS' ELSE 'CONFLICT' END AS status, n FROM c)"""
#: Parts snapped to the lattice: the nearer of the two kinds of roads, never at the same distance.
_SNAP = f"""sp AS (SELECT p_partkey AS id, p_partkey * 37 % 1300 + 0.25 AS x, p_partkey * 53 % 1290 + 7.0 AS y FROM part), sd AS (SELECT *, abs(x - round(x / {GAP}) * {GAP}) AS dx, abs(y - round(y / {GAP}) * {GAP}) AS dy FROM sp),
 sn AS (SELECT id, CAST(CASE WHEN dx < dy THEN round(x / {GAP}) * {SIDE} + floor(y / {GAP}) ELSE floor(x / {GAP}) * {SIDE} + round(y / {GAP}) END AS BIGINT) AS u, CAST(CASE WHEN dx < dy THEN round(x / {GAP}) * {SIDE} + floor(y / {GAP}) + 1 ELSE (floor(x / {GAP}) + 1) * {SIDE} + round(y / {GAP}) END AS BIGINT) AS v, CASE WHEN dx < dy THEN y - floor(y / {GAP}) * {GAP} ELSE x - floor(x / {GAP}) * {GAP} END AS o, least(dx, dy) AS distance FROM sd)"""
ORACLE = {
    "n03_split_arcs": f"WITH {_LAT}, {_SNAP}, ar AS (SELECT a.id AS u, b.id AS v FROM g a JOIN g b ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)) SELECT ar.u, ar.v, count(DISTINCT o) + 1 AS parts, CAST({GAP} AS DOUBLE) AS length FROM ar LEFT JOIN sn ON sn.u = ar.u AND sn.v = ar.v AND o > 0 AND o < {GAP} GROUP BY 1, 2",
    "j08_provinces": "SELECT province, count(*) AS localities, array_to_string(list_sort(list(DISTINCT psgc)), '|') AS codes, min(min_lon) AS min_lon, min(min_lat) AS min_lat, max(max_lon) AS max_lon, max(max_lat) AS max_lat FROM area_localities GROUP BY 1",
    "j12_registry_match": f"WITH {_J12} SELECT * FROM m",
    "j16_layered": f"WITH {_J12} SELECT id, CASE WHEN status = 'MATCH' AND id % 2 = 0 THEN 'AMBIGUOUS' ELSE status END AS status FROM m",
    "j09_snap": f"WITH p AS (SELECT p_partkey AS id, p_partkey * 37 % 1300 + 0.25 AS x, p_partkey * 53 % 1290 + 7.0 AS y FROM part) SELECT id, CAST(round(least(abs(x - round(x / {GAP}) * {GAP}), abs(y - round(y / {GAP}) * {GAP})), 6) AS DOUBLE) AS distance FROM p",
    "n01_vertices": f"WITH {_LAT} SELECT CAST(id AS BIGINT) AS id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM g",
    "n01_arcs": f"WITH {_LAT} SELECT a.id AS u, b.id AS v, CAST({GAP} AS DOUBLE) AS length FROM g a JOIN g b ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)",
    "n02_components": f"WITH {_LAT} SELECT id, CAST(CASE WHEN id < 70 THEN 0 ELSE 70 END AS BIGINT) AS component FROM g",
    "n04_distances": f"WITH {_LAT} SELECT a.id AS source, b.id AS node, CAST((abs(a.i - b.i) + abs(a.j - b.j)) * {GAP} AS DOUBLE) AS d FROM g a, g b WHERE a.id IN (0, 45)",
    "n07_one_median": f"WITH {_LAT}, c AS (SELECT m.id % 3 AS cluster, b.id AS node, sum((abs(m.i - b.i) + abs(m.j - b.j)) * {GAP}) AS cost FROM g m, g b WHERE m.id % 11 = 3 GROUP BY 1, 2) SELECT cluster, node, CAST(cost AS DOUBLE) AS cost FROM c QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY cost, node) = 1",
    "n09_nearest_owner": f"WITH {_LAT}, k AS (SELECT * FROM (VALUES (5, 1), (100, 2), (190, 3)) v(c, cluster)) SELECT b.id AS node, cluster, CAST((abs(a.i - b.i) + abs(a.j - b.j)) * {GAP} AS DOUBLE) AS d FROM g b, k JOIN g a ON a.id = c QUALIFY row_number() OVER (PARTITION BY b.id ORDER BY d, cluster) = 1",
    "n11_ego_network": "WITH e AS (SELECT DISTINCT 'p' || (l_partkey % 200) AS u, 's' || l_suppkey AS v FROM lineitem), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), r1 AS (SELECT DISTINCT v AS node FROM b WHERE u = 'p7'), r2 AS (SELECT DISTINCT v AS node FROM b WHERE u IN (SELECT node FROM r1) AND v <> 'p7' AND v NOT IN (SELECT node FROM r1)), a AS (SELECT 'p7' AS node, 0 AS depth UNION ALL SELECT node, 1 FROM r1 UNION ALL SELECT node, 2 FROM r2) SELECT node, depth, (SELECT count(*) FROM a) > 300 AS truncated FROM a QUALIFY row_number() OVER (ORDER BY depth, node) <= 300",
}
