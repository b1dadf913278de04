"""Further queries: mappings, rules, guards, paths, review tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.functions import text as fx
from terralane.operators import economy as ec
from terralane.operators import graph as gr
from terralane.operators import network as nw
from terralane.operators import publish as pb
from terralane.operators import reconcile as rc
from terralane.operators import taxonomy as tx
from terralane.operators.proximity import points_in_regions, positions
from terralane.operators.relational import first_reaching
from terralane.plans import classes, economy, places
from terralane.plans.base import outputs, transactions
from terralane.session import table as t


def bridge(s, d):
    p = t(s, d, "part")
    a = p.select(F.col("p_type").alias("code"), F.concat(F.lit("T-"), "p_type").alias("target"))
    b = p.filter("p_brand LIKE '%1'").select(F.concat_ws("/", "p_type", "p_brand").alias("code"), F.concat(F.lit("B-"), "p_brand").alias("target"))
    return a.unionByName(b).distinct()


def leaf_codes(s, d):
    return t(s, d, "part").select(F.concat_ws("/", "p_type", "p_brand", (F.col("p_size") % 5).cast("string")).alias("code")).distinct()


def t18(s, d):
    return tx.nearest_bridge(leaf_codes(s, d), bridge(s, d), tx.closure(classes.tree(s, d)))


def t23(s, d):
    rules = s.createDataFrame([("55", "any", "shop"), ("85", "all", "amenity"), ("85", "any", "healthcare"), ("85", "any", "brand"), ("47", "all", "shop"), ("47", "all", "opening_hours")], "code string, need string, tag string")
    tags = t(s, d, "osm_places").select(F.col("rec_id").alias("id"), F.explode(fx.tag_pairs("osm_category")).alias("p")).select("id", F.col("p.key").alias("tag"))
    return tx.tag_rules(tags, rules)


def t26(s, d):
    fine = t(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("code"), (F.col("n_nationkey") % 7).cast("string").alias("parent"))
    middle = s.range(7).select(F.col("id").cast("string").alias("code"), (F.col("id") % 2).cast("string").alias("parent"))
    k = F.col("c_custkey")
    rows = t(s, d, "customer").select(k.alias("id"), F.when(k % 3 == 0, F.col("c_nationkey").cast("string")).alias("fine"), F.when(k % 2 == 0, (F.col("c_nationkey") % 7).cast("string")).when(k % 5 == 0, F.lit("6")).alias("middle"), F.when(k % 7 == 0, F.lit("1")).alias("coarse"))
    return tx.level_guard(rows, fine, middle)


def n05(s, d):
    _, a = places.lattice(s)
    return nw.shortest_path(a, nw.distances(a, s.createDataFrame([(0,)], "node long")), 0, 55)


def snk08(s, d):
    parts = t(s, d, "lineitem").select(F.col("l_orderkey").alias("edge"), F.col("l_linenumber").alias("seq"), F.col("l_quantity").alias("length")).groupBy("edge", "seq").agg(F.sum("length").alias("length"))
    w = W.partitionBy("edge").orderBy("seq")
    parts = parts.withColumn("i", F.row_number().over(w)).select("edge", "seq", (F.col("edge") * 10 + F.col("i")).alias("u"), (F.col("edge") * 10 + F.col("i") + 1).alias("v"), "length")
    return nw.contracted(parts, parts.filter("u % 3 = 0").select(F.col("u").alias("node")))


def x16(s, d):
    coefficients = ec.technical_coefficients(transactions(s, d), outputs(s, d))
    return gr.reweighted(economy.x_edges(s, d), economy.clusters(s, d), coefficients, 1.25).select("src", "src_cluster", "dst", "dst_cluster", F.round(F.col("w") * 1e9, 6).alias("w"))


def c01(s, d):
    pairs = t(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).agg(F.min(F.col("l_quantity")).alias("d"))
    return first_reaching(pairs.withColumn("one", F.lit(1)), ["a"], ["d", "b"], "one", F.lit(7), "d", "core")


def c02(s, d):
    core = c01(s, d)
    pairs = t(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 100 + 1).alias("b")).agg(F.min("l_quantity").alias("d"))
    return pairs.join(core, "a").join(core.select(F.col("a").alias("b"), F.col("core").alias("cb")), "b").select("a", "b", F.greatest("core", "cb", "d").alias("m"))


def c17(s, d):
    """Cluster keys that stand on one side only of two tables that should agree."""
    a = t(s, d, "customer").select(F.col("c_nationkey").alias("type"), "c_mktsegment")
    b = a.filter("NOT (type = 3 AND c_mktsegment = 'BUILDING')")
    left, right = a.distinct(), b.distinct()
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def q06(s, d):
    tiles = pb.tile_summaries(pb_typed(s, d), [9])
    return tiles.filter("tx BETWEEN 425 AND 432 AND ty BETWEEN 240 AND 245").groupBy("tx", "ty").agg(F.sum("n").alias("n"))


def pb_typed(s, d):
    return t(s, d, "overture_places").select(F.col("overture_category").alias("type"), F.col("overture_lon").alias("lon"), F.col("overture_lat").alias("lat"))


def q09(s, d):
    spots = positions(t(s, d, "places").filter("canonical_name IS NOT NULL"))
    chosen = t(s, d, "area_localities").filter("area_slug IN ('kekevel', 'subekas')")
    return points_in_regions(spots, chosen).groupBy("locality_id").agg(F.count(F.lit(1)).alias("n"))


def q10(s, d):
    e = t(s, d, "lineitem").groupBy(F.concat(F.lit("p"), F.col("l_partkey") % 200).alias("u"), F.concat(F.lit("s"), "l_suppkey").alias("v")).agg(F.sum("l_quantity").alias("w"))
    return gr.strongest_parent(e, places.n11(s, d))


def q13(s, d):
    k = fx.fold("osm_name")
    rows = t(s, d, "osm_places").filter("osm_lon IS NOT NULL").select(k.alias("name"), F.substring_index("osm_category", "=", 1).alias("kind"), F.floor(F.col("osm_lon") / 0.5).alias("gx"), F.floor(F.col("osm_lat") / 0.5).alias("gy"), "rec_id")
    return rows.groupBy("kind", "name", "gx", "gy").agg(F.min("rec_id").alias("rec_id"))


def a01(s, d):
    """Review rows joined with the official entry of their key, with one status per relation and a priority."""
    official = t(s, d, "registry_qc_official_sources").select(fx.institution_key("name").alias("key"), fx.fold("city").alias("town"), "rec_id").filter("key <> ''").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("town").alias("town"))
    rows = t(s, d, "philhealth_level3").select("rec_id", fx.institution_key("name_of_health_facility").alias("key"), fx.fold("municipality").alias("city"))
    joined = rows.join(official, "key", "left")
    name = F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "single").otherwise("several")
    place = F.when(F.col("n").isNull() | (F.col("city") == "") | (F.col("town") == ""), "unknown").when(F.col("city") == F.col("town"), "same").otherwise("other")
    priority = F.when((name == "several") & (place == "other"), 1).when(place == "other", 2).when(name == "several", 3).otherwise(4)
    return joined.select("rec_id", name.alias("name_relation"), place.alias("place_relation"), priority.alias("priority"))


def a04(s, d):
    rows = t(s, d, "registry_qc_official_sources").select("source_id", "name", "ownership")
    return rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("ownership") == "public").cast("long")).alias("public"), F.array_join(F.array_sort(F.collect_set("name")), " | ").alias("names"))


def w01(s, d):
    """Fingerprint of a table: schema and an order-free digest of its rows."""
    p = t(s, d, "part")
    return p.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.conv(F.substring(F.sha2(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type"), 256), 1, 12), 16, 10).cast("decimal(38,0)")).cast("string").alias("digest"))


def j04(s, d):
    a, b = places.pair(s, d)
    return rc.augmented(a.select("id", "name", "lon", "lat", F.lit(2).alias("source_count")), b.select("id", "name", "lon", "lat"))


def j10(s, d):
    on, _, _ = places.snapped(s, d)
    return nw.distinct_positions(on)


QUERIES = {
    "j04_augment": j04,
    "j07_boundary_clip": lambda s, d: points_in_regions(positions(t(s, d, "places")), t(s, d, "area_localities")).select("rec_id").distinct(),
    "j10_distinct_positions": j10,
    "j17_verified_links": lambda s, d: t(s, d, "registry_qc_official_sources").select("source", "source_id", "rec_id").join(t(s, d, "registry_qc_official_sources").groupBy("source", "source_id").agg(F.min("rec_id").alias("first_id")), ["source", "source_id"]).select("rec_id", "first_id"),
    "t03_level_report": lambda s, d: tx.level_report(classes.tree(s, d), tx.closure(classes.tree(s, d))),
    "t09_automatic_mapping": lambda s, d: tx.automatic_mapping(classes.retrieved(s, d, 2)),
    "t12_subtree_sets": lambda s, d: tx.subtree_sets(s.createDataFrame([(1, "PROMO"), (2, "LARGE/Brand#11")], "id int, code string"), s.createDataFrame([(1, "PROMO/Brand#12"), (2, "SMALL/Brand#13")], "id int, code string"), tx.closure(classes.tree(s, d))),
    "t18_nearest_bridge": t18,
    "t19_map_union": lambda s, d: tx.map_union(classes.baskets(s, d).select("id", "code"), t18(s, d)),
    "t23_tag_rules": t23,
    "t26_level_guard": t26,
    "t27_coverage": lambda s, d: tx.coverage(t(s, d, "osm_places"), ["osm_operator", "osm_website", "osm_address", "osm_city"]),
    "e06_feasibility": lambda s, d: economy.one_row(s, {"full": ec.feasible({("a", "x"), ("b", "y")}, {"a": 1.0, "b": 2.0}, {"x": 1.0, "y": 2.0}), "short": ec.feasible({("a", "x"), ("b", "x")}, {"a": 1.0, "b": 2.0}, {"x": 1.0, "y": 2.0})}),
    "n05_shortest_path": n05,
    "snk08_contract": snk08,
    "x16_reweighted": x16,
    "c01_core_distances": c01,
    "c02_mutual_reachability": c02,
    "c17_key_differences": c17,
    "q04_connections": lambda s, d: economy.q01(s, d).filter("node = '00/0'").orderBy("rank").limit(10).select("other", "strength"),
    "q05_sector_strength": lambda s, d: economy.uvw(s, d).groupBy(F.substring_index("v", "/", 1).alias("sector")).agg(F.round(F.max("w"), 9).alias("strength")),
    "q06_visible_tiles": q06,
    "q09_places_in_partitions": q09,
    "q10_strongest_parent": q10,
    "q13_labels": q13,
    "a01_review_rows": a01,
    "a04_candidates_per_id": a04,
    "w01_table_fingerprint": w01,
}

from terralane.plans.classes import _BASKET, _TREE  # noqa: E402
from terralane.plans.economy import _EDGES  # noqa: E402
from terralane.plans.places import _KEY, _SNAP  # noqa: E402
from terralane.plans.publishing import _MX, _MY  # noqa: E402

_FOLD = "trim(regexp_replace(strip_accents(replace(lower(CASE WHEN lower(trim(coalesce({c}, ''))) IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown') THEN '' ELSE trim({c}) END), '&', ' and ')), '[^a-z0-9]+', ' ', 'g'))"
_T18 = "br AS (SELECT DISTINCT c AS code, CASE WHEN split_part(b, '/', 2) LIKE '%1' THEN b ELSE a END AS via, CASE WHEN split_part(b, '/', 2) LIKE '%1' THEN 'B-' || split_part(b, '/', 2) ELSE 'T-' || a END AS target FROM leaf)"
_C01 = "cp AS (SELECT l_suppkey AS a, l_partkey AS b, min(l_quantity) AS d FROM lineitem GROUP BY 1, 2), co AS (SELECT a, min(CASE WHEN n >= 7 THEN d END) AS core FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS n FROM cp) GROUP BY 1)"
ORACLE = {
    "j17_verified_links": "SELECT rec_id, min(rec_id) OVER (PARTITION BY source, source_id) AS first_id FROM registry_qc_official_sources WHERE source IS NOT NULL AND source_id IS NOT NULL",
    "j10_distinct_positions": f"WITH {_SNAP} SELECT id, CAST(dense_rank() OVER (ORDER BY u, v, o) AS INTEGER) AS position, first_value(id) OVER (PARTITION BY u, v, o ORDER BY distance, id) AS representative FROM sn",
    "q04_connections": f"WITH {_EDGES}, e AS (SELECT * FROM uv WHERE u <> v), b AS (SELECT u AS node, v AS other, w FROM e UNION ALL SELECT v, u, w FROM e) SELECT other, round(max(w), 9) AS strength FROM b WHERE node = '00/0' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
    "snk08_contract": "WITH p AS (SELECT l_orderkey AS edge, l_linenumber AS seq, sum(l_quantity) AS length FROM lineitem GROUP BY 1, 2), q AS (SELECT *, edge * 10 + row_number() OVER (PARTITION BY edge ORDER BY seq) AS u FROM p), r AS (SELECT *, sum(CASE WHEN u % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY edge ORDER BY seq) AS g FROM q) SELECT edge, CAST(g AS BIGINT) AS g, min(u) AS u, max(u) + 1 AS v, sum(length) AS length FROM r GROUP BY 1, 2",
    "t03_level_report": f"WITH {_TREE} SELECT 0 AS level, count(DISTINCT a) AS codes, 0 AS leaves FROM leaf UNION ALL SELECT 1, count(DISTINCT b), 0 FROM leaf UNION ALL SELECT 2, count(DISTINCT c), count(DISTINCT c) FROM leaf",
    "t12_subtree_sets": f"WITH {_TREE}, l AS (SELECT 1 AS id, code FROM paths WHERE ancestor = 'PROMO' UNION SELECT 2, code FROM paths WHERE ancestor = 'LARGE/Brand#11'), r AS (SELECT 1 AS id, code FROM paths WHERE ancestor = 'PROMO/Brand#12' UNION SELECT 2, code FROM paths WHERE ancestor = 'SMALL/Brand#13') SELECT coalesce(l.id, r.id) AS id, coalesce(l.code, r.code) AS code, CASE WHEN l.id IS NOT NULL AND r.id IS NOT NULL THEN 'both' WHEN l.id IS NOT NULL THEN 'left' ELSE 'right' END AS relation FROM l FULL JOIN r ON l.id = r.id AND l.code = r.code",
    "t18_nearest_bridge": f"WITH {_TREE}, {_T18} SELECT * FROM br",
    "t19_map_union": f"WITH {_TREE}, {_T18}, {_BASKET} SELECT id, array_to_string(list_sort(list(DISTINCT target)), '; ') AS targets FROM bk JOIN br ON bk.c = br.code GROUP BY 1",
    "t23_tag_rules": "WITH g AS (SELECT DISTINCT rec_id AS id, split_part(p, '=', 1) AS tag FROM (SELECT rec_id, unnest(string_split_regex(osm_category, '\\s*\\|\\s*')) AS p FROM osm_places) WHERE contains(p, '=')), h AS (SELECT id, bool_or(tag = 'shop') AS sh, bool_or(tag = 'amenity') AS am, bool_or(tag IN ('healthcare', 'brand')) AS hb, bool_or(tag = 'opening_hours') AS oh FROM g GROUP BY 1), k AS (SELECT id, list_filter([CASE WHEN sh THEN '55' END, CASE WHEN am AND hb THEN '85' END, CASE WHEN sh AND oh THEN '47' END], lambda x: x IS NOT NULL) AS c FROM h) SELECT id, CASE WHEN len(c) = 1 THEN c[1] END AS code, CASE WHEN len(c) = 0 THEN 'NONE' WHEN len(c) = 1 THEN 'RULE' ELSE 'CONFLICT' END AS status FROM k",
    "t26_level_guard": "WITH r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS fine, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey % 7 AS VARCHAR) WHEN c_custkey % 5 = 0 THEN '6' END AS middle, CASE WHEN c_custkey % 7 = 0 THEN '1' END AS coarse, c_nationkey FROM customer), u AS (SELECT *, CASE WHEN fine IS NOT NULL THEN CAST(c_nationkey % 7 AS VARCHAR) END AS fu FROM r), m AS (SELECT *, coalesce(fu, middle) AS mm FROM u), c AS (SELECT *, CASE WHEN mm IS NOT NULL THEN CAST(CAST(mm AS INTEGER) % 2 AS VARCHAR) END AS mu FROM m), k AS (SELECT *, coalesce(fu <> middle, false) OR coalesce(mu <> coarse, false) AS clash FROM c) SELECT id, fine, CASE WHEN clash THEN middle ELSE mm END AS middle, CASE WHEN clash THEN coarse ELSE coalesce(mu, coarse) END AS coarse, CASE WHEN clash THEN 'CONFLICT' ELSE 'OK' END AS status FROM k",
    "t27_coverage": " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN trim(coalesce({c}, '')) <> '' THEN 1 ELSE 0 END) AS BIGINT) AS filled, count(*) AS total FROM osm_places" for c in ("osm_operator", "osm_website", "osm_address", "osm_city")),
    "e06_feasibility": "SELECT true AS full, false AS short",
    "x16_reweighted": f"WITH {_EDGES} SELECT src, src_cluster, dst, dst_cluster, round(q * pow(greatest(d + rs + rt, 1.0), -1.25) * 1e9, 6) AS w FROM xe WHERE NOT (src = dst AND src_cluster = dst_cluster AND d = 0)",
    "c01_core_distances": f"WITH {_C01} SELECT a, core FROM co",
    "c02_mutual_reachability": f"WITH {_C01}, p AS (SELECT l_suppkey AS a, l_partkey % 100 + 1 AS b, min(l_quantity) AS d FROM lineitem GROUP BY 1, 2) SELECT p.a, p.b, greatest(x.core, y.core, d) AS m FROM p JOIN co x ON x.a = p.a JOIN co y ON y.a = p.b",
    "c17_key_differences": "SELECT DISTINCT c_nationkey AS type, c_mktsegment, 'left' AS side FROM customer WHERE c_nationkey = 3 AND c_mktsegment = 'BUILDING'",
    "q05_sector_strength": f"WITH {_EDGES} SELECT split_part(v, '/', 1) AS sector, round(max(w), 9) AS strength FROM uv GROUP BY 1",
    "q06_visible_tiles": f"SELECT {_MX.format(n=512)} AS tx, {_MY.format(n=512)} AS ty, CAST(count(*) AS BIGINT) AS n FROM overture_places WHERE overture_lon IS NOT NULL GROUP BY 1, 2 HAVING tx BETWEEN 425 AND 432 AND ty BETWEEN 240 AND 245",
    "q10_strongest_parent": "WITH e AS (SELECT 'p' || (l_partkey % 200) AS u, 's' || l_suppkey AS v, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2), b AS (SELECT u, v, w FROM e UNION ALL SELECT v, u, w FROM e), r1 AS (SELECT DISTINCT v AS node FROM b WHERE u = 'p7'), r2 AS (SELECT DISTINCT v AS node FROM b WHERE u IN (SELECT node FROM r1) AND v <> 'p7' AND v NOT IN (SELECT node FROM r1)), a AS (SELECT 'p7' AS node, 0 AS depth UNION ALL SELECT node, 1 FROM r1 UNION ALL SELECT node, 2 FROM r2) SELECT b.v AS node, b.u AS parent, b.w FROM b JOIN a x ON x.node = b.u JOIN a y ON y.node = b.v WHERE y.depth = x.depth + 1 QUALIFY row_number() OVER (PARTITION BY b.v ORDER BY b.w DESC, b.u) = 1",
    "q13_labels": f"SELECT split_part(osm_category, '=', 1) AS kind, {_FOLD.format(c='osm_name')} AS name, CAST(floor(osm_lon / 0.5) AS BIGINT) AS gx, CAST(floor(osm_lat / 0.5) AS BIGINT) AS gy, min(rec_id) AS rec_id FROM osm_places WHERE osm_lon IS NOT NULL GROUP BY 1, 2, 3, 4",
    "a01_review_rows": f"WITH o AS (SELECT {_KEY.format(c='name')} AS key, count(*) AS n, min({_FOLD.format(c='city')}) AS town FROM registry_qc_official_sources GROUP BY 1), p AS (SELECT rec_id, {_KEY.format(c='name_of_health_facility')} AS key, {_FOLD.format(c='municipality')} AS city FROM philhealth_level3), j AS (SELECT rec_id, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'single' ELSE 'several' END AS nr, CASE WHEN n IS NULL OR city = '' OR town = '' THEN 'unknown' WHEN city = town THEN 'same' ELSE 'other' END AS pr FROM p LEFT JOIN o ON p.key = o.key AND o.key <> '') SELECT rec_id, nr AS name_relation, pr AS place_relation, CASE WHEN nr = 'several' AND pr = 'other' THEN 1 WHEN pr = 'other' THEN 2 WHEN nr = 'several' THEN 3 ELSE 4 END AS priority FROM j",
    "a04_candidates_per_id": "SELECT source_id, count(*) AS n, CAST(sum(CASE WHEN ownership = 'public' THEN 1 WHEN ownership IS NOT NULL THEN 0 END) AS BIGINT) AS public, coalesce(array_to_string(list_sort(list(DISTINCT name) FILTER (name IS NOT NULL)), ' | '), '') AS names FROM registry_qc_official_sources GROUP BY 1",
    "w01_table_fingerprint": "SELECT count(*) AS rows, CAST(sum(CAST(('0x' || substr(sha256(concat_ws('|', CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type)), 1, 12)) AS HUGEINT)) AS VARCHAR) AS digest FROM part",
}
