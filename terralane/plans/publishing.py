"""Queries of the readers, the publication steps and the viewer."""

from __future__ import annotations

from pyspark.sql import functions as F

from terralane.operators import publish as pb
from terralane.session import table as t
from terralane.sources import readers as rd
from terralane.streaming.windows import windowed_counts

BOX = (120.0, 8.0, 123.0, 11.0)


def tags(s, d):
    """Tags of the places of the first source as a map, from their category text, name and operator.

    So that every rule has cases, the keys of some rows are replaced by ones that occur less.
    """
    parts = F.filter(F.split(F.coalesce("osm_category", F.lit("")), r" \| "), lambda p: F.instr(p, "=") > 0)
    key = {0: "public_transport", 1: "historic", 2: "railway", 3: "aeroway"}
    rare = F.create_map(*[F.lit(x) for kv in key.items() for x in kv])[(F.col("rec_id") % 11).cast("int")]
    renamed = F.transform(parts, lambda p: F.struct(F.coalesce(F.when(F.substring_index(p, "=", 1) == "shop", rare), F.substring_index(p, "=", 1)).alias("k"), F.when(rare == "railway", "subway_entrance").when(rare == "aeroway", "heliport").otherwise(F.substring_index(p, "=", -1)).alias("v")))
    more = F.array(F.struct(F.lit("name").alias("k"), F.col("osm_name").alias("v")), F.struct(F.lit("operator").alias("k"), F.col("osm_operator").alias("v")))
    entries = F.filter(F.concat(renamed, more), lambda e: e["v"].isNotNull())
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda o: o["k"]), e["k"]) == i + 1)
    return t(s, d, "osm_places").select("rec_id", F.map_from_entries(first).alias("tags"))


DATASETS = ["meta", "All The Places/2024", "foursquare_places", "unheard of", "PinMeTo", ""]


def sourced(s, d):
    """One or two source items per place: datasets in several writings, licences stated or not."""
    p = t(s, d, "overture_places")
    item = F.struct(F.element_at(F.array(*[F.lit(x) for x in DATASETS]), (F.col("rec_id") % 6 + 1).cast("int")).alias("dataset"), F.lit(None).cast("string").alias("provider"), F.when(F.col("rec_id") % 4 > 0, F.lower("upstream_license")).alias("license"))
    second = F.struct(F.lit(None).cast("string").alias("dataset"), F.lit("Bright Query").alias("provider"), F.when(F.col("rec_id") % 5 == 0, "CC0 1.0").alias("license"))
    items = F.when(F.col("rec_id") % 13 == 0, F.array().cast("array<struct<dataset:string,provider:string,license:string>>")).when(F.col("rec_id") % 3 == 0, F.array(item, second)).otherwise(F.array(item))
    return p.select("rec_id", items.alias("items"))


def legacy(s, d):
    names = F.transform(F.split(F.coalesce("overture_providers", F.lit("")), r"[;|]"), lambda v: F.when(F.col("rec_id") % 3 == 0, v).when(F.col("rec_id") % 3 == 1, "Pin Me To").otherwise("All_The_Places!"))
    return t(s, d, "overture_places").select("rec_id", F.when(F.col("rec_id") % 7 > 0, names).alias("providers"))


def typed(s, d):
    return t(s, d, "overture_places").select(F.col("rec_id").alias("id"), F.col("overture_category").alias("type"), F.col("overture_lon").alias("lon"), F.col("overture_lat").alias("lat"))


def snk01(s, d):
    scores = t(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("node"), F.col("o_totalprice").alias("score")).dropDuplicates(["id"])
    audit = scores.select("id", (F.col("id") % 2).cast("int").alias("flag"))
    return pb.published_points(scores, t(s, d, "customer").select(F.col("c_custkey").alias("node"), F.col("c_acctbal").alias("centrality")), audit)


def snk12(s, d):
    edges = t(s, d, "lineitem").select(F.col("l_suppkey").alias("u"), (F.col("l_partkey") % 100).alias("v"), F.col("l_quantity").alias("w")).distinct()
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct().select("node", F.col("node").alias("pos"))
    return pb.adjacency_shards(edges, nodes)


def snk16(s, d):
    a = t(s, d, "part").filter("p_partkey % 7 <> 0").select("p_partkey", F.when(F.col("p_size") > 5, F.col("p_brand")).alias("label"), F.col("p_retailprice").alias("score"))
    b = t(s, d, "part").filter("p_partkey % 11 <> 0").select("p_partkey", F.when(F.col("p_size") > 9, F.when(F.col("p_size") == 20, F.lit("other")).otherwise(F.col("p_brand"))).alias("label"), F.when(F.col("p_partkey") % 13 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("score"))
    return pb.snapshot_changes(a, b, "p_partkey", "label", "score")


QUERIES = {
    "src02_poi_predicate": lambda s, d: tags(s, d).select("rec_id", rd.is_poi(F.col("tags")).alias("poi")),
    "src03_category_text": lambda s, d: tags(s, d).select("rec_id", rd.category_text(F.col("tags")).alias("category")),
    "src04_scan": lambda s, d: rd.scan_places(t(s, d, "overture_places"), BOX, "overture_name", "overture_lon", "overture_lat", "source_id")[0].select("rec_id"),
    "src04_reasons": lambda s, d: rd.scan_places(t(s, d, "overture_places"), BOX, "overture_name", "overture_lon", "overture_lat", "source_id")[1],
    "src05_primary_name": lambda s, d: t(s, d, "osm_places").select("rec_id", rd.primary_name(F.struct(F.col("osm_operator").alias("primary"), F.create_map(F.lit("en"), F.col("osm_name")).alias("common"))).alias("name")),
    "src06_category_list": lambda s, d: t(s, d, "overture_places").select("rec_id", rd.category_list(F.col("overture_category"), F.array(F.replace(F.col("overture_category"), F.lit("_"), F.lit(" ")), F.lit("shop")), F.lit("place")).alias("categories")),
    "src07_license_status": lambda s, d: sourced(s, d).select("rec_id", rd.source_decision(F.col("items")).alias("x")).select("rec_id", "x.*"),
    "src08_legacy_terms": lambda s, d: legacy(s, d).select("rec_id", rd.legacy_terms(F.col("providers")).alias("terms"), rd.legacy_allowed(F.col("providers")).alias("allowed")),
    "snk01_published_points": snk01,
    "snk04_type_counts": lambda s, d: t(s, d, "overture_places").groupBy(F.col("overture_category").alias("type")).agg(F.count(F.lit(1)).alias("n")),
    "snk09_tile_summaries": lambda s, d: pb.tile_summaries(typed(s, d), [6, 9, 11]).select("zoom", "tx", "ty", "type", "n", F.round("lon", 11).alias("lon"), F.round("lat", 11).alias("lat")),
    "snk10_zoom_sample": lambda s, d: pb.zoom_sample(t(s, d, "part").select("p_partkey"), "p_partkey"),
    "snk12_adjacency_shards": snk12,
    "snk13_search_shards": lambda s, d: pb.search_shards(t(s, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey", 40),
    "snk14_extend": lambda s, d: pb.extend(t(s, d, "customer").filter("c_custkey % 3 = 0").select("c_custkey", "c_acctbal"), t(s, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey"),
    "snk15_composition": lambda s, d: pb.composition(t(s, d, "part").select(F.when(F.col("p_size") > 25, "PROMO").otherwise(F.col("p_type")).alias("effective"), F.col("p_type").alias("original")), "effective", "original"),
    "snk16_snapshot_changes": snk16,
    "q03_leaderboard": lambda s, d: pb.leaderboard(t(s, d, "customer").select(F.col("c_name").alias("node"), F.col("c_acctbal").alias("centrality")), 20, "7"),
    "q07_glyphs": lambda s, d: pb.glyphs(pb.tile_summaries(typed(s, d), [11]), 0.05, 400).select("type", "gx", "gy", "n", "tile"),
    "q08_screen_sample": lambda s, d: pb.screen_sample(typed(s, d).filter("lon IS NOT NULL"), 0.25),
    "q11_clamp_scale": lambda s, d: pb.clamp_scale(t(s, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice").select("p_partkey", F.round("scaled", 9).alias("scaled")),
    "stream_windowed_counts": lambda s, d: windowed_counts(t(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))).select("event_type", "n", F.col("total").cast("double").alias("total"), F.unix_timestamp("start").alias("start")),
}

_MX = "least({n} - 1, greatest(0, CAST(floor((overture_lon + 180) / 360 * {n}) AS BIGINT)))"
_MY = "least({n} - 1, greatest(0, CAST(floor((1 - asinh(tan(radians(overture_lat))) / pi()) / 2 * {n}) AS BIGINT)))"
_TILES = " UNION ALL ".join(f"SELECT {z} AS zoom, {_MX.format(n=1 << z)} AS tx, {_MY.format(n=1 << z)} AS ty, overture_category AS type, count(*) AS n, round(avg(overture_lon), 11) AS lon, round(avg(overture_lat), 11) AS lat FROM overture_places WHERE overture_lon IS NOT NULL GROUP BY 1, 2, 3, 4" for z in (6, 9, 11))
_CLEAN = "CASE WHEN lower(trim(coalesce({0}, ''))) IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown') THEN '' ELSE trim({0}) END"
_ORDER = "['amenity', 'shop', 'office', 'craft', 'tourism', 'leisure', 'healthcare', 'industrial', 'man_made', 'club', 'emergency', 'public_transport', 'aeroway', 'railway', 'cuisine', 'brand', 'operator']"
_TAGS = f"""rows AS (SELECT rec_id, {_CLEAN.format('osm_name')} AS name, osm_operator, CASE rec_id % 11 WHEN 0 THEN 'public_transport' WHEN 1 THEN 'historic' WHEN 2 THEN 'railway' WHEN 3 THEN 'aeroway' END AS rare, list_filter(string_split(coalesce(osm_category, ''), ' | '), lambda p: contains(p, '=')) AS parts FROM osm_places),
 said AS (SELECT rec_id, rare, split_part(p, '=', 1) AS k0, p[len(p) - strpos(reverse(p), '=') + 2:] AS v0, i FROM (SELECT rec_id, rare, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM rows)),
 every AS (SELECT rec_id, CASE WHEN k0 = 'shop' AND rare IS NOT NULL THEN rare ELSE k0 END AS k, CASE rare WHEN 'railway' THEN 'subway_entrance' WHEN 'aeroway' THEN 'heliport' ELSE v0 END AS v, i FROM said UNION ALL SELECT rec_id, 'operator', osm_operator, 1000 FROM rows WHERE osm_operator IS NOT NULL),
 tags AS (SELECT rec_id, k, {_CLEAN.format('v')} AS v FROM every QUALIFY row_number() OVER (PARTITION BY rec_id, k ORDER BY i) = 1)"""
ORACLE = {
    # the keys and values are those of the survey's rule, stated again
    "src02_poi_predicate": f"WITH {_TAGS} SELECT r.rec_id, r.name <> '' AND count(k) FILTER (k IN ('amenity', 'shop', 'office', 'craft', 'tourism', 'leisure', 'healthcare', 'industrial', 'man_made', 'club', 'emergency', 'public_transport') AND v <> '' OR k = 'aeroway' AND v IN ('aerodrome', 'terminal') OR k = 'railway' AND v IN ('station', 'halt', 'tram_stop', 'subway_entrance')) > 0 AS poi FROM rows r LEFT JOIN tags USING (rec_id) GROUP BY r.rec_id, r.name",
    "src03_category_text": f"WITH {_TAGS} SELECT r.rec_id, coalesce(string_agg(k || '=' || v, ' | ' ORDER BY list_position({_ORDER}, k)) FILTER (list_contains({_ORDER}, k) AND v <> ''), '') AS category FROM rows r LEFT JOIN tags USING (rec_id) GROUP BY r.rec_id",
    "src04_scan": "SELECT rec_id FROM overture_places WHERE overture_lon BETWEEN 120.0 AND 123.0 AND overture_lat BETWEEN 8.0 AND 11.0 AND lower(trim(coalesce(overture_name, ''))) NOT IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown')",
    "src04_reasons": "SELECT CASE WHEN lower(trim(coalesce(overture_name, ''))) IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown') THEN 'no name' ELSE 'kept' END AS reason, count(*) AS n FROM overture_places WHERE overture_lon BETWEEN 120.0 AND 123.0 AND overture_lat BETWEEN 8.0 AND 11.0 GROUP BY 1",
    "src05_primary_name": "WITH c AS (SELECT rec_id, CASE WHEN lower(trim(coalesce(osm_operator, ''))) IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown') THEN '' ELSE trim(osm_operator) END AS p, CASE WHEN lower(trim(coalesce(osm_name, ''))) IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown') THEN '' ELSE trim(osm_name) END AS n FROM osm_places) SELECT rec_id, CASE WHEN p <> '' THEN p ELSE n END AS name FROM c",
    "src06_category_list": "SELECT rec_id, CASE WHEN overture_category = 'shop' THEN 'shop | place' ELSE overture_category || ' | shop | place' END AS categories FROM overture_places",
    "src07_license_status": """WITH i AS (SELECT rec_id, ['meta', 'alltheplaces', 'foursquare', 'unheardof', 'pinmeto', NULL][rec_id % 6 + 1] AS p, CASE WHEN rec_id % 4 > 0 THEN CASE lower(upstream_license) WHEN 'cdla-permissive-2.0' THEN 'CDLA-Permissive-2.0' WHEN 'apache-2.0' THEN 'Apache-2.0' WHEN 'cc0-1.0' THEN 'CC0-1.0' END
 ELSE CASE rec_id % 6 WHEN 0 THEN 'CDLA-Permissive-2.0' WHEN 1 THEN 'CC0-1.0' WHEN 4 THEN 'CDLA-Permissive-2.0' END END AS l FROM overture_places WHERE rec_id % 13 <> 0
 UNION ALL SELECT rec_id, 'brightquery', CASE WHEN rec_id % 5 = 0 THEN 'CC0-1.0' ELSE 'CDLA-Permissive-2.0' END FROM overture_places WHERE rec_id % 13 <> 0 AND rec_id % 3 = 0),
g AS (SELECT o.rec_id, CASE WHEN count(i.rec_id) = 0 THEN 'missing' WHEN bool_or(p = 'foursquare') THEN 'excluded' WHEN bool_or(l IS NULL) THEN 'unresolved' ELSE 'permitted' END AS reason, coalesce(string_agg(DISTINCT l, '|' ORDER BY l), '') AS licenses, coalesce(string_agg(DISTINCT p, '|' ORDER BY p), '') AS providers FROM overture_places o LEFT JOIN i USING (rec_id) GROUP BY 1)
SELECT rec_id, reason = 'permitted' AS allowed, licenses, providers, reason FROM g""",
    "src08_legacy_terms": "SELECT rec_id, CASE WHEN rec_id % 7 = 0 OR rec_id % 3 = 0 THEN 'OVERTURE-PLACES-REVIEW' WHEN rec_id % 3 = 1 THEN 'CDLA-Permissive-2.0' ELSE 'CC0-1.0' END AS terms, rec_id % 7 > 0 AND rec_id % 3 > 0 AS allowed FROM overture_places",
    "snk01_published_points": "SELECT o_orderkey AS id, o_custkey AS node, o_totalprice AS score, c_acctbal AS centrality, CAST(o_orderkey % 2 AS INTEGER) AS flag FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "snk04_type_counts": "SELECT overture_category AS type, count(*) AS n FROM overture_places GROUP BY 1",
    "snk09_tile_summaries": _TILES,
    "snk12_adjacency_shards": "WITH e AS (SELECT DISTINCT l_suppkey AS u, l_partkey % 100 AS v, l_quantity AS w FROM lineitem) SELECT CAST(u // 16 AS INTEGER) AS shard, u, v, w FROM e UNION SELECT CAST(v // 16 AS INTEGER), u, v, w FROM e",
    "snk13_search_shards": "SELECT p_partkey, p_brand, CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 40 AS INTEGER) AS shard FROM part",
    "snk14_extend": "SELECT c_custkey, c_acctbal, NULL AS c_mktsegment FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0",
    "snk15_composition": "WITH r AS (SELECT CASE WHEN p_size > 25 THEN 'PROMO' ELSE p_type END AS effective, p_type AS original FROM part) SELECT effective, original, count(*) AS n FROM r WHERE effective IN (SELECT effective FROM r WHERE effective <> original) GROUP BY 1, 2",
    "snk16_snapshot_changes": "WITH a AS (SELECT p_partkey AS k, CASE WHEN p_size > 5 THEN p_brand ELSE '' END AS l, p_retailprice AS sc FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey AS k, CASE WHEN p_size > 9 THEN CASE WHEN p_size = 20 THEN 'other' ELSE p_brand END ELSE '' END AS l, p_retailprice + CASE WHEN p_partkey % 13 = 0 THEN 1 ELSE 0 END AS sc FROM part WHERE p_partkey % 11 <> 0) SELECT CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.l = '' AND b.l <> '' THEN 'assigned' WHEN a.l <> '' AND b.l = '' THEN 'unassigned' WHEN a.l <> b.l THEN 'moved' WHEN abs(a.sc - b.sc) > 1e-8 * greatest(abs(a.sc), abs(b.sc)) THEN 'rescored' ELSE 'same' END AS change, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1",
    "q03_leaderboard": "SELECT c_name AS node, c_acctbal AS centrality, row_number() OVER (ORDER BY c_acctbal DESC, c_name) AS rank FROM customer WHERE contains(c_name, '7') QUALIFY rank <= 20",
    "q08_screen_sample": "SELECT overture_category AS type, CAST(floor(overture_lon / 0.25) AS BIGINT) AS gx, CAST(floor(overture_lat / 0.25) AS BIGINT) AS gy, min(rec_id) AS id FROM overture_places WHERE overture_lon IS NOT NULL GROUP BY 1, 2, 3",
    "q11_clamp_scale": "WITH q AS (SELECT quantile_cont(p_retailprice, 0.05) AS lo, quantile_cont(p_retailprice, 0.95) AS hi FROM part) SELECT p_partkey, round(greatest(0.0, least(1.0, (p_retailprice - lo) / (hi - lo))), 9) AS scaled FROM part, q",
    "stream_windowed_counts": "SELECT event_type, count(*) AS n, CAST(sum(CAST(CAST(value AS DECIMAL(18,4)) AS DECIMAL(38,4))) AS DOUBLE) AS total, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start FROM events GROUP BY event_type, date_trunc('hour', ts)",
}
