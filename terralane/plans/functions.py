"""Scalar functions as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terralane.functions import text as tx
from terralane.functions.similarity import with_similarity
from terralane.session import table as t

_FOLD = "trim(regexp_replace(strip_accents(replace(lower({c}), '&', ' and ')), '[^a-z0-9]+', ' ', 'g'))"
_CLEAN = "CASE WHEN lower(trim(coalesce({c}, ''))) IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown') THEN '' ELSE trim({c}) END"
_HAV = "2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"


def osm(s, d, *cols):
    return t(s, d, "osm_places").select("rec_id", *cols)


def f08(s, d):
    a = t(s, d, "part").select("p_partkey", tx.fold("p_name").alias("a"), tx.fold(F.concat_ws(" ", F.reverse(F.split("p_name", " ")))).alias("b"), tx.fold(F.concat("p_brand", F.lit(" "), "p_type")).alias("c"))
    both = with_similarity(with_similarity(a, "a", "b", "turned"), "a", "c", "other")
    return both.select("p_partkey", F.round("turned", 9).alias("turned"), F.round("other", 9).alias("other"))


def f09(s, d):
    r = t(s, d, "osm_places").select("rec_id", F.round(tx.haversine_m(F.lit(121.0), F.lit(14.5), "osm_lon", "osm_lat"), 3).alias("meters"))
    return r


def f23(s, d):
    r = osm(s, d, "osm_name").withColumn("rank", tx.search_rank(F.col("osm_name"), "ba")).filter("rank IS NOT NULL")
    return r.orderBy("rank", "osm_name", "rec_id").limit(30).select("rec_id", "rank")


QUERIES = {
    "f01_clean_text": lambda s, d: osm(s, d, tx.clean_text("osm_city").alias("city")),
    "f02_fold": lambda s, d: osm(s, d, tx.fold("osm_name").alias("key")),
    "f03_combine": lambda s, d: t(s, d, "osm_places").select("rec_id", tx.combine(["osm_city", "osm_city", "osm_operator"]).alias("joined")),
    "f04_literal_key": lambda s, d: osm(s, d, tx.literal_key("osm_category").alias("key")),
    "f05_name_key": lambda s, d: t(s, d, "part").select("p_partkey", tx.name_key(F.concat("p_name", F.lit(" -- "), "p_brand")).alias("key")),
    "f06_institution_key": lambda s, d: t(s, d, "registry_qc_official_sources").select("rec_id", tx.institution_key("name").alias("key")),
    "f07_title_key": lambda s, d: t(s, d, "part").select("p_partkey", tx.title_key(F.concat("p_type", F.lit(" & "), "p_brand")).alias("key")),
    "f08_name_similarity": f08,
    "f09_haversine": f09,
    "f10_grid_key": lambda s, d: t(s, d, "osm_places").filter("osm_lon IS NOT NULL").select("rec_id", F.floor(F.col("osm_lon") / 0.0012).alias("gx"), F.floor(F.col("osm_lat") / 0.0012).alias("gy")),
    "f11_place_id": lambda s, d: osm(s, d, tx.place_id(F.array(F.concat(F.lit("osm:"), "source_id"), F.lit("overture:x"))).alias("poi_id")),
    "f12_pick_name": lambda s, d: t(s, d, "part").select("p_partkey", tx.pick_name(F.col("p_name"), F.concat("p_brand", F.lit(" "), "p_type")).alias("name")),
    "f13_sector_code": lambda s, d: t(s, d, "nation").select("n_nationkey", tx.sector_code("n_nationkey").alias("code"), tx.sector_code(F.concat(F.col("n_nationkey").cast("string"), F.lit(".0"))).alias("same"), tx.sector_code("n_name").alias("label")),
    "f14_round_significant": lambda s, d: t(s, d, "orders").select("o_orderkey", tx.round_significant("o_totalprice", 3).alias("v")),
    "f15_node_key": lambda s, d: t(s, d, "part").select("p_partkey", tx.node_key(F.concat("p_type", F.lit(" / x::"), "p_brand"), F.col("p_size")).alias("node")),
    "f16_tag_pairs": lambda s, d: osm(s, d, F.explode(tx.tag_pairs("osm_category")).alias("p")).select("rec_id", "p.key", "p.value"),
    "f17_category_query": lambda s, d: t(s, d, "overture_places").select("rec_id", tx.category_query("overture_category").alias("words")),
    "f20_hub_weight": lambda s, d: t(s, d, "part").select("p_partkey", F.round(tx.hub_weight(F.col("p_retailprice"), tx.effective_distance(F.col("p_size").cast("double"), F.lit(2.0), F.lit(3.5)), 1.5), 9).alias("w")),
    "f21_mercator": lambda s, d: t(s, d, "osm_places").filter("osm_lon IS NOT NULL").select("rec_id", F.floor(tx.mercator("osm_lon", "osm_lat")[0] * 32768).alias("x"), F.floor(tx.mercator("osm_lon", "osm_lat")[1] * 32768).alias("y")),
    "f22_json_block": lambda s, d: t(s, d, "events").select("event_id", F.get_json_object(tx.json_block(F.concat(F.lit("answer: "), "props", F.lit(" end"))), "$.k").cast("long").alias("k")),
    "f23_search": f23,
}

ORACLE = {
    "f01_clean_text": f"SELECT rec_id, {_CLEAN.format(c='osm_city')} AS city FROM osm_places",
    "f02_fold": f"SELECT rec_id, {_FOLD.format(c=_CLEAN.format(c='osm_name'))} AS key FROM osm_places",
    "f03_combine": f"WITH v AS (SELECT rec_id, {_CLEAN.format(c='osm_city')} AS a, {_CLEAN.format(c='osm_operator')} AS b FROM osm_places), k AS (SELECT *, {_FOLD.format(c='a')} AS ka, {_FOLD.format(c='b')} AS kb FROM v) SELECT rec_id, concat_ws(' | ', CASE WHEN ka <> '' THEN a END, CASE WHEN kb <> '' AND kb <> ka THEN b END) AS joined FROM k",
    "f04_literal_key": "SELECT rec_id, trim(regexp_replace(regexp_replace(lower(coalesce(osm_category, '')), '[^\\p{L}\\p{N}_=:+&/.\\- ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM osm_places",
    "f05_name_key": "SELECT p_partkey, trim(regexp_replace(lower(p_name || ' -- ' || p_brand), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS key FROM part",
    "f06_institution_key": "WITH a AS (SELECT rec_id, ' ' || trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce(name, ''))), '[''’]', '', 'g'), '[^a-z0-9]+', ' ', 'g')) || ' ' AS k FROM registry_qc_official_sources) SELECT rec_id, trim(regexp_replace(replace(replace(replace(replace(k, ' es ', ' elementary school '), ' nhs ', ' national high school '), ' hs ', ' high school '), ' st ', ' saint '), ' (inc|corp|incorporated|corporation) $', '')) AS key FROM a",
    "f07_title_key": "SELECT p_partkey, trim(regexp_replace(replace(lower(p_type || ' & ' || p_brand), '&', ' and '), '[^0-9a-z]+', ' ', 'g')) AS key FROM part",
    "f09_haversine": f"SELECT rec_id, CASE WHEN osm_lon IS NOT NULL AND osm_lat IS NOT NULL THEN round({_HAV.format(lat1='14.5', lon1='121.0', lat2='osm_lat', lon2='osm_lon')}, 3) END AS meters FROM osm_places",
    "f10_grid_key": "SELECT rec_id, CAST(floor(osm_lon / 0.0012) AS BIGINT) AS gx, CAST(floor(osm_lat / 0.0012) AS BIGINT) AS gy FROM osm_places WHERE osm_lon IS NOT NULL",
    "f11_place_id": "SELECT rec_id, 'ss_' || substr(sha256(array_to_string(list_sort(['osm:' || source_id, 'overture:x']), '|')), 1, 20) AS poi_id FROM osm_places",
    "f12_pick_name": f"WITH q AS (SELECT p_partkey, p_name AS a, p_brand || ' ' || p_type AS b FROM part), k AS (SELECT *, {_FOLD.format(c='a')} AS ka, {_FOLD.format(c='b')} AS kb FROM q) SELECT p_partkey, CASE WHEN (len(string_split(ka, ' ')), length(ka), ka) >= (len(string_split(kb, ' ')), length(kb), kb) THEN a ELSE b END AS name FROM k",
    "f13_sector_code": "SELECT n_nationkey, CASE WHEN n_nationkey < 10 THEN '0' || n_nationkey ELSE CAST(n_nationkey AS VARCHAR) END AS code, CASE WHEN n_nationkey < 10 THEN '0' || n_nationkey ELSE CAST(n_nationkey AS VARCHAR) END AS same, n_name AS label FROM nation",
    "f14_round_significant": "SELECT o_orderkey, round_even(o_totalprice * pow(10, 2 - floor(log10(abs(o_totalprice)))), 0) / pow(10, 2 - floor(log10(abs(o_totalprice)))) AS v FROM orders",
    "f15_node_key": "SELECT p_partkey, 'type=' || url_encode(p_type || ' / x::' || p_brand) || '::cluster=' || p_size AS node FROM part",
    "f16_tag_pairs": "WITH p AS (SELECT rec_id, unnest(string_split_regex(osm_category, '\\s*\\|\\s*')) AS p FROM osm_places) SELECT rec_id, split_part(p, '=', 1) AS key, split_part(p, '=', 2) AS value FROM p WHERE contains(p, '=')",
    "f17_category_query": "SELECT rec_id, trim(replace(overture_category, '_', ' ')) AS words FROM overture_places",
    "f20_hub_weight": "SELECT p_partkey, round(p_retailprice * pow(greatest(p_size + 5.5, 1.0), -1.5), 9) AS w FROM part",
    "f21_mercator": "SELECT rec_id, CAST(floor((osm_lon + 180) / 360 * 32768) AS BIGINT) AS x, CAST(floor((1 - asinh(tan(radians(osm_lat))) / pi()) / 2 * 32768) AS BIGINT) AS y FROM osm_places WHERE osm_lon IS NOT NULL",
    "f22_json_block": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "f23_search": "SELECT rec_id, CASE WHEN starts_with(lower(strip_accents(osm_name)), 'ba') THEN 1 ELSE 2 END AS rank FROM osm_places WHERE contains(lower(strip_accents(osm_name)), 'ba') ORDER BY rank, osm_name, rec_id LIMIT 30",
}
