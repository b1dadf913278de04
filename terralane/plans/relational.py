"""Relational idioms as named queries on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from terralane.operators import relational as rel
from terralane.session import table as t

MONEY = "CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,6)) AS DECIMAL(38,6))"
money = lambda: (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,6)")


def r01(s, d):
    return t(s, d, "lineitem").filter((F.col("l_quantity") >= 45) & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_linenumber", "l_quantity")


def r02(s, d):
    return t(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.lower("o_orderstatus").alias("status"), (F.col("o_totalprice") > 200000).alias("large"))


def r03(s, d):
    right = t(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return rel.left_join_checked(t(s, d, "orders").select("o_orderkey", "o_custkey"), right, ["o_custkey"])


def r04(s, d):
    names = t(s, d, "nation").select("n_nationkey", "n_name")
    regions = t(s, d, "nation").select("n_nationkey", "n_regionkey")
    return rel.left_join_checked(names, regions, ["n_nationkey"], "1:1")


def r05(s, d):
    levels = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "middle"}
    return rel.lookup(t(s, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", levels, "level").groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def r06(s, d):
    pairs = t(s, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("lines"))
    return t(s, d, "lineitem").filter("l_linenumber = 1").select("l_orderkey", "l_partkey", "l_suppkey").join(pairs, ["l_partkey", "l_suppkey"], "left")


def r07(s, d):
    return t(s, d, "customer").join(t(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


def r08(s, d):
    urgent = t(s, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t(s, d, "customer").join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


def r09(s, d):
    return t(s, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money()).cast("double").alias("revenue"), F.max("l_quantity").alias("top"), F.min("l_shipdate").alias("first_ship"), F.countDistinct("l_suppkey").alias("suppliers"))


def r09b(s, d):
    return t(s, d, "lineitem").groupBy("l_returnflag").agg(F.median("l_quantity").alias("mid"), F.percentile("l_extendedprice", F.lit(0.05)).alias("low"), F.percentile("l_extendedprice", F.lit(0.95)).alias("high"))


def r10(s, d):
    return rel.group_quantile(t(s, d, "part").select("p_partkey", "p_brand", "p_retailprice"), ["p_brand"], "p_retailprice", 0.9, "p90").select("p_partkey", "p_brand", F.round("p90", 6).alias("p90"))


def r11(s, d):
    from terralane.plans.base import transactions

    groups = t(s, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"), F.col("n_regionkey").cast("int").alias("grp"))
    return rel.block_sum(transactions(s, d), groups).withColumn("value", F.col("value").cast("double"))


def r12(s, d):
    return t(s, d, "part").groupBy("p_type").count().withColumnRenamed("count", "n")


def r13(s, d):
    return rel.first_per_key(t(s, d, "part").select("p_name", "p_partkey", "p_size"), ["p_name"], [F.col("p_size").asc(), F.col("p_partkey").asc()])


def r14(s, d):
    return rel.duplicates(t(s, d, "places").select("canonical_id"), ["canonical_id"])


def r15(s, d):
    from pyspark.sql import Window as W

    w = W.partitionBy("p_brand").orderBy(F.col("p_size").desc(), F.col("p_name").asc(), F.col("p_partkey").asc())
    return t(s, d, "part").select("p_partkey", "p_brand", F.row_number().over(w).alias("place"))


def r16(s, d):
    return rel.top_k(t(s, d, "orders").select("o_orderkey", "o_totalprice"), 25, "o_totalprice", "o_orderkey")


def r17(s, d):
    from pyspark.sql import Window as W

    return t(s, d, "customer").select("c_custkey", F.ntile(10).over(W.partitionBy("c_mktsegment").orderBy("c_acctbal", "c_custkey")).alias("decile"))


def r18(s, d):
    a = t(s, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    b = t(s, d, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


def r19(s, d):
    by = t(s, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set(F.substring("o_orderpriority", 1, 1))).alias("have"))
    return by.select("o_custkey", F.array_join(F.array_intersect("have", F.array(F.lit("1"), F.lit("2"), F.lit("3"))), "; ").alias("both"), F.array_join(F.array_except("have", F.array(F.lit("1"), F.lit("2"), F.lit("3"))), "; ").alias("rest"))


def r20(s, d):
    """One locality per place: that which holds it, else one whose border it touches, the smallest code first."""
    from terralane.operators.proximity import assigned_regions, positions

    regions = t(s, d, "area_localities").select("locality_id", "psgc", "geometry")
    order = rel.numbered(regions.select("psgc", "locality_id"), ["psgc", "locality_id"], "at").select("locality_id", "psgc", F.col("at").cast("long").alias("at"))
    found = assigned_regions(positions(t(s, d, "places")), regions.join(order.select("locality_id", "at"), "locality_id"), region_key="at")
    return found.join(order, "at").select("rec_id", "psgc", "relation", "regions")


def r21(s, d):
    left = t(s, d, "osm_places").select("rec_id", F.col("osm_lon").alias("x"), F.col("osm_lat").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    right = t(s, d, "overture_places").select("rec_id", F.col("overture_lon").alias("x"), F.col("overture_lat").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    return rel.neighbours_in_grid(left, right, 0.0012).select(F.col("a.rec_id").alias("left_id"), F.col("b.rec_id").alias("right_id"))


def r22(s, d):
    return t(s, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.count(F.lit(1)).alias("lines"))


def r23(s, d):
    rows = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("q"))
    return rel.first_reaching(rows, ["l_orderkey"], ["l_linenumber"], "q", F.lit(60), "l_linenumber", "reached")


def r24(s, d):
    rows = t(s, d, "events").select("event_id", "user_id", "event_type")
    return rel.runs(rows, ["user_id"], ["event_id"], "event_type").groupBy("user_id").agg(F.max("run").alias("stretches"))


def r25(s, d):
    names = t(s, d, "part").select("p_partkey", F.explode(F.array_distinct(F.split(F.lower("p_name"), " "))).alias("word"))
    return names.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "r01_filter": r01, "r02_project": r02, "r03_left_join_many_to_one": r03, "r04_left_join_one_to_one": r04, "r05_lookup": r05, "r06_composite_lookup": r06, "r07_anti_join": r07,
    "r08_semi_join": r08, "r09_group_aggregates": r09, "r09b_exact_quantiles": r09b, "r10_group_quantile": r10, "r11_block_sum": r11, "r12_value_counts": r12, "r13_first_per_key": r13,
    "r14_duplicate_keys": r14, "r15_stable_order": r15, "r16_top_k": r16, "r17_ntile": r17, "r18_union_by_name": r18, "r19_code_sets": r19, "r20_spatial_assignment": r20, "r21_grid_neighbours": r21,
    "r22_segment_reduce": r22, "r23_running_threshold": r23, "r24_runs": r24, "r25_split_explode": r25,
}

_Z = f"""SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS src, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS dst, sum({MONEY}) AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2"""

ORACLE = {
    "r01_filter": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R'",
    "r02_project": "SELECT o_orderkey AS id, lower(o_orderstatus) AS status, o_totalprice > 200000 AS large FROM orders",
    "r03_left_join_many_to_one": "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "r04_left_join_one_to_one": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "r05_lookup": "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'middle' END AS level, count(*) AS n FROM orders GROUP BY 1",
    "r06_composite_lookup": "WITH p AS (SELECT l_partkey, l_suppkey, count(*) AS lines FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, l_partkey, l_suppkey, lines FROM lineitem JOIN p USING (l_partkey, l_suppkey) WHERE l_linenumber = 1",
    "r07_anti_join": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "r08_semi_join": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "r09_group_aggregates": f"SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum({MONEY}) AS DOUBLE) AS revenue, max(l_quantity) AS top, min(l_shipdate) AS first_ship, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2",
    "r09b_exact_quantiles": "SELECT l_returnflag, median(l_quantity) AS mid, quantile_cont(l_extendedprice, 0.05) AS low, quantile_cont(l_extendedprice, 0.95) AS high FROM lineitem GROUP BY 1",
    "r10_group_quantile": "SELECT p_partkey, p_brand, round(quantile_cont(p_retailprice, 0.9) OVER (PARTITION BY p_brand), 6) AS p90 FROM part",
    "r11_block_sum": f"WITH z AS ({_Z}) SELECT CAST(a.n_regionkey AS INTEGER) AS src_group, CAST(b.n_regionkey AS INTEGER) AS dst_group, CAST(sum(value) AS DOUBLE) AS value FROM z JOIN nation a ON CAST(src AS INTEGER) = a.n_nationkey JOIN nation b ON CAST(dst AS INTEGER) = b.n_nationkey GROUP BY 1, 2",
    "r12_value_counts": "SELECT p_type, count(*) AS n FROM part GROUP BY 1",
    "r13_first_per_key": "SELECT p_name, p_partkey, p_size FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_size, p_partkey) = 1",
    "r14_duplicate_keys": "SELECT canonical_id, count(*) AS n FROM places GROUP BY 1 HAVING count(*) > 1",
    "r15_stable_order": "SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_name, p_partkey) AS place FROM part",
    "r16_top_k": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders QUALIFY rank <= 25",
    "r17_ntile": "SELECT c_custkey, ntile(10) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS decile FROM customer",
    "r18_union_by_name": "SELECT s_name AS name, s_nationkey AS nation, NULL AS segment FROM supplier UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer",
    "r19_code_sets": "WITH h AS (SELECT o_custkey, list_sort(list(DISTINCT substr(o_orderpriority, 1, 1))) AS have FROM orders GROUP BY 1) SELECT o_custkey, array_to_string(list_filter(have, lambda x: x IN ('1', '2', '3')), '; ') AS both, array_to_string(list_filter(have, lambda x: x NOT IN ('1', '2', '3')), '; ') AS rest FROM h",
    "r21_grid_neighbours": "SELECT o.rec_id AS left_id, v.rec_id AS right_id FROM osm_places o JOIN overture_places v ON abs(floor(osm_lon / 0.0012) - floor(overture_lon / 0.0012)) <= 1 AND abs(floor(osm_lat / 0.0012) - floor(overture_lat / 0.0012)) <= 1",
    "r22_segment_reduce": "SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, count(*) AS lines FROM lineitem GROUP BY 1",
    "r23_running_threshold": "WITH r AS (SELECT l_orderkey, l_linenumber, sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING) AS run FROM lineitem) SELECT l_orderkey, min(CASE WHEN run >= 60 THEN l_linenumber END) AS reached FROM r GROUP BY 1",
    "r24_runs": "WITH f AS (SELECT user_id, event_id, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT user_id, CAST(sum(st) AS BIGINT) AS stretches FROM f GROUP BY 1",
    "r25_split_explode": "SELECT word, count(*) AS n FROM (SELECT p_partkey, unnest(list_distinct(string_split(lower(p_name), ' '))) AS word FROM part) GROUP BY 1",
}
