"""Queries over code trees, clusters and territories."""

from __future__ import annotations

from pyspark.sql import functions as F

from terralane.operators import clustering as cl
from terralane.operators import taxonomy as tx
from terralane.session import table as t


def tree(s, d):
    """Three levels: type, type and brand, type with brand and size."""
    parts = t(s, d, "part")
    a = parts.select(F.col("p_type").alias("code"), F.lit(None).cast("string").alias("parent"))
    b = parts.select(F.concat_ws("/", "p_type", "p_brand").alias("code"), F.col("p_type").alias("parent"))
    c = parts.select(F.concat_ws("/", "p_type", "p_brand", (F.col("p_size") % 5).cast("string")).alias("code"), F.concat_ws("/", "p_type", "p_brand").alias("parent"))
    return a.unionByName(b).unionByName(c).distinct()


def baskets(s, d):
    """Codes of the lines of every order."""
    p = t(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("/", "p_type", "p_brand", (F.col("p_size") % 5).cast("string")).alias("code"))
    return t(s, d, "lineitem").join(p, "l_partkey").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), "code")


def evidence(s, d):
    """Two independent sources per order: the codes of its odd lines, and the top codes of its even lines."""
    odd = F.col("line") % 2 == 1
    rows = baskets(s, d).select("id", F.when(odd, "odd").otherwise("even").alias("source"), F.when(odd, F.col("code")).otherwise(F.substring_index("code", "/", 1)).alias("code"))
    codes = F.array_sort(F.collect_set("code"))
    return rows.groupBy("id", "source").agg(codes.alias("codes")).select("id", "source", F.col("source").alias("grp"), F.when(F.size("codes") > 1, "UNION").otherwise("SUBTREE").alias("kind"), "codes")


def t13(s, d):
    return tx.fuse(evidence(s, d), tree(s, d)).select("id", "code", "relation", F.array_join("flags", "|").alias("flags"))


def t06(s, d):
    rules = s.createDataFrame([("exact", "bank", "66"), ("exact", "gym", "91"), ("contains", "clinic", "85"), ("contains", "dental", "86"), ("contains", "office", "82"), ("contains", "sari sari", "47")], "kind string, pattern string, target string")
    from terralane.functions.text import fold

    return tx.crosswalk(t(s, d, "osm_places").select(F.col("rec_id").alias("id"), fold("osm_name").alias("key")).dropDuplicates(["id"]), rules)


def retrieved(s, d, k):
    """The k parts most like the name of every part."""
    targets = t(s, d, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    return tx.retrieve(t(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text")), targets, k)


def t04(s, d):
    return retrieved(s, d, 5).select("query", "target", F.round("score", 6).alias("score"))


def t21(s, d):
    rows = t(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("n"), F.col("o_custkey")).alias("name"), F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("P"), F.lit("O"))).otherwise(F.array(F.when(F.col("o_orderstatus") == "F", "O").otherwise(F.col("o_orderstatus")))).alias("codes"))
    return tx.resolve_by_name(rows)


def spots(s, d):
    p = t(s, d, "overture_places").filter("overture_lon IS NOT NULL AND overture_lat IS NOT NULL")
    k = 111_195.0
    return p.select(F.col("overture_category").alias("type"), F.col("rec_id").alias("id"), (F.col("overture_lon") * F.cos(F.radians(F.lit(9.0))) * k).alias("x"), (F.col("overture_lat") * k).alias("y"))


def c08(s, d):
    return cl.cluster_by_type(spots(s, d), 40_000.0, 4, 2)


def centers(s, d):
    return s.createDataFrame([("A", 0, 12.0, 40.0), ("A", 1, 80.0, 35.0), ("A", 2, 50.0, 5.0), ("B", 0, 20.0, 20.0), ("B", 1, 60.0, 20.0)], "type string, cluster int, x double, y double")


def box(s, size):
    return cl.grid_cells(s, 0.0, 0.0, 99.0, 50.0, size)


QUERIES = {
    "t01_closure": lambda s, d: tx.closure(tree(s, d)),
    "t01_tree_problems": lambda s, d: tx.tree_problems(tree(s, d)),
    "t02_common_ancestor": lambda s, d: tx.common_ancestor(baskets(s, d), tx.closure(tree(s, d))),
    "t02_descendants": lambda s, d: tx.descendants(s.createDataFrame([("PROMO",)], "code string"), tx.closure(tree(s, d)), leaves_only=True),
    "t04_retrieval": t04,
    "t06_crosswalk": t06,
    "t13_fusion": t13,
    "t16_majority": lambda s, d: tx.majority(t(s, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("code"))),
    "t21_resolve_by_name": t21,
    "c08_cluster_by_type": c08,
    "c09_gap_refinement": lambda s, d: cl.gap_refinement(c08(s, d).join(spots(s, d), ["type", "id"]).select("type", "cluster", "id", "x", "y").filter("cluster >= 0")),
    "c11_grid_cells": lambda s, d: box(s, 8.0).select("col", "row", "x", "y", "area"),
    "c13_territory_areas": lambda s, d: cl.territory_areas(cl.territories(box(s, 4.0), centers(s, d))),
    "c14_changed_share": lambda s, d: cl.changed_share(cl.territories(box(s, 4.0), centers(s, d)), cl.territories(box(s, 2.0), centers(s, d))).select("type", F.round("changed", 9).alias("changed")),
    "c15_territories": lambda s, d: cl.territories(box(s, 4.0), centers(s, d)),
}

_TREE = """leaf AS (SELECT DISTINCT p_type AS a, p_type || '/' || p_brand AS b, p_type || '/' || p_brand || '/' || (p_size % 5) AS c FROM part),
 tree AS (SELECT DISTINCT a AS code, NULL AS parent FROM leaf UNION SELECT b, a FROM leaf UNION SELECT c, b FROM leaf),
 paths AS (SELECT code, code AS ancestor, 0 AS distance FROM tree UNION ALL SELECT code, parent, 1 FROM tree WHERE parent IS NOT NULL UNION ALL SELECT DISTINCT c, a, 2 FROM leaf)"""
_LCA = "CASE WHEN min(c) = max(c) THEN min(c) WHEN min(b) = max(b) THEN min(b) WHEN min(a) = max(a) THEN min(a) END"
_BASKET = "bk AS (SELECT l_orderkey AS id, l_linenumber AS source, p_type AS a, p_type || '/' || p_brand AS b, p_type || '/' || p_brand || '/' || (p_size % 5) AS c FROM lineitem JOIN part ON l_partkey = p_partkey)"


def _cells(size: float) -> str:
    nx, ny = -(-99 // int(size)), -(-50 // int(size))
    return f"SELECT i AS col, j AS row, (i * {size} + least((i + 1) * {size}, 99.0)) / 2 AS x, (j * {size} + least((j + 1) * {size}, 50.0)) / 2 AS y, (least((i + 1) * {size}, 99.0) - i * {size}) * (least((j + 1) * {size}, 50.0) - j * {size}) AS area FROM range({nx}) a(i), range({ny}) b(j)"


def _terr(size: float) -> str:
    return f"SELECT col, row, CAST(area AS DOUBLE) AS area, type, cluster FROM ({_cells(size)}), (VALUES ('A', 0, 12.0, 40.0), ('A', 1, 80.0, 35.0), ('A', 2, 50.0, 5.0), ('B', 0, 20.0, 20.0), ('B', 1, 60.0, 20.0)) k(type, cluster, cx, cy) QUALIFY row_number() OVER (PARTITION BY col, row, type ORDER BY round(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), 9), cluster) = 1"


ORACLE = {
    "t01_closure": f"WITH {_TREE} SELECT * FROM paths",
    "t01_tree_problems": "SELECT '' AS problem, '' AS code WHERE false",
    "t02_common_ancestor": f"WITH {_BASKET} SELECT id, CASE WHEN min(c) = max(c) THEN min(c) WHEN min(b) = max(b) THEN min(b) WHEN min(a) = max(a) THEN min(a) END AS lca FROM bk GROUP BY 1",
    "t02_descendants": f"WITH {_TREE} SELECT 'PROMO' AS code, c AS descendant FROM leaf WHERE a = 'PROMO'",
    "t06_crosswalk": "WITH k AS (SELECT rec_id AS id, ' ' || trim(regexp_replace(strip_accents(replace(lower(CASE WHEN lower(trim(coalesce(osm_name, ''))) IN ('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown') THEN '' ELSE trim(osm_name) END), '&', ' and ')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS k FROM osm_places), m AS (SELECT id, CASE WHEN k = ' bank ' THEN ['66'] WHEN k = ' gym ' THEN ['91'] ELSE list_filter([CASE WHEN contains(k, ' clinic ') THEN '85' END, CASE WHEN contains(k, ' dental ') THEN '86' END, CASE WHEN contains(k, ' office ') THEN '82' END, CASE WHEN contains(k, ' sari sari ') THEN '47' END], lambda x: x IS NOT NULL) END AS h FROM k) SELECT id, CASE WHEN len(h) = 1 THEN h[1] END AS target, CASE WHEN len(h) = 0 THEN 'NONE' WHEN len(h) = 1 THEN 'MATCH' ELSE 'AMBIGUOUS' END AS status FROM m",
    # odd lines name leaves, even lines top codes: stated by levels, without sets of descendants
    "t13_fusion": f"""WITH {_BASKET},
o AS (SELECT id, count(DISTINCT c) AS n, {_LCA} AS lca, CASE WHEN min(b) = max(b) THEN 2 WHEN min(a) = max(a) THEN 1 END AS depth FROM bk WHERE source % 2 = 1 GROUP BY 1),
e AS (SELECT id, CASE WHEN min(a) = max(a) THEN min(a) END AS lca FROM bk WHERE source % 2 = 0 GROUP BY 1),
k AS (SELECT id, {_LCA} AS lca FROM (SELECT DISTINCT x.id, x.a, x.b, x.c FROM bk x JOIN bk y ON x.id = y.id AND x.a = y.a WHERE x.source % 2 = 1 AND y.source % 2 = 0) GROUP BY 1),
i AS (SELECT DISTINCT id FROM bk)
SELECT i.id, CASE WHEN o.id IS NULL THEN e.lca WHEN e.id IS NULL THEN o.lca ELSE k.lca END AS code,
 CASE WHEN o.id IS NULL THEN CASE WHEN e.lca IS NULL THEN 'UNION' ELSE 'SINGLE' END WHEN e.id IS NULL THEN CASE WHEN o.lca IS NULL OR o.n > 1 THEN 'UNION' ELSE 'SINGLE' END
 WHEN k.id IS NULL THEN 'CONFLICT' WHEN k.lca IS NULL THEN 'UNION' WHEN e.lca IS NOT NULL AND o.depth = 2 THEN 'NESTED' ELSE 'INTERSECT' END AS relation,
 CASE WHEN o.id IS NULL THEN CASE WHEN e.lca IS NULL THEN 'NO_COMMON_ANCESTOR' ELSE '' END WHEN e.id IS NULL THEN CASE WHEN o.lca IS NULL THEN 'NO_COMMON_ANCESTOR' ELSE '' END WHEN k.id IS NOT NULL AND k.lca IS NULL THEN 'NO_COMMON_ANCESTOR' ELSE '' END AS flags
FROM i LEFT JOIN o USING (id) LEFT JOIN e USING (id) LEFT JOIN k USING (id)""",
    "t16_majority": "SELECT id, code FROM (SELECT l_orderkey AS id, l_returnflag AS code, count(*) AS n, sum(count(*)) OVER (PARTITION BY l_orderkey) AS tot FROM lineitem GROUP BY 1, 2) WHERE 2 * n > tot",
    "t21_resolve_by_name": "WITH r AS (SELECT o_orderkey AS id, o_custkey AS name, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END AS code FROM orders), e AS (SELECT name, min(code) AS code, count(DISTINCT id) AS support FROM r WHERE code IS NOT NULL GROUP BY 1 HAVING count(DISTINCT code) = 1 AND count(DISTINCT id) >= 2) SELECT r.id, e.code, e.support FROM r JOIN e USING (name) WHERE r.code IS NULL AND e.code IN ('P', 'O')",
    "c11_grid_cells": f"SELECT col, row, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(area AS DOUBLE) AS area FROM ({_cells(8.0)})",
    "c13_territory_areas": f"SELECT type, cluster, count(*) AS cells, sum(area) AS area FROM ({_terr(4.0)}) GROUP BY 1, 2",
    "c14_changed_share": f"WITH c AS ({_terr(4.0)}), f AS ({_terr(2.0)}) SELECT f.type, round(sum(CASE WHEN f.cluster <> c.cluster THEN f.area ELSE 0 END) / sum(f.area), 9) AS changed FROM f JOIN c ON c.type = f.type AND c.col = f.col // 2 AND c.row = f.row // 2 GROUP BY 1",
    "c15_territories": _terr(4.0),
}
