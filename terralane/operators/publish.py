"""Publication and the viewer's queries: tiles, samples, shards, summaries, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.functions.text import mercator
from terralane.operators.relational import left_join_checked

# Share of points shown per zoom level.
ZOOM_RATES = {8: 0.015, 9: 0.04, 10: 0.10, 11: 0.30, 12: 1.0}


def tile(lon: str, lat: str, zoom: int) -> tuple[Column, Column]:
    x, y = mercator(lon, lat)
    n = 1 << zoom
    clip = lambda c: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(c * n))).cast("long")
    return clip(x), clip(y)


def tile_summaries(points: DataFrame, zooms: list[int]) -> DataFrame:
    """(zoom, tx, ty, type, n, lon, lat): count and centroid per tile and type for each zoom level.

    The points are read once; every row is offered to each zoom level and combined before the shuffle.
    """
    levels = F.array(*[F.struct(F.lit(z).alias("zoom"), tile("lon", "lat", z)[0].alias("tx"), tile("lon", "lat", z)[1].alias("ty")) for z in zooms])
    return points.filter("lon IS NOT NULL AND lat IS NOT NULL").select("type", "lon", "lat", F.explode(levels).alias("z")).groupBy("z.zoom", "z.tx", "z.ty", "type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))


def zoom_sample(points: DataFrame, key: str) -> DataFrame:
    """Adds ``min_zoom``: the first level that shows the point, from a hash of its key; samples are nested."""
    rank = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 12), 16, 10).cast("double") / float(16**12)
    level = F.lit(None).cast("int")
    for zoom, rate in sorted(ZOOM_RATES.items(), reverse=True):
        level = F.when(rank < rate, zoom).otherwise(level)
    return points.withColumn("min_zoom", level)


def published_points(scores: DataFrame, centrality: DataFrame, audit: DataFrame) -> DataFrame:
    """Scores with their node's centrality (m:1) and the cluster audit of the point (1:1)."""
    return left_join_checked(left_join_checked(scores, centrality, ["node"]), audit, ["id"], "1:1")


def adjacency_shards(edges: DataFrame, positions: DataFrame, size: int = 16) -> DataFrame:
    """(shard, u, v, w): every edge once in the shard of each of its ends; positions is (node, pos)."""
    at = positions.select("node", F.floor(F.col("pos") / size).cast("int").alias("shard"))
    a = edges.join(at.withColumnRenamed("node", "u"), "u")
    b = edges.join(at.withColumnRenamed("node", "v"), "v")
    return a.select("shard", "u", "v", "w").unionByName(b.select("shard", "u", "v", "w")).distinct()


def search_shards(names: DataFrame, group: str, key: str, size: int) -> DataFrame:
    """Adds ``shard``: stretches of ``size`` rows of a group in the order of the key."""
    return names.withColumn("shard", F.floor((F.row_number().over(W.partitionBy(group).orderBy(key)) - 1) / size).cast("int"))


def composition(rows: DataFrame, effective: str, original: str) -> DataFrame:
    """(effective, original, n) of the effective groups that hold anything but themselves."""
    counted = rows.groupBy(effective, original).agg(F.count(F.lit(1)).alias("n"))
    mixed = F.max((F.col(effective) != F.col(original)).cast("int")).over(W.partitionBy(effective))
    return counted.withColumn("m", mixed).filter("m = 1").drop("m")


def extend(scored: DataFrame, classified: DataFrame, key: str) -> DataFrame:
    """Scored rows and the classified rows that are not scored, missing columns null."""
    return scored.unionByName(classified.join(scored.select(key), key, "left_anti"), allowMissingColumns=True)


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, label: str, score: str, rtol: float = 1e-8) -> DataFrame:
    """(change, n) between two snapshots: added, removed, assigned, unassigned, moved, rescored, same."""
    a = before.select(F.col(key).alias("k"), F.col(label).alias("la"), F.col(score).alias("sa"), F.lit(1).alias("ha"))
    b = after.select(F.col(key).alias("k"), F.col(label).alias("lb"), F.col(score).alias("sb"), F.lit(1).alias("hb"))
    both = a.join(b, "k", "full_outer")
    la, lb = F.coalesce("la", F.lit("")), F.coalesce("lb", F.lit(""))
    near = F.abs(F.col("sa") - F.col("sb")) <= rtol * F.greatest(F.abs("sa"), F.abs("sb"))
    change = (
        F.when(F.col("ha").isNull(), "added").when(F.col("hb").isNull(), "removed").when((la == "") & (lb != ""), "assigned").when((la != "") & (lb == ""), "unassigned")
        .when(la != lb, "moved").when(~F.coalesce(near, F.col("sa").eqNullSafe(F.col("sb"))), "rescored").otherwise("same"))
    return both.groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("n"))


def leaderboard(nodes: DataFrame, k: int, text: str = "") -> DataFrame:
    """(node, centrality, rank) of the k best nodes whose name holds the text; ties by node."""
    from terralane.operators.relational import top_k

    chosen = nodes.filter(F.instr(F.lower("node"), text.lower()) > 0) if text else nodes
    return top_k(chosen.select("node", "centrality"), k, "centrality", "node")


def glyphs(summaries: DataFrame, cell: float, most: int) -> DataFrame:
    """(type, gx, gy, n, lon, lat, tile): summaries merged in cells that double until at most ``most`` stay.

    Centroids are weighted; the representative is the tile with the greatest count, ties to the smaller.
    """
    while True:
        keys = [F.col("type"), F.floor(F.col("lon") / cell).alias("gx"), F.floor(F.col("lat") / cell).alias("gy")]
        merged = summaries.groupBy(*keys).agg(
            F.sum("n").alias("n"), (F.sum(F.col("lon") * F.col("n")) / F.sum("n")).alias("lon"), (F.sum(F.col("lat") * F.col("n")) / F.sum("n")).alias("lat"),
            F.max(F.struct("n", (-F.col("tx")).alias("a"), (-F.col("ty")).alias("b"))).alias("r"))
        if cell > 720 or merged.limit(most + 1).count() <= most:
            return merged.select("type", "gx", "gy", "n", "lon", "lat", F.concat_ws("/", -F.col("r.a"), -F.col("r.b")).alias("tile"))
        cell *= 2


def screen_sample(points: DataFrame, cell: float) -> DataFrame:
    """The smallest id per type and screen cell."""
    return points.groupBy("type", F.floor(F.col("lon") / cell).alias("gx"), F.floor(F.col("lat") / cell).alias("gy")).agg(F.min("id").alias("id"))


def clamp_scale(df: DataFrame, value: str) -> DataFrame:
    """Adds ``scaled``: the value between its exact 5 % and 95 % quantiles, clamped to 0 and 1."""
    low, high = df.agg(F.percentile(value, F.lit(0.05)), F.percentile(value, F.lit(0.95))).first()
    width = (high - low) if low is not None and high > low else 1.0
    return df.withColumn("scaled", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(value) - F.lit(low)) / F.lit(width))))


def manifest(spark, folder: str) -> DataFrame:
    """(name, bytes, sha256) of the files of a published folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def route_geometry(steps: DataFrame, vertices: DataFrame) -> DataFrame:
    """(route, points) of routes (route, seq, node): the vertices' positions in order."""
    placed = steps.join(vertices.select(F.col("id").alias("node"), "x", "y"), "node")
    listed = placed.groupBy("route").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("p"))
    return listed.select("route", F.transform("p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("points"))


def node_outputs(nodes: DataFrame, degrees: DataFrame, centrality: DataFrame, lon0: float, lat0: float) -> DataFrame:
    """Nodes (node, x, y in metres around an origin) with position in degrees, degrees and centrality."""
    metres = 111_195.0
    lat = F.lit(lat0) + F.col("y") / metres
    lon = F.lit(lon0) + F.col("x") / (F.lit(metres) * F.cos(F.radians(F.lit(lat0))))
    placed = nodes.select("node", lon.alias("lon"), lat.alias("lat"))
    return left_join_checked(left_join_checked(placed, degrees, ["node"], "1:1"), centrality, ["node"], "1:1")


def id_relation(a: Column, b: Column) -> Column:
    """none, one-sided, equal or different for two arrays of ids, order and repeats aside."""
    x, y = F.array_distinct(F.coalesce(a, F.array().cast("array<string>"))), F.array_distinct(F.coalesce(b, F.array().cast("array<string>")))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), "none").when((F.size(x) == 0) | (F.size(y) == 0), "one-sided").when((F.size(F.array_except(x, y)) == 0) & (F.size(F.array_except(y, x)) == 0), "equal").otherwise("different")
