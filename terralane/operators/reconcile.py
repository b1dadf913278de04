"""Two sources of places brought together one to one by name and distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.functions.similarity import with_similarity
from terralane.functions.text import clean_text, combine, fold, haversine_m, pick_name, place_id
from terralane.operators.relational import neighbours_in_grid
from terralane.session import cut

CELL, REACH_M = 0.0012, 120.0
# Names that say only what a place is.
GENERIC = ["market", "school", "hospital", "church", "store", "shop", "office", "restaurant", "pharmacy", "terminal"]


def accepted(meters: Column, score: Column, a: Column, b: Column) -> Column:
    """The tiered rule: the farther apart, the more alike the names must be."""
    generic = a.isin(GENERIC) | b.isin(GENERIC) | (F.length(a) <= 4) | (F.length(b) <= 4)
    need = F.when(meters <= 20, 0.70).when(meters <= 50, 0.82).when(meters <= 90, 0.90).otherwise(0.94)
    return (a != "") & (b != "") & (meters <= REACH_M) & F.when(generic, (meters <= 15) & (score >= 0.99)).otherwise(score >= need)


def candidate_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id, meters, score, strength) of the pairs the rule accepts.

    Inputs are (id, name, lon, lat) with unique ids; rows without position or name pair with nothing.
    """
    sides = [s.select("id", fold("name").alias("k"), F.col("lon").alias("x"), F.col("lat").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND k <> ''") for s in (left, right)]
    near = neighbours_in_grid(sides[0], sides[1], CELL).select(
        F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), F.col("a.k").alias("ka"), F.col("b.k").alias("kb"), haversine_m("a.x", "a.y", "b.x", "b.y").alias("meters")).filter(F.col("meters") <= REACH_M)
    scored = with_similarity(near, "ka", "kb").filter(accepted(F.col("meters"), F.col("score"), F.col("ka"), F.col("kb")))
    return scored.select("left_id", "right_id", "meters", "score", (0.82 * F.col("score") + 0.18 * (1 - F.col("meters") / REACH_M)).alias("strength"))


def _tied_by_rank(ranked: DataFrame) -> DataFrame:
    """The pairs (left_id, right_id) of groups in which every left place is equally best with every right one.

    ``ranked`` has the levels ``ta`` and ``tb`` of a pair among those of its left and of its right side.
    In a group that is complete and closed the greedy order pairs both sides by rank.
    """
    sets = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(F.col(c).cast("string"))), "\n"), 256)
    lefts = ranked.filter("ta = 1").groupBy("left_id").agg(sets("right_id").alias("sl"), F.count(F.lit(1)).alias("nr"))
    rights = ranked.filter("tb = 1").groupBy("right_id").agg(sets("left_id").alias("sr"), F.count(F.lit(1)).alias("nl"))
    both = ranked.filter("ta = 1 AND tb = 1").join(lefts.filter("nr > 1"), "left_id").join(rights.filter("nl > 1"), "right_id")
    whole = both.groupBy("sl", "sr").agg(F.count(F.lit(1)).alias("n"), F.first("nl").alias("nl"), F.first("nr").alias("nr")).filter("n = nl * nr").select("sl", "sr")
    group = W.partitionBy("sl", "sr")
    placed = both.join(whole, ["sl", "sr"]).withColumn("i", F.dense_rank().over(group.orderBy("left_id"))).withColumn("j", F.dense_rank().over(group.orderBy("right_id")))
    return placed.filter("i = j").select("left_id", "right_id")


def one_to_one(pairs: DataFrame) -> DataFrame:
    """The greedy matching in the order strength down, distance, left, right.

    A pair that is first for both its sides is always taken by the greedy order, so rounds of mutual
    firsts give the same result; each round keeps the pairs and drops their sides, until no pair is
    left.  Groups of equally good pairs are matched by rank, all in one round.  Pairs without an id drop out.
    """
    level = [F.col("strength").desc(), F.col("meters").asc()]
    order = [*level, F.col("left_id").asc(), F.col("right_id").asc()]
    left = cut(pairs.filter("left_id IS NOT NULL AND right_id IS NOT NULL"))
    taken = None
    while not left.isEmpty():
        a, b = W.partitionBy("left_id"), W.partitionBy("right_id")
        ranked = cut(left.select("*", F.row_number().over(a.orderBy(*order)).alias("a"), F.rank().over(a.orderBy(*level)).alias("ta"), F.row_number().over(b.orderBy(*order)).alias("b"), F.rank().over(b.orderBy(*level)).alias("tb")))
        keys = ranked.filter("a = 1 AND b = 1").select("left_id", "right_id").unionByName(_tied_by_rank(ranked)).distinct()
        chosen = cut(left.join(keys, ["left_id", "right_id"]).select(*left.columns).dropDuplicates(["left_id", "right_id"]))
        taken = chosen if taken is None else taken.unionByName(chosen)
        left = cut(left.join(chosen.select("left_id"), "left_id", "left_anti").join(chosen.select("right_id"), "right_id", "left_anti"))
    return taken if taken is not None else left


def reconciled(left: DataFrame, right: DataFrame, left_source: str = "osm", right_source: str = "overture") -> DataFrame:
    """One row per real place: matched pairs at their midpoint, then the places of one source only.

    Inputs are (id, name, category, lon, lat, license, providers).
    """
    match = one_to_one(candidate_pairs(left, right))
    a, b = left.alias("a"), right.alias("b")
    both = match.join(a, F.col("left_id") == F.col("a.id")).join(b, F.col("right_id") == F.col("b.id"))
    name = pick_name(F.col("a.name"), F.col("b.name"))
    terms = lambda c: F.array_join(F.array_sort(F.array_distinct(F.filter(c, lambda v: v != ""))), "|")
    parts = lambda v: F.split(clean_text(v), r"\s*\|\s*")
    pairs = both.select(
        place_id(F.array(F.concat(F.lit(left_source + ":"), F.col("left_id").cast("string")), F.concat(F.lit(right_source + ":"), F.col("right_id").cast("string")))).alias("poi_id"), name.alias("name"),
        combine(["a.category", "b.category"]).alias("category"), ((F.col("a.lon") + F.col("b.lon")) / 2).alias("lon"), ((F.col("a.lat") + F.col("b.lat")) / 2).alias("lat"), F.lit(2).alias("source_count"),
        F.array_sort(F.array_distinct(F.array_except(F.array("a.name", "b.name"), F.array(name)))).alias("aliases"), F.round("meters", 3).alias("match_distance_m"), F.round("score", 4).alias("match_name_score"),
        terms(F.concat(parts("a.license"), parts("b.license"))).alias("licenses"))
    alone = []
    for side, source, key in ((left, left_source, "left_id"), (right, right_source, "right_id")):
        rest = side.join(match.select(F.col(key).alias("id")), "id", "left_anti")
        alone.append(rest.select(
            place_id(F.array(F.concat(F.lit(source + ":"), F.col("id").cast("string")))).alias("poi_id"), F.col("name"), clean_text("category").alias("category"), "lon", "lat", F.lit(1).alias("source_count"),
            F.array().cast("array<string>").alias("aliases"), F.lit(None).cast("double").alias("match_distance_m"), F.lit(None).cast("double").alias("match_name_score"), terms(parts("license")).alias("licenses")))
    return pairs.unionByName(alone[0]).unionByName(alone[1])


def registry_match(records: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, status, n) of records looked up by key: MATCH for one entry, AMBIGUOUS for several, CONFLICT
    when the only entries stand in another city, NONE without entry.  Both are (id, key, city)."""
    entries = registry.filter("key <> ''").select(F.col("id").alias("entry"), "key", F.col("city").alias("entry_city"))
    joined = records.join(entries, "key", "left")
    agree = F.col("entry").isNotNull() & ((F.coalesce("city", F.lit("")) == "") | (F.coalesce("entry_city", F.lit("")) == "") | (F.col("city") == F.col("entry_city")))
    counted = joined.groupBy("id").agg(F.countDistinct(F.when(agree, F.col("entry"))).alias("good"), F.countDistinct("entry").alias("n"))
    status = F.when(F.col("n") == 0, "NONE").when(F.col("good") == 1, "MATCH").when(F.col("good") > 1, "AMBIGUOUS").otherwise("CONFLICT")
    return counted.select("id", status.alias("status"), "n")


def layered(first: DataFrame, second: DataFrame) -> DataFrame:
    """(id, status) of two lookups: the first that matches; both matching is ambiguous."""
    both = first.select("id", F.col("status").alias("a")).join(second.select("id", F.col("status").alias("b")), "id", "full_outer")
    a, b = F.coalesce("a", F.lit("NONE")), F.coalesce("b", F.lit("NONE"))
    return both.select("id", F.when((a == "MATCH") & (b == "MATCH"), "AMBIGUOUS").when(a != "NONE", a).otherwise(b).alias("status"))


def provinces(localities: DataFrame) -> DataFrame:
    """(province, localities, codes, bounding box) by grouping localities."""
    return localities.groupBy("province").agg(
        F.count(F.lit(1)).alias("localities"), F.array_join(F.array_sort(F.collect_set("psgc")), "|").alias("codes"),
        F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"), F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"))


def augmented(canonical: DataFrame, extra: DataFrame) -> DataFrame:
    """Canonical places with a second source matched in: weighted centroid by source_count, new rows added.

    ``canonical`` is (id, name, lon, lat, source_count), ``extra`` (id, name, lon, lat); the result adds
    ``extra_id`` and ``status`` (matched, kept, new).
    """
    match = one_to_one(candidate_pairs(canonical, extra)).select("left_id", "right_id")
    b = extra.select(F.col("id").alias("right_id"), F.col("lon").alias("xlon"), F.col("lat").alias("xlat"))
    joined = canonical.join(match.join(b, "right_id"), F.col("id") == F.col("left_id"), "left")
    n = F.col("source_count")
    moved = lambda own, other: F.when(F.col("right_id").isNull(), F.col(own)).otherwise((F.col(own) * n + F.col(other)) / (n + 1))
    old = joined.select("id", "name", moved("lon", "xlon").alias("lon"), moved("lat", "xlat").alias("lat"), (n + F.col("right_id").isNotNull().cast("int")).alias("source_count"), F.col("right_id").alias("extra_id"), F.when(F.col("right_id").isNull(), "kept").otherwise("matched").alias("status"))
    new = extra.join(match.select(F.col("right_id").alias("id")), "id", "left_anti").select(F.concat(F.lit("new:"), F.col("id").cast("string")).alias("id"), "name", "lon", "lat", F.lit(1).alias("source_count"), F.col("id").alias("extra_id"), F.lit("new").alias("status"))
    return old.withColumn("id", F.col("id").cast("string")).unionByName(new)
