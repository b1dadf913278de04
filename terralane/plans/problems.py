"""Queries of the general data problems: packed fields, points near points or regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralane.operators.packed import unpack_fields
from terralane.operators.proximity import near_pairs, points_in_regions, positions
from terralane.session import table

PACKED = ["sources", "overture_providers", "io240_codes"]
NEAR_M = 50.0


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpack_fields(table(spark, sf_dir, "places"), "rec_id", PACKED, min_values=2)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "places")
    spots = positions(places, extra=[F.xxhash64("canonical_id").alias("grp")])
    near = near_pairs(spots, NEAR_M).select(F.lit("near").alias("relation"), "left_id", "right_id")
    within = points_in_regions(spots, table(spark, sf_dir, "area_localities"))
    return near.unionByName(within.select(F.lit("within").alias("relation"), F.col("rec_id").alias("left_id"), F.col("locality_id").alias("right_id")))


QUERIES = {"p5_found": p5_found, "p7_found": p7_found}

_SPLIT = """
SELECT rec_id, '{f}' AS field_name,
       list_filter(list_transform(regexp_extract_all({f}, '"[^"]*"|''[^'']*''|[^;,|/\\s\\[\\]"''][^;,|/\\t\\n\\[\\]]*'),
                                  lambda x: trim(trim(x, E' \\t\\n'), '"''')), lambda x: x <> '') AS v
FROM places"""

ORACLE = {
    "p5_found": "WITH s AS (" + " UNION ALL ".join(_SPLIT.format(f=f) for f in PACKED) + """)
SELECT rec_id, field_name, CAST(i AS INTEGER) AS item_no, v[i] AS item_value
FROM (SELECT rec_id, field_name, v, unnest(range(1, len(v) + 1)) AS i FROM s WHERE len(v) >= 2)""",
}
