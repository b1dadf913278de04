"""Reading place sources, input-output tables and registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terralane.functions.text import clean_text, fold

# Tag keys that make a named object a point of interest, keys of which some values do, and
# the keys whose tags follow those in a category.
POI_KEYS = ["amenity", "shop", "office", "craft", "tourism", "leisure", "healthcare", "industrial", "man_made", "club", "emergency", "public_transport"]
POI_VALUES = {"aeroway": ["aerodrome", "terminal"], "railway": ["station", "halt", "tram_stop", "subway_entrance"]}
DETAIL_KEYS = ["cuisine", "brand", "operator"]
# Licences of the records that may be used, how they are written, the licence of the records
# of a provider that states none, providers that may not be used, and how providers are written.
ALLOWED_LICENSES = ["CDLA-Permissive-2.0", "Apache-2.0", "CC0-1.0"]
LICENSE_SPELLINGS = {
    "cdla-permissive-2.0": "CDLA-Permissive-2.0", "cdla permissive 2.0": "CDLA-Permissive-2.0", "apache-2.0": "Apache-2.0",
    "apache 2.0": "Apache-2.0", "cc0-1.0": "CC0-1.0", "cc0 1.0": "CC0-1.0",
}
PROVIDER_LICENSES = {
    "meta": "CDLA-Permissive-2.0", "microsoft": "CDLA-Permissive-2.0", "pinmeto": "CDLA-Permissive-2.0", "krick": "CDLA-Permissive-2.0",
    "renderseo": "CDLA-Permissive-2.0", "dac": "CDLA-Permissive-2.0", "brightquery": "CDLA-Permissive-2.0", "alltheplaces": "CC0-1.0",
}
EXCLUDED_PROVIDERS = ["foursquare"]
PROVIDER_SPELLINGS = {
    "all_the_places": "alltheplaces", "all-the-places": "alltheplaces", "all the places": "alltheplaces", "foursquare_places": "foursquare",
    "microsoft_places": "microsoft", "meta_places": "meta",
}
LEGACY_SPELLINGS = {"all_the_places": "alltheplaces", "all the places": "alltheplaces", "pin me to": "pinmeto"}
#: Licence term of legacy records with an unknown provider or none.
REVIEW_TERM = "OVERTURE-PLACES-REVIEW"


def _tag(tags: Column, key: str) -> Column:
    return F.coalesce(clean_text(F.element_at(tags, key)), F.lit(""))


def is_poi(tags: Column) -> Column:
    """Whether a map of tags holds a name and a key of interest, or one of the chosen values of the other keys."""
    named = (_tag(tags, "name") != "") | (_tag(tags, "name:en") != "")
    found = F.lit(False)
    for key in POI_KEYS:
        found = found | (_tag(tags, key) != "")
    for key, allowed in POI_VALUES.items():
        found = found | _tag(tags, key).isin(allowed)
    return F.coalesce(named & found, F.lit(False))


def category_text(tags: Column) -> Column:
    """``key=value`` of the category keys in order, then the details, joined by `` | ``."""
    parts = [F.when(_tag(tags, k) != "", F.concat(F.lit(k + "="), _tag(tags, k))) for k in [*POI_KEYS, *POI_VALUES, *DETAIL_KEYS]]
    return F.array_join(F.array_compact(F.array(*parts)), " | ")


def primary_name(names: Column) -> Column:
    """The primary name of a names struct, else the first nonblank common name."""
    common = F.filter(F.transform(F.map_values(names["common"]), lambda v: clean_text(v)), lambda v: v != "")
    return F.when(clean_text(names["primary"]) != "", clean_text(names["primary"])).otherwise(F.coalesce(F.get(common, F.lit(0)), F.lit("")))


def category_list(primary: Column, alternates: Column, basic: Column) -> Column:
    """Categories in order, the first of equal comparison forms only, joined by `` | ``."""
    items = F.filter(F.transform(F.concat(F.array(primary), F.coalesce(alternates, F.array().cast("array<string>")), F.array(basic)), lambda v: F.struct(clean_text(v).alias("v"), fold(v).alias("k"))), lambda x: x["k"] != "")
    keys = F.transform(items, lambda y: y["k"])
    return F.array_join(F.transform(F.filter(items, lambda x, i: F.array_position(keys, x["k"]) == i + 1), lambda x: x["v"]), " | ")


def _spelt(c: Column, spellings: dict[str, str], otherwise: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in spellings.items() for x in kv])[c], otherwise)


def provider_key(c: Column, head_only: bool = False) -> Column:
    """Comparison form of a provider; of a dataset (``head_only``) what stands before the first slash."""
    raw = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    raw = F.trim(F.substring_index(raw, "/", 1)) if head_only else raw
    return F.regexp_replace(_spelt(raw, PROVIDER_SPELLINGS, raw), "[ _-]", "")


def source_decision(sources: Column) -> Column:
    """Struct (allowed, licenses, providers, reason) of the source items (dataset, provider, license) of a record.

    Every item must have an allowed licence, stated or, where none is stated, known for its dataset or
    provider; an excluded dataset or provider refuses the record.  Reasons: permitted, missing (no items),
    excluded, unresolved (an item without allowed licence).  Licences are those of the permitted items,
    providers those of all items, a dataset standing in for a missing provider; both sorted, joined by ``|``.
    """
    items = F.transform(F.coalesce(sources, F.array().cast("array<struct<dataset:string,provider:string,license:string>>")), lambda x: F.struct(
        provider_key(x["dataset"], head_only=True).alias("d"), provider_key(x["provider"]).alias("p"), F.trim(F.coalesce(x["license"], F.lit(""))).alias("l")))
    known = F.create_map(*[F.lit(v) for kv in PROVIDER_LICENSES.items() for v in kv])
    resolved = F.transform(items, lambda x: F.struct(
        F.coalesce(F.nullif(x["p"], F.lit("")), F.nullif(x["d"], F.lit(""))).alias("p"), (x["d"].isin(EXCLUDED_PROVIDERS) | x["p"].isin(EXCLUDED_PROVIDERS)).alias("banned"),
        F.when(x["l"] != "", _spelt(F.lower(x["l"]), LICENSE_SPELLINGS, x["l"])).otherwise(F.coalesce(known[x["d"]], known[x["p"]])).alias("l")))
    permitted = F.transform(resolved, lambda x: F.when(x["l"].isin(ALLOWED_LICENSES), x["l"]))
    reason = F.when(F.size(resolved) == 0, "missing").when(F.exists(resolved, lambda x: x["banned"]), "excluded").when(F.exists(permitted, lambda x: x.isNull()), "unresolved").otherwise("permitted")

    def joined(values: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(values))), "|")

    return F.struct((reason == "permitted").alias("allowed"), joined(permitted).alias("licenses"), joined(F.transform(resolved, lambda x: x["p"])).alias("providers"), reason.alias("reason"))


def legacy_providers(values: Column) -> Column:
    """Sorted distinct comparison forms of an array of legacy provider names; blanks fall away."""
    def key(v: Column) -> Column:
        text = F.trim(F.regexp_replace(F.lower(F.coalesce(v, F.lit(""))), "[^a-z0-9_ ]+", ""))
        return _spelt(text, LEGACY_SPELLINGS, F.replace(text, F.lit(" "), F.lit("")))

    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), key), lambda v: v != "")))


def legacy_terms(values: Column) -> Column:
    """Licence terms of legacy provider names joined by ``|``; an unknown provider, or none, adds the review term."""
    providers = legacy_providers(values)
    known = F.create_map(*[F.lit(v) for kv in PROVIDER_LICENSES.items() for v in kv])
    terms = F.array_sort(F.array_distinct(F.array_compact(F.transform(providers, lambda v: known[v]))))
    review = (F.size(providers) == 0) | F.exists(providers, lambda v: known[v].isNull())
    return F.array_join(F.when(review, F.array_append(terms, F.lit(REVIEW_TERM))).otherwise(terms), "|")


def legacy_allowed(values: Column) -> Column:
    """Whether there is a provider and all are known."""
    providers = legacy_providers(values)
    return (F.size(providers) > 0) & F.forall(providers, lambda v: v.isin(list(PROVIDER_LICENSES)))


def scan_places(places: DataFrame, box: tuple[float, float, float, float], name: str, lon: str, lat: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept, reasons) of a bounded scan: the box is a plain range filter that reaches the files; rows
    without id, name or position are counted by the first reason that applies."""
    x0, y0, x1, y1 = box
    inside = places.filter(F.col(lon).between(x0, x1) & F.col(lat).between(y0, y1))
    reason = F.when(clean_text(key) == "", "no id").when(clean_text(name) == "", "no name").otherwise("kept")
    marked = inside.withColumn("reason", reason)
    return marked.filter("reason = 'kept'").drop("reason"), marked.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def io_table(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst, value) of a square CSV table whose first column names the rows; codes stay text.

    The same codes must stand on both axes and no value may be missing or negative.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False)
    key, *codes = raw.columns
    long = raw.select(F.trim(F.col(key)).alias("src"), F.explode(F.map_from_arrays(F.array(*[F.lit(c.strip()) for c in codes]), F.array(*[F.col(f"`{c}`") for c in codes]))).alias("dst", "v"))
    value = F.col("v").try_cast("double")
    checked = F.when(value.isNull() | F.isnan(value) | (value < 0), F.raise_error(F.concat(F.lit("bad value at "), "src", F.lit("/"), "dst"))).otherwise(value)
    # rows are counted and compared where they are: as many distinct codes as columns, all of them columns
    named = raw.select(F.trim(F.col(key)).alias("c")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c").alias("d"), F.sum((~F.coalesce(F.col("c").isin([c.strip() for c in codes]), F.lit(False))).cast("long")).alias("other")).first()
    if (named["n"], named["d"], named["other"] or 0) != (len(codes), len({c.strip() for c in codes}), 0):
        raise ValueError("the rows and columns of the table do not have the same codes")
    return long.select("src", "dst", checked.alias("value"))


def text_csv(spark: SparkSession, path: str, columns: list[str], unique: list[str] | None = None) -> DataFrame:
    """A CSV file read as text only; the header must hold the columns and ``unique`` must not repeat."""
    from terralane.operators.relational import require_unique

    df = spark.read.csv(path, header=True, inferSchema=False, nullValue=None, emptyValue="")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    df = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])
    return require_unique(df, unique) if unique else df


POINT_SCHEMA = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])


def checked_points(df: DataFrame) -> DataFrame:
    """Points (source_id, name, lon, lat, ...) after one query over all rules; a ValueError names what fails."""
    have = {f.name for f in df.schema.fields}
    lacking = [f.name for f in POINT_SCHEMA if f.name not in have]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    bad = df.agg(
        F.sum((clean_text("source_id") == "").cast("int")).alias("blank id"), F.sum((clean_text("name") == "").cast("int")).alias("blank name"),
        F.sum((~F.coalesce(F.col("lon").between(-180, 180) & F.col("lat").between(-90, 90), F.lit(False))).cast("int")).alias("bad position"),
        (F.count("source_id") - F.countDistinct("source_id")).alias("repeated id")).first().asDict()
    failed = {k: v for k, v in bad.items() if v}
    if failed:
        raise ValueError(f"input refused: {failed}")
    return df


def utm_zone(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone of a position, 326xx north and 327xx south."""
    zone = F.least(F.lit(60), F.floor((lon + 180) / 6) + 1)
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")


def transaction_block(sheet: list[list], labels: int) -> tuple[int, int]:
    """(row, column) of the first cell of an n x n block whose label sequence stands across and down.

    The label row lies directly above the block and the label column directly left of it; the topmost,
    then left-most block wins; ValueError without one.  A sheet is small and read on the driver.
    """
    text = [["" if v is None else str(v).strip() for v in row] for row in sheet]
    for r in range(len(text)):
        for c in range(len(text[r]) - labels):
            across = text[r][c + 1 : c + 1 + labels]
            if len(across) == labels and all(across) and len(set(across)) == labels:
                down = [text[i][c] if c < len(text[i]) else "" for i in range(r + 1, min(len(text), r + 1 + labels))]
                if down == across:
                    return r + 1, c + 1
    raise ValueError("no square block with the same labels on both sides")


def total_output_column(header: list[str]) -> int:
    """Position of the one header that reads total output; ValueError for none or several."""
    found = [i for i, h in enumerate(header) if " ".join(str(h or "").lower().split()) == "total output"]
    if len(found) != 1:
        raise ValueError(f"{len(found)} columns read total output")
    return found[0]
