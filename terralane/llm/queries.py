"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terralane.llm import abuse, addresses, gazetteer, institutions, leakage, matching, mixing, survivor
from terralane.session import table

OPERATORS, WEBSITES = ["osm_operator", "overture_operator"], ["osm_website", "overture_website"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivor.best_values(table(spark, sf_dir, "places"), "canonical_id", OPERATORS, WEBSITES)


def _institution_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    official = institutions.named_rows(table(spark, sf_dir, "registry_qc_official_sources"), "rec_id", "name", "aliases")
    hospitals = institutions.named_rows(table(spark, sf_dir, "philhealth_level3"), "rec_id", "name_of_health_facility", None)
    return official.unionByName(hospitals)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return institutions.same_institution_pairs(_institution_names(spark, sf_dir))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The institution of every named row and the number of other rows that mean it."""
    classes = institutions.institution_classes(_institution_names(spark, sf_dir)).withColumnRenamed("k", "rec_id")
    return institutions.class_rows(classes, "rec_id", "institution")


ADDRESSES = [("registry_qc_official_sources", "address", "city"), ("philhealth_level3", "street", "municipality"), ("osm_places", "osm_address", "osm_city"), ("overture_places", "overture_address", "overture_city")]


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = None
    for name, address, city in ADDRESSES:
        part = table(spark, sf_dir, name).select("rec_id", F.col(address).alias("address"), F.col(city).alias("city"))
        records = part if records is None else records.unionByName(part)
    return records


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.same_address_pairs(_addresses(spark, sf_dir), table(spark, sf_dir, "area_localities"))


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location of every record with a full address and the number of other records that give it."""
    classes = addresses.same_address_classes(_addresses(spark, sf_dir), table(spark, sf_dir, "area_localities"))
    return institutions.class_rows(classes, "rec_id", "address_class")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "area_localities")
    columns = [("philhealth_level3", "municipality"), ("osm_places", "osm_city"), ("overture_places", "overture_city")]
    typed = None
    for name, column in columns:
        part = table(spark, sf_dir, name).select("rec_id", F.col(column).alias("value")).filter(F.col("value").rlike(r"[^\s\u00a0]"))
        typed = part if typed is None else typed.unionByName(part)
    # a value that is, character for character, a name that occurs once needs no mapping
    rows = gazetteer.entries(places)
    once = [n for n, c in Counter(name for _, name, _ in rows).items() if c == 1]
    cases = typed.filter(~F.col("value").isin(once))
    return gazetteer.map_values(cases, "rec_id", "value", places).select("rec_id", "psgc")


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of places that are one, with their score and calibrated confidence."""
    found = matching.match_sources(table(spark, sf_dir, "osm_places"), "osm", table(spark, sf_dir, "overture_places"), "overture", table(spark, sf_dir, "area_localities"))
    return found.select(F.col("left_sid").alias("osm_id"), F.col("right_sid").alias("overture_id"), F.round("score", 6).alias("score"), F.round("confidence", 6).alias("confidence"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_matches(spark, sf_dir).select("osm_id", "overture_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the mix: targets, actual shares and repeats of every listed source."""
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "source_targets"))[1]


def p9_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix itself: how often every document of a listed source is taken."""
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "source_targets"))[0].withColumn("rate", F.round("rate", 6))


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, with the categories of its worst sentence."""
    documents = table(spark, sf_dir, "documents")
    return abuse.scored(documents, abuse.train(documents, table(spark, sf_dir, "doc_labels")), extra=["source"])


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).filter(F.col("score") >= abuse.THRESHOLD).select("doc_id")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate of flagged documents of every source."""
    return abuse.rates(p10_scores(spark, sf_dir)).withColumn("rate", F.round("rate", 6)).withColumn("mean_score", F.round("mean_score", 6))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_classes": p2_classes, "p3_found": p3_found, "p3_classes": p3_classes, "p4_found": p4_found, "p6_found": p6_found, "p6_matches": p6_matches, "p8_found": p8_found, "p9_mix": p9_mix, "p9_copies": p9_copies, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates}

def _p1_sql() -> str:
    """Survivors stated without a skyline: the first value in the order of the policy."""
    short = "' ' || regexp_replace(lower(v), '\\s+', ' ', 'g') || ' '"
    short = f"regexp_replace({short}, '[.,]+ ', ' ', 'g')"
    for a, b in survivor.SHORT_FORMS.items():
        a, b = a.replace("'", "''"), b.replace("'", "''")
        short = f"replace({short}, ' {a} ', ' {b} ')"
    url = "regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(v, '\\s+', '', 'g')), '^h?t?tps?\\b[:/]*', ''), '^www\\.?', ''), '[/?#]+$', '')"
    placeholders = ", ".join(f"'{x}'" for x in survivor.PLACEHOLDERS)
    rows = " UNION ALL ".join(f"SELECT canonical_id AS g, '{f}' AS f, {int(f in WEBSITES)} AS u, {f} AS v, observed_at AS seen, CASE review_state WHEN 'verified' THEN 2 WHEN 'rejected' THEN 0 ELSE 1 END AS trust FROM places WHERE canonical_id IS NOT NULL" for f in OPERATORS + WEBSITES)
    return f"""WITH o AS ({rows}),
c AS (SELECT g, f, u, v, max(CASE WHEN trust > 0 THEN seen END) AS seen, max(trust) AS trust FROM o GROUP BY 1, 2, 3, 4),
m AS (SELECT g, f FROM c GROUP BY 1, 2 HAVING count(*) > 1),
w AS (SELECT c.*, CASE WHEN u = 1 THEN {url} ELSE trim({short}) END AS norm,
  CASE WHEN u = 1 THEN CASE WHEN regexp_matches(v, '^https://[^/\\s]+\\.[^/\\s]+/\\S+$') AND NOT regexp_matches(v, '[/?#]$') THEN 4 ELSE 0 END + CASE WHEN regexp_matches(v, '^https?://\\S+$') THEN 2 ELSE 0 END + CASE WHEN v = lower(v) THEN 1 ELSE 0 END
       ELSE CASE WHEN v <> upper(v) AND v <> lower(v) THEN 2 ELSE 0 END + CASE WHEN v = trim(regexp_replace(v, '\\s+', ' ', 'g')) AND NOT regexp_matches(v, '[.,;]$') THEN 1 ELSE 0 END END AS style
  FROM c JOIN m USING (g, f) WHERE v IS NOT NULL AND trust > 0 AND lower(trim(regexp_replace(v, '\\s+', ' ', 'g'))) NOT IN ({placeholders})),
x AS (SELECT DISTINCT g, f, norm FROM w),
top AS (SELECT * FROM x a WHERE NOT EXISTS (SELECT 1 FROM x b WHERE b.g = a.g AND b.f = a.f AND b.norm <> a.norm AND starts_with(b.norm, a.norm) AND left(b.norm, {survivor.SPLIT}) = left(a.norm, {survivor.SPLIT}))),
i AS (SELECT x.g, x.f, x.norm, min(top.norm) AS identity FROM x JOIN top ON x.g = top.g AND x.f = top.f AND starts_with(top.norm, x.norm) AND left(top.norm, {survivor.SPLIT}) = left(x.norm, {survivor.SPLIT}) GROUP BY 1, 2, 3),
b AS (SELECT w.*, identity, max(seen) OVER k AS recency, max(trust) OVER k AS most, row_number() OVER (PARTITION BY w.g, w.f, identity ORDER BY (w.norm = identity) DESC, length(w.norm) DESC, style DESC, trust DESC, seen DESC, v DESC) AS n
  FROM w JOIN i ON w.g = i.g AND w.f = i.f AND w.norm = i.norm WINDOW k AS (PARTITION BY w.g, w.f, identity)),
p AS (SELECT *, CASE WHEN length(identity) < {survivor.SPLIT} THEN 1 WHEN style >= CASE WHEN u = 1 THEN 7 ELSE 3 END THEN 3 ELSE 2 END AS complete FROM b WHERE n = 1)
SELECT g AS canonical_id, f AS field_name, v AS field_value FROM p
QUALIFY row_number() OVER (PARTITION BY g, f ORDER BY complete > 1 DESC, recency DESC, complete DESC, most DESC, v DESC) = 1"""


_WORDS = "regexp_extract_all(lower(strip_accents(regexp_replace(coalesce(text, ''), '[''\u2019\u02bc\u00ad\u200b-\u200d\u2060\ufeff]', '', 'g'))), '[\\p{L}\\p{N}]+')"
#: Leaks by word runs: seven equal words in a row give the alignment, which is then counted out.
_P8_SQL = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, {_WORDS} AS w FROM eval_items),
dg AS (SELECT doc_id, p, array_to_string(w[p:p + 6], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 5)) AS p FROM d WHERE len(w) >= 15)),
ig AS (SELECT item_id, p, array_to_string(w[p:p + 6], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 5)) AS p FROM i WHERE len(w) >= 15)),
c AS (SELECT DISTINCT doc_id, item_id, dg.p - ig.p AS s FROM dg JOIN ig USING (g)),
m AS (SELECT doc_id, item_id, list_transform(range(greatest(1, 1 - s), least(len(i.w), len(d.w) - s) + 1), lambda q: CASE WHEN d.w[q + s] = i.w[q] THEN 1 ELSE 0 END) AS e FROM c JOIN d USING (doc_id) JOIN i USING (item_id))
SELECT DISTINCT doc_id, item_id FROM m WHERE len(e) >= 15 AND list_max(list_transform(range(1, len(e) - 13), lambda k: list_sum(e[k:k + 14]))) >= 14"""

ORACLE: dict[str, str] = {"p1_found": _p1_sql(), "p8_found": _P8_SQL}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
