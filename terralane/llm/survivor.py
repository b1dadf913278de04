"""Best representative of each duplicate group: a skyline of records, filled up layer by layer.

A record is a point in (completeness of every field, recency, trust).  A record dominates another if it
is at least as complete in every field, as recent and as trusted, and better in one of them.  The
undominated records are layer 1, the records that only they dominate layer 2, and so on.  The survivor is
the first record of layer 1 by the policy recency, completeness, trust, text; what it lacks is filled
from the other records of its layer and then from the next layers, in the same order.  Writings of one
value (cut, abbreviated, restyled) share an identity, and the value that comes out is its fullest and
most ordinary writing.

Completeness has few levels, so of the records of one group that agree in it and in trust only the
latest can be first anywhere: these representatives are found by one aggregation with map-side combine,
and layers are formed among them.  Completeness is taken field by field because the value observed last
has to survive: a count of filled fields would let an older, fuller record displace it.

All steps are aggregations, a salted semi-join and joins by value; the one window (group, field, start of
the text) streams over distinct writings.  A group that holds a third of all rows is never held in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Texts that say "nothing known".
PLACEHOLDERS = ["", "-", "--", ".", "?", "n/a", "na", "n.a.", "nan", "nil", "no", "none", "not applicable", "not available", "null", "tba", "tbd", "to follow", "unknown", "x", "yes"]
# Short forms in legal names that are no beginnings of the full word.
SHORT_FORMS = {"mgt": "management", "mgmt": "management", "intl": "international", "dev't": "development", "devt": "development", "bros": "brothers", "mfg": "manufacturing", "svcs": "services", "ent'prises": "enterprises", "ltd": "limited"}
#: Characters of a normal form by which hot groups are split.
SPLIT = 3
#: Tasks over which the rows of one group are spread.
SALTS = 8
#: Trust of a row by its review state; rows of other states have trust 1.
TRUST = {"verified": 2, "rejected": 0}


def is_placeholder(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))).isin(PLACEHOLDERS)


def normal_text(c: Column) -> Column:
    """Lower case, single blanks, no punctuation at word ends, short forms written out."""
    out = F.concat(F.lit(" "), F.regexp_replace(F.lower(c), r"[\s ]+", " "), F.lit(" "))
    out = F.regexp_replace(out, r"[.,]+(?= )", "")
    for short, full in SHORT_FORMS.items():
        out = F.regexp_replace(out, f" {short} ", f" {full} ")
    return F.trim(out)


def normal_url(c: Column) -> Column:
    """Host and path in lower case, without scheme (also a damaged one), ``www.`` and final slash."""
    out = F.lower(F.regexp_replace(c, r"\s+", ""))
    out = F.regexp_replace(out, r"^h?t?tps?\b[:/]*", "")
    return F.regexp_replace(F.regexp_replace(out, r"^www\.?(?=.|$)", ""), r"[/?#]+$", "")


def ordinary_text(c: Column) -> Column:
    """2: mixed case and clean blanks, 1: clean blanks, 0: neither."""
    clean = (c == F.trim(F.regexp_replace(c, r"\s+", " "))) & ~c.rlike(r"[.,;]$")
    mixed = (c != F.upper(c)) & (c != F.lower(c))
    return mixed.cast("int") * 2 + clean.cast("int")


def ordinary_url(c: Column) -> Column:
    """Higher for an https address in lower case with host and path and without blanks."""
    whole = c.rlike(r"^https://[^/\s]+\.[^/\s]+/\S+$") & ~c.rlike(r"[/?#]$")
    scheme = c.rlike(r"^https?://\S+$")
    return whole.cast("int") * 4 + scheme.cast("int") * 2 + (c == F.lower(c)).cast("int")


def _salted(rows: DataFrame) -> DataFrame:
    """The rows of groups of several rows; the join is salted, so that a hot group is spread."""
    several = rows.groupBy("g").count().filter("count > 1").select("g", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", F.pmod(F.hash("v", "seen"), F.lit(SALTS))).join(several, ["g", "salt"], "left_semi")


def best_writings(rows: DataFrame, texts: int) -> DataFrame:
    """``(g, f, v, best)``: for every usable value of a field its fullest and most ordinary writing in the group.

    ``rows``: (g, seen, trust, v), v holding the fields, of which the first ``texts`` are names and the
    others addresses of websites.  A normal form that begins the next longer one is a cut writing of it; in
    descending order the extensions of a form stand directly before it, so a form belongs to the last
    form before it that is not itself the beginning of its own predecessor.
    """
    held = rows.filter("trust > 0").select("g", "seen", "trust", F.posexplode("v").alias("f", "v")).filter(F.col("v").isNotNull() & ~is_placeholder(F.col("v")))
    writings = held.groupBy("g", "f", "v").agg(F.max("seen").alias("seen"), F.max("trust").alias("trust"))
    is_url = F.col("f") >= texts
    norm = F.when(is_url, normal_url(F.col("v"))).otherwise(normal_text(F.col("v")))
    style = F.when(is_url, ordinary_url(F.col("v"))).otherwise(ordinary_text(F.col("v")))
    writings = writings.withColumn("norm", norm).withColumn("style", style).withColumn("part", F.substring("norm", 1, SPLIT))
    order = W.partitionBy("g", "f", "part").orderBy(F.col("norm").desc(), "v")
    cut = F.coalesce(F.startswith(F.lag("norm").over(order), F.col("norm")), F.lit(False))
    linked = writings.withColumn("cut", cut)
    linked = linked.withColumn("identity", F.last(F.when(~F.col("cut"), F.col("norm")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    # the first writing of an identity in this order is its best, the larger text among equals
    whole = F.col("norm") == F.col("identity")
    best = W.partitionBy("g", "f", "part", "identity").orderBy(whole.desc(), F.length("norm").desc(), F.col("style").desc(), F.col("trust").desc(), F.col("seen").desc(), F.col("v").desc())
    return linked.select("g", "f", "v", F.first("v").over(best.rowsBetween(W.unboundedPreceding, 0)).alias("best"))


def _level(value: Column, url: bool) -> Column:
    """Completeness of a field: 0 no value, 1 a stump too short to tell what it is cut from, 2 a value."""
    norm = normal_url(value) if url else normal_text(value)
    return F.when(value.isNull() | is_placeholder(value), 0).when(F.length(norm) < SPLIT, 1).otherwise(2)


def dominates(q: Column, p: Column, fields: int) -> Column:
    """Whether record q is at least as good as p in every dimension and better in one."""
    sides = [(q["seen"], p["seen"]), (q["trust"], p["trust"])] + [(q["full"][i], p["full"][i]) for i in range(fields)]
    at_least, more = sides[0][0] >= sides[0][1], sides[0][0] > sides[0][1]
    for a, b in sides[1:]:
        at_least, more = at_least & (a >= b), more | (a > b)
    return at_least & more


def with_layers(records: Column, fields: int, kind: str) -> Column:
    """The records (seen, total, trust, full, v) with their dominance layers as first field, in the order (layer, policy).

    In descending order of the policy every record stands after those that dominate it; its layer is
    one more than the deepest of theirs.
    """
    ordered = F.sort_array(records, asc=False)
    start = F.array().cast(f"array<struct<layer:int,{kind}>>")

    def place(done: Column, p: Column) -> Column:
        above = F.transform(F.filter(done, lambda q: dominates(q, p, fields)), lambda q: q["layer"])
        layer = (F.coalesce(F.array_max(above), F.lit(0)) + 1).cast("int")
        return F.concat(done, F.array(F.struct(layer.alias("layer"), *[p[n].alias(n) for n in ("seen", "total", "trust", "full", "v")])))

    # in the order of the policy already, so a layer by layer concatenation keeps it
    placed = F.aggregate(ordered, start, place)
    deepest = F.coalesce(F.array_max(F.transform(placed, lambda p: p["layer"])), F.lit(0))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(deepest, F.lit(1))), lambda k: F.filter(placed, lambda p: p["layer"] == k)))


def best_values(df: DataFrame, key: str, text_fields: list[str], url_fields: list[str], seen: str = "observed_at", state: str = "review_state", conflicts_only: bool = True) -> DataFrame:
    """``(key, field_name, field_value)``: the fields of the surviving record of every group.

    Rows whose state is ``rejected`` and placeholders give no values; a field without any value gives
    no row.  Rows without key belong to no group.  With ``conflicts_only`` only fields come out in
    which the rows of the group do not all hold the same content (null is a content of its own).  A
    row without ``seen`` is older than any other; equal recency is decided by completeness, trust and
    then the text, so repeated rows, ties and the order of rows change nothing.  A writing of fewer
    than ``SPLIT`` characters survives only where nothing longer is held.  Extra columns are ignored;
    an empty table gives an empty result.
    """
    fields = text_fields + url_fields
    n = len(fields)
    state_trust = F.create_map(*[F.lit(x) for kv in TRUST.items() for x in kv])
    rows = df.select(
        F.col(key).alias("g"),
        F.coalesce(F.col(seen).cast("timestamp"), F.lit("0001-01-01 00:00:00").cast("timestamp")).alias("seen"),
        F.coalesce(state_trust[F.coalesce(F.col(state), F.lit("?"))], F.lit(1)).alias("trust"),
        F.array(*[F.col(f).cast("string") for f in fields]).alias("v"),
    ).filter("g IS NOT NULL")
    # a group of one row has nothing to resolve
    if conflicts_only:
        rows = _salted(rows)

    # representatives of the records that agree in completeness and trust, and what tells conflicts
    full = F.when(F.col("trust") > 0, F.array(*[_level(F.col("v")[i], i >= len(text_fields)) for i in range(n)])).otherwise(F.array(*[F.lit(0)] * n))
    hashes = [F.xxhash64(F.col("v")[i], F.col("v")[i].isNull()).alias(f"h{i}") for i in range(n)]
    latest = rows.select("g", "seen", "trust", "v", full.alias("full"), *hashes).groupBy("g", "trust", "full").agg(
        F.max(F.struct("seen", "v")).alias("latest"), *[f(f"h{i}").alias(f"{m}{i}") for i in range(n) for m, f in (("low", F.min), ("high", F.max))])
    total = F.aggregate("full", F.lit(0), lambda a, x: a + x)
    record = F.struct(F.col("latest.seen").alias("seen"), total.alias("total"), "trust", "full", F.col("latest.v").alias("v"))
    grouped = latest.groupBy("g").agg(
        F.collect_list(F.when(total > 0, record)).alias("records"), F.array(*[F.min(f"low{i}") != F.max(f"high{i}") for i in range(n)]).alias("conflicts"))
    kind = "seen:timestamp,total:int,trust:int,full:array<int>,v:array<string>"
    layered = grouped.filter(F.size("records") > 0).select("g", "conflicts", with_layers(F.col("records"), n, kind).alias("records"))

    # the survivor is the first record; its missing fields come from the first record that holds them
    def first_at(i: int, level: int) -> Column:
        return F.get(F.filter("records", lambda p: p["full"][i] >= level), F.lit(0))["v"][i]

    def filled(i: int) -> Column:
        return F.coalesce(first_at(i, 2), first_at(i, 1))

    values = layered.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col("conflicts")[i].alias("conflict"), filled(i).alias("v")) for i in range(n)])).alias("x")).select("g", "x.*").filter("v IS NOT NULL")
    if conflicts_only:
        values = values.filter("conflict")
    found = values.select("g", "f", "v").join(best_writings(rows, len(text_fields)), ["g", "f", "v"])
    name = F.element_at(F.array(*[F.lit(x) for x in fields]), F.col("f") + 1)
    return found.select(F.col("g").alias(key), name.alias("field_name"), F.col("best").alias("field_value"))


def representatives(df: DataFrame, key: str, text_fields: list[str], url_fields: list[str], **columns: str) -> DataFrame:
    """One surviving record per group: ``key`` and the surviving value of every field, null where none is held."""
    best = best_values(df, key, text_fields, url_fields, conflicts_only=False, **columns)
    picks = [F.max(F.when(F.col("field_name") == f, F.col("field_value"))).alias(f) for f in text_fields + url_fields]
    groups = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return groups.join(best.groupBy(key).agg(*picks), key, "left")
