"""Text functions as column expressions.

Everything stays in the JVM; accents of the Latin blocks are mapped by a fixed translation, so that
no Python function runs per row.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing value, in places and in classification texts.
NULL_WORDS = ["", "none", "null", "nan", "n/a", "na", "unknown"]
NULL_WORDS_STRICT = [*NULL_WORDS, "-", "others", "other"]


def _latin() -> tuple[str, str]:
    """Accented letters of the Latin blocks and the letters below the accents, derived from Unicode."""
    pairs = {}
    for code in range(0x00C0, 0x0250):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha():
            pairs[chr(code)] = base
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _latin()


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str, words: list[str] = NULL_WORDS) -> Column:
    """Trimmed text; null and null words become the empty text."""
    text = F.trim(F.coalesce(col(c).cast("string"), F.lit("")), F.lit(" \t\r\n "))
    return F.when(F.lower(text).isin(words), F.lit("")).otherwise(text)


def unaccent(c: Column | str) -> Column:
    return F.translate(F.regexp_replace(col(c), r"\p{M}+", ""), ACCENTED, PLAIN)


def fold(c: Column | str) -> Column:
    """Comparison form: lower case, ``&`` as and, accents off, runs of other characters one blank."""
    return F.trim(F.regexp_replace(unaccent(F.replace(F.lower(clean_text(c)), F.lit("&"), F.lit(" and "))), "[^a-z0-9]+", " "))


def combine(values: list[Column | str], separator: str = " | ") -> Column:
    """The nonblank values in order, the first of equal comparison forms only."""
    items = F.filter(F.transform(F.array(*[clean_text(v) for v in values]), lambda v: F.struct(v.alias("v"), fold(v).alias("k"))), lambda x: x["k"] != "")
    first = F.filter(items, lambda x, i: F.array_position(F.transform(items, lambda y: y["k"]), x["k"]) == i + 1)
    return F.array_join(F.transform(first, lambda x: x["v"]), separator)


def literal_key(c: Column | str) -> Column:
    """Keeps letters, digits and ``= : + & / . -``, collapses blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"[^\p{L}\p{N}_=:+&/.\- ]+", " "), r"\s+", " "))


def name_key(c: Column | str) -> Column:
    """Lower case, everything but letters and digits one blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def institution_key(c: Column | str) -> Column:
    """Comparison key of institution names: apostrophes gone, school shorthands written out, legal forms off."""
    text = F.regexp_replace(F.lower(unaccent(F.coalesce(col(c), F.lit("")))), "['’]", "")
    text = F.concat(F.lit(" "), F.trim(F.regexp_replace(text, "[^a-z0-9]+", " ")), F.lit(" "))
    for short, full in (("es", "elementary school"), ("nhs", "national high school"), ("hs", "high school"), ("st", "saint")):
        text = F.regexp_replace(text, f" {short} ", f" {full} ")
    return F.trim(F.regexp_replace(text, " (inc|corp|incorporated|corporation) $", ""))


def title_key(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(F.coalesce(col(c), F.lit(""))), F.lit("&"), F.lit(" and ")), "[^0-9a-z]+", " "))


def token_sort(c: Column | str) -> Column:
    return F.array_join(F.array_sort(F.split(col(c), " ")), " ")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence by one dynamic-programming row per letter of ``a``."""
    letters_a, letters_b = F.split(a, ""), F.split(b, "")
    start = F.transform(letters_b, lambda _: F.lit(0))

    def row(above: Column, x: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            left = F.when(j == 0, F.lit(0)).otherwise(F.element_at(acc, -1))
            diagonal = F.when(j == 0, F.lit(0)).otherwise(F.get(above, j - 1))
            value = F.when(x == F.get(letters_b, j), diagonal + 1).otherwise(F.greatest(left, F.get(above, j)))
            return F.concat(acc, F.array(value))

        return F.aggregate(F.sequence(F.lit(0), F.size(letters_b) - 1), F.array().cast("array<int>"), cell)

    table = F.aggregate(letters_a, start, row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(F.element_at(table, -1))


def indel_ratio(a: Column, b: Column) -> Column:
    """2 LCS / (length of both), the similarity under insertions and deletions."""
    return F.when(F.length(a) + F.length(b) == 0, F.lit(1.0)).otherwise(2 * lcs_length(a, b) / (F.length(a) + F.length(b)))


def name_similarity(a: Column, b: Column) -> Column:
    """The better of the ratio as written and with words sorted; 0 when either comparison form is blank."""
    best = F.greatest(indel_ratio(a, b), indel_ratio(token_sort(a), token_sort(b)))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(best)


def haversine_m(lon1: Column | str, lat1: Column | str, lon2: Column | str, lat2: Column | str) -> Column:
    """Great-circle distance on a sphere of radius 6,371,008.8 m; null where a coordinate is."""
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(col(lon2) - col(lon1)) / 2), 2)
    return F.when(h.isNotNull(), F.lit(2 * 6_371_008.8) * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def place_id(ids: Column) -> Column:
    """``ss_`` and twenty hex digits of the SHA-256 of the sorted source ids."""
    return F.concat(F.lit("ss_"), F.substring(F.sha2(F.array_join(F.array_sort(ids), "|"), 256), 1, 20))


def pick_name(a: Column, b: Column) -> Column:
    """The name with more words, then the longer, then the larger comparison form."""

    def quality(v: Column) -> Column:
        k = fold(v)
        return F.struct(F.when(k == "", 0).otherwise(F.size(F.split(k, " "))).alias("n"), F.length(k).alias("l"), k.alias("k"), v.alias("v"))

    return F.greatest(quality(a), quality(b))["v"]


def sector_code(c: Column | str) -> Column:
    """Whole numbers, also written with decimals of zero, get at least two digits; other labels stay."""
    text = F.trim(col(c).cast("string"))
    number = F.regexp_extract(text, r"^([0-9]+)(?:\.0+)?$", 1)
    return F.when(number != "", F.when(F.length(number) >= 2, number).otherwise(F.lpad(number, 2, "0"))).otherwise(text)


def round_significant(c: Column | str, digits: int) -> Column:
    """Rounded half to even to a number of significant digits; zero stays zero."""
    v = col(c).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(v))))
    return F.when(v == 0, F.lit(0.0)).otherwise(F.rint(v * scale) / scale)


def node_key(kind: Column | str, cluster: Column | str) -> Column:
    """``type=<percent-encoded>::cluster=<n>``."""
    return F.concat(F.lit("type="), F.replace(F.url_encode(col(kind)), F.lit("+"), F.lit("%20")), F.lit("::cluster="), col(cluster).cast("string"))


def tag_pairs(c: Column | str) -> Column:
    """``k=v;v2 | k2=v`` as an array of (key, value) pairs in order."""
    parts = F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\s*\|\s*"), lambda p: F.instr(p, "=") > 0)
    pairs = F.transform(parts, lambda p: F.transform(F.split(F.substring_index(p, "=", -1), r"\s*;\s*"), lambda v: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.trim(v).alias("value"))))
    return F.filter(F.flatten(pairs), lambda x: x["value"] != "")


def category_query(c: Column | str) -> Column:
    """A category as words: list brackets and quotes off, underscores as blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[\[\]'\"]", ""), "_", " "))


def effective_distance(d: Column, ra: Column, rb: Column) -> Column:
    return d + ra + rb


def hub_weight(a: Column, d: Column, decay: float) -> Column:
    """a / max(d, 1) ** decay."""
    return a * F.pow(F.greatest(d, F.lit(1.0)), F.lit(-decay))


def mercator(lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
    """Web-Mercator position in [0, 1]; latitude clamped to 85.051128 degrees."""
    y = F.greatest(F.lit(-85.051128), F.least(F.lit(85.051128), col(lat)))
    return (col(lon) + 180) / 360, (1 - F.asinh(F.tan(F.radians(y))) / F.pi()) / 2


def json_block(c: Column | str) -> Column:
    """The first {...} block of a text, null without one."""
    block = F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(?s)(\{.*\})", 1)
    return F.when(block != "", block)


def search_rank(name: Column, query: str) -> Column:
    """1 for names that begin with the query, 2 for names that hold it, null otherwise; queries of two letters or more."""
    q = query.strip().lower()
    text = F.lower(unaccent(name))
    if len(q) < 2:
        return F.lit(None).cast("int")
    return F.when(F.startswith(text, F.lit(q)), 1).when(F.instr(text, q) > 0, 2)
