"""Same postal address written differently: parsing, all plausible normalised forms, hashed joins.

An address is reduced to (house number or block and lot, street, kind of street, locality).  Parts
that make no difference (floor, unit, building, subdivision, barangay, corner street, landmark,
postal code, province) are recognised and set aside; what is left over names the locality, and the
city field stands in where the text names none.  Where a reading is not certain every plausible
reading becomes a form of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.llm.components import connected_components, pairs_within
from terralane.llm.gazetteer import PLACEHOLDERS, Gazetteer, built, entries, plain, unaccented
from terralane.session import cut

# How the kinds of street are written.
KINDS = {
    "street": ["street", "str", "st", "strt"],
    "road": ["road", "rd"],
    "avenue": ["avenue", "ave", "av", "aven"],
    "lane": ["lane", "ln"],
    "drive": ["drive", "drv", "dr"],
    "boulevard": ["boulevard", "boul", "blvd", "bvd", "boulv"],
    "highway": ["highway", "hway", "hwy"],
    "alley": ["alley", "aly"],
    "extension": ["extension", "ext"],
    "circle": ["circle", "cir"],
}
# Words that stand before the name of a street.
PREFIXES = ["calle", "kalye", "c"]
KIND_OF = {w: k for k, ws in KINDS.items() for w in ws}
KIND = "(?:" + "|".join(sorted(KIND_OF, key=len, reverse=True)) + r")\b\.?"
# a word is taken as a whole and never given back, so that the time stays in proportion to the text
WORD = r"(?<![a-z'-])[a-z][a-z'-]*+"
GAP = r"[ ,;.]*+"
#: Characters before and after the kind of a street in which its name and house number stand.
REACH = 160

LOTS = re.compile(r"\b(?:block|blk|b)\.? ?(\d+)[ ,;-]*(?:lot|lt|l)\.? ?(\d+)\b")
TURNED_LOTS = re.compile(r"\b(?:lot|lt|l)\.? ?(\d+)[ ,;-]*(?:block|blk|b)\.? ?(\d+)\b")
# parts that make no difference, each with texts of which one stands in every such part
ASIDE = [
    (("unit", "room", "rm", "suite", "ste", "door", "stall"), re.compile(r"\b(?:unit|room|rm|suite|ste|door|stall)\b\.? ?\d+[a-z]?\b")),
    (("fl", "f"), re.compile(r"\b(?:\d+(?:st|nd|rd|th)|ground|second|third|first|upper|lower) ?(?:floor|flr|fl)\b\.?|\b\d+ ?/ ?f\b|\bg ?/ ?f\b")),
    (("near", "beside", "behind", "in front", "across", "opposite", "next", "back of", "fronting", "gate"), re.compile(r"\b(?:near|beside|behind|in front of|across|opposite|next to|back of|fronting) [^,;()\[\]]*|\b\d+(?:st|nd|rd|th) gate\b")),
    (("barangay", "brg", "bgy", "bgry", "zone", "purok", "phase"), re.compile(r"\b(?:barangay|brgy|bgy|brg|bgry)\b\.? ?(?:\d+(?:-?[a-z]\b)?|" + WORD + r")|\b(?:zone|purok|phase) ?\d+")),
    (("pob",), re.compile(r"\b(?:poblacion|pob)\b\.?")),
    (("subd", "vill", "homes", "estate"), re.compile(r"\b" + WORD + r" (?:subdivision|subd|village|homes|estates?)\b\.?|\b" + WORD + r" vill\b\.?(?= *(?:[,;]|$))")),
    (("building", "bldg", "arcade", "compound", "tower", "mall"), re.compile(r"\b" + WORD + r" (?:building|bldg|arcade|compound|tower|mall)\b\.?")),
    (("ph", "pilipinas"), re.compile(r"\b(?:philippines|phl|phils?|ph|pilipinas)\b\.?")),
    (("km",), re.compile(r"\bkm\.? ?\d+")),
    (("sitio", "along"), re.compile(r"\b(?:sitio|along)\b\.?")),
]
CORNER = re.compile(r"\b(?:corner|cor|cnr|cr)\b\.? *(?:(?:calle|kalye|c)\b\.? *" + WORD + r"(?: " + WORD + r")?(?= *(?:[,;]|$))|(?:" + WORD + r" ){1,3}?" + KIND + ")")
NUMBER = r"(?:(?:no|num|number)\b\.? *)?(\d+[a-z]?)\b"
CALLED = re.compile(r"\b(?:" + "|".join(PREFIXES) + r")\b\.? *(" + WORD + r"(?: +" + WORD + r"){0,2})")
BEFORE = re.compile(NUMBER + GAP + r"$")
AFTER = re.compile(r"^" + GAP + NUMBER)


_MARKS = re.compile(r"(?<!\s)\s+-+\s+|(?<!\s)\s*[;/|()\[\]\n\t]\s*|(?<!\s)\s+–\s+")
_SIGNS = re.compile(r"#|\bn[o°]\.? ?(?=\d)|\bno\. *(?=#)")
_STOPS = re.compile(r"\b(no|brgy|bgy|barangay|blk|block|lot|lt|rm|unit|km|pob)\.(?=\S)")
_OTHER = re.compile(r"[^a-z0-9,;.' -]")
_NUMBERS = re.compile(r"\bno\b\.? *(?:no\b\.? *)+")
_KINDS = re.compile(KIND)


def spaced(text: str) -> str:
    """Lower-case ASCII with every mark that separates parts turned into a semicolon."""
    text = unaccented(text)
    text = _MARKS.sub(" ; ", text.replace("2/f", "2 floor"))
    text = _SIGNS.sub(" no ", text)
    if "." in text:
        text = _STOPS.sub(r"\1. ", text)
    return " ".join(_OTHER.sub(" ", text).split())


def _words_before(text: str, at: int) -> tuple[list[str], int]:
    """The words that stand directly before a position, back to a digit or a mark, and where they start."""
    start = at
    low = max(0, at - REACH)
    while start > low:
        i = start
        while i > low and text[i - 1] in ". ":
            i -= 1
        j = i
        while j > low and (text[j - 1].isalpha() or text[j - 1] in "'-"):
            j -= 1
        while j < i and not text[j].isalpha():
            j += 1
        if i == start or j == i:
            break
        start = j
    return [w.strip(".") for w in text[start:at].split()], start


def street_parts(text: str) -> tuple[str, set[tuple[str, str]], str] | None:
    """(number, {(street, kind)}, rest) of an address, None without house number or block and lot."""
    text = spaced(text)
    number = None
    if m := LOTS.search(text):
        number = f"b{int(m[1])}l{int(m[2])}"
    elif m := TURNED_LOTS.search(text):
        number = f"b{int(m[2])}l{int(m[1])}"
    if number:
        text = text[: m.start()] + " ; " + text[m.end() :]
    if "c" in text:
        text = CORNER.sub(" ; ", text)
    for signs, pattern in ASIDE:
        if any(sign in text for sign in signs):
            text = pattern.sub(" ; ", text)
    text = " ".join(text.split())
    if "no" in text:
        text = _NUMBERS.sub("no ", text)

    for m in _KINDS.finditer(text):
        kind = KIND_OF[m[0].rstrip(".")]
        words, head = _words_before(text, m.start())
        while words and words[0] in ("no", "calle", "kalye", "of", "sa", "ng"):
            words = words[1:]
        if not words or (len(words) == 1 and words[0] in ("national", "public")):
            continue
        base = max(0, head - REACH)
        before = BEFORE.search(text[base:head])
        after = AFTER.search(text[m.end() : m.end() + REACH])
        own = number
        start, end = head, m.end()
        sure = False
        if own is None:
            if before:
                own, start, sure = before[1], base + before.start(), True
            elif after:
                own, end = after[1], m.end() + after.end()
            else:
                continue
        elif before and not after:
            start = head
        if own.isdigit():
            own = str(int(own))
        readings = {" ".join(words)} if sure or len(words) <= 2 else {words[-1], " ".join(words[-2:])}
        left = [] if sure or len(words) <= 2 else words[:-1]
        rest = text[:start] + " ; " + " ".join(left) + " ; " + text[end:]
        return own, {(r.replace("-", " "), kind) for r in readings}, rest
    for m in CALLED.finditer(text):
        base = max(0, m.start() - REACH)
        before, after = BEFORE.search(text[base : m.start()]), AFTER.search(text[m.end() : m.end() + REACH])
        own = number or (before[1] if before else after[1] if after else None)
        if own is None:
            continue
        words = m[1].split()
        readings = {" ".join(words[:i]) for i in range(1, min(2, len(words)) + 1)}
        start = base + before.start() if before and not number else m.start()
        end = m.end() + (after.end() if after and not before and not number else 0)
        rest = text[:start] + " ; " + " ".join(words[1:]) + " ; " + text[end:]
        return (str(int(own)) if own.isdigit() else own), {(r.replace("-", " "), "street") for r in readings}, rest
    return None


def localities(names: Gazetteer, rest: str, city: str | None) -> frozenset:
    """Localities the rest of an address and its city field may mean."""
    rest = re.sub(r"\bno\b\.?", " ", rest)
    stated = names.candidates(rest.replace(";", ",")) if re.search("[a-z]", rest) else frozenset()
    if not stated:
        # a barangay without its title may stand before or after the town in one part
        for part in re.split("[,;]", rest):
            words = plain(part).split()
            for some in (words[1:], words[:-1]) if 2 < len(words) < 8 else ():
                if len(some) > 1 and (stated := names.candidates(" ".join(some))):
                    break
            if stated:
                break
    field = names.candidates(city)
    if not stated:
        return field or (frozenset({"~" + plain(city)}) if city and plain(city) not in PLACEHOLDERS else frozenset())
    if field and not (stated & field):
        # a lone word may be a barangay that is called like a town elsewhere
        parts = [p for p in (plain(s) for s in re.split("[,;]", rest)) if re.search("[a-z]", p)]
        if all(" " not in p for p in parts) and len(parts) < 2:
            return field
    return stated & field or stated


def forms(names: Gazetteer, address: str | None, city: str | None) -> tuple[str, list[str], list[str]] | None:
    """(number, streets as "kind/name", localities) or None where the address fits no case."""
    if not address or not (parts := street_parts(address)):
        return None
    number, streets, rest = parts
    places = localities(names, rest, city)
    if not places:
        return None
    return number, sorted(f"{kind}/{name}" for name, kind in streets), sorted(places)


def parsed(records: DataFrame, localities_table: DataFrame) -> DataFrame:
    """``(rec_id, form, hashes)`` of every record (rec_id, address, city) whose address fits a case.

    ``form`` names the readings of the address, ``hashes`` are the 64-bit hashes of (house number,
    locality, street variant) over all readings.  One map over Arrow batches, no shuffle.
    """
    rows = entries(localities_table)
    source = records.select(F.col("rec_id").cast("long").alias("rec_id"), F.col("address").cast("string").alias("address"), F.col("city").cast("string").alias("city")).filter("address IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = built(rows)
        for batch in batches:
            at, numbers, streets, places = [], [], [], []
            for i, (address, city) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if found := forms(names, address, city):
                    at.append(i)
                    numbers.append(found[0])
                    streets.append(found[1])
                    places.append(found[2])
            kinds = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(numbers, pa.string()), pa.array(streets, kinds), pa.array(places, kinds)], names=["rec_id", "number", "streets", "places"])

    return source.mapInArrow(run, "rec_id long, number string, streets array<string>, places array<string>")


def same_address_classes(records: DataFrame, localities_table: DataFrame) -> DataFrame:
    """``(rec_id, address_class)`` of every record whose address has number, street and locality.

    Records of one class give the same location.  Equal readings fall together by an aggregation, so
    copies cost nothing more; distinct readings are exploded into hashed component combinations and
    joined on any shared hash.  The house number is part of every hash, so conflicting numbers never
    meet.  Null, blank, vague and unreadable addresses belong to no class; repeated rows share theirs.
    """
    read = parsed(records, localities_table)
    form = F.xxhash64("number", "streets", "places")
    read = cut(read.withColumn("form", form))
    distinct = read.groupBy("form").agg(F.first("number").alias("number"), F.first("streets").alias("streets"), F.first("places").alias("places"))
    # all readings of the street, whole and with one letter left out
    parts = distinct.select("form", "number", F.explode("places").alias("place"), "streets").select("form", "number", "place", F.explode("streets").alias("street"))
    kind, name = F.substring_index("street", "/", 1), F.regexp_replace(F.substring_index("street", "/", -1), " ", "")
    named = parts.select("form", "number", "place", kind.alias("kind"), name.alias("name"))
    left_out = F.when(F.length("name") >= 4, F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.concat(F.substring("name", F.lit(1), i - 1), F.substring(F.col("name"), i + 1, F.length("name"))))).otherwise(F.array().cast("array<string>"))
    hashed = named.select("form", F.explode(F.array_distinct(F.concat(F.array("name"), left_out))).alias("variant"), "number", "place", "kind").select("form", F.xxhash64("number", "place", "kind", "variant").alias("h"))
    # distinct readings only, so a bucket stays small however often an address is repeated
    head = F.min("form").over(W.partitionBy("h"))
    links = hashed.select(F.col("form").alias("a"), head.alias("b")).filter("a <> b")
    classes = connected_components(links)
    return read.join(classes, read["form"] == classes["node"], "left").select("rec_id", F.coalesce("component", "form").alias("address_class"))


def same_address_pairs(records: DataFrame, localities_table: DataFrame) -> DataFrame:
    """``(rec_id_a, rec_id_b)``, a < b: every pair of records that give the same location."""
    return pairs_within(same_address_classes(records, localities_table), "address_class", "rec_id", "rec_id_a", "rec_id_b")
