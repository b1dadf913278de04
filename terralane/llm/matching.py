"""Matching entities across two sources without a common key.

The q-grams of the name proper are encoded as a 128-bit vector, those of website host and operator as
64-bit vectors.  Close name vectors are found exactly by multi-index Hamming hashing: all pairs of one
class and place (a grid cell, or the locality where a position is missing or coarse) whose vectors
differ in at most ``RADIUS`` bits come out, and no other.  Field-weighted Dice scores of these pairs
are turned into confidences by a logistic curve that is fitted on the pairs whose addresses tell the
truth.

The index cuts a vector into ``RADIUS + 1`` blocks.  Where block thresholds t add up to
sum(t + 1) > RADIUS, two vectors within the radius agree up to t bits in at least one block, so each
searching vector may choose its own thresholds: its empty blocks, which half the world shares, are not
searched, and as many of its fullest blocks are searched with one bit changed instead.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terralane.llm.addresses import localities, street_parts
from terralane.llm.gazetteer import built, entries, plain
from terralane.llm.institutions import lcs_length
from terralane.operators.proximity import EARTH_RADIUS_M, REGION_BYTES, contained, points_in_regions, prepare_region
from terralane.session import cut

# Categories of the two sources that name the same kind of place.
CATEGORIES = [
    ("amenity=pharmacy", "pharmacy"), ("shop=convenience", "convenience_store"), ("shop=car_repair", "auto_repair"), ("shop=bakery", "bakery"),
    ("amenity=bank", "bank"), ("shop=supermarket", "supermarket"), ("amenity=veterinary", "veterinarian"), ("craft=tailor", "tailor"),
    ("amenity=school", "elementary_school"), ("shop=hardware", "hardware_store"), ("shop=hairdresser", "beauty_salon"), ("amenity=cafe", "coffee_shop"),
    ("amenity=clinic", "medical_clinic"), ("amenity=restaurant", "filipino_restaurant"), ("office=logistics", "freight_and_cargo_service"),
    ("amenity=fuel", "gas_station"), ("leisure=fitness_centre", "gym"), ("office=lawyer", "lawyer"), ("tourism=hotel", "hotel"), ("amenity=dentist", "dentist"),
]
CLASS_OF = {name: i for i, pair in enumerate(CATEGORIES) for name in pair}
# Words of business names that say what a place is, not which one.
KIND_WORDS = set(
    "academy animal auto bakery bakeshop bank barber barbershop botika boxing cafe cargo center centre clinic coffee const constn construction coop cooperative ctr dent dental dentist "
    "dress drug drugs drugstore eatery elem elementary family fitness forwarding fuel gas general gen genl grill grocery gym hardware hdw hdwe hospital hotel house inn kainan kapehan klinik law "
    "learning legal market mart mdse med medical medl merchandise mini motel motor motors office panaderya parlor pension pharm pharma pharmacy refilling repair rest restaurant resto rural salon "
    "sari savings sch school serv service services shop stn station stop store str super supermarket supermkt supply svc svcs tailor tailoring trucking vet veterinary vulcanizing warehouse water works".split()
)
NO_WORDS = {"the", "and", "ni", "ng", "of", "co", "corp", "inc", "incorporated", "corporation", "enterprises", "main", "branch", "s", "l", "a", "co"}
LONG_KINDS: dict[tuple[str, int], list[str]] = {}
for _w in sorted(w for w in KIND_WORDS if len(w) >= 5):
    LONG_KINDS.setdefault((_w[0], len(_w)), []).append(_w)
PLACEHOLDERS = {"", "n a", "na", "none", "null", "nan", "unknown", "tba", "tbd", "to follow", "not available", "xxx", "test"}
TITLED = r"(?:city of |san |santa |santo |sta\.? |sto\.? |general |gen'?l?\.? |hen\.? |villa |vill\.? |puerto |pto\.? |port |bagong |bgong )?"
# starts at a word only and never gives letters back, so that the time is in proportion to the text
BRANCH = re.compile(r"(?:[,-]? ?(?<![^\s,-])" + TITLED + r"[^\s,]++ (?:main )?branch\b)+|\([^)]*\)?| - .*$", re.I)

#: Hamming radius of the name vectors.
RADIUS = 8
#: Metres between two fine positions, between those of names that only say a kind, and between
#: positions of which one is coarse.
FINE_M, GENERIC_M, COARSE_M = 210.0, 130.0, 1_700.0
CELL = 0.01
#: Rows from which the calibration is fitted.
CALIBRATION_ROWS = 20_000
#: Degrees within which records of one name and class in a town stand at one spot.
SPOT_DEG = 0.005
#: Records of one class and place that meet at once on either side; fuller places meet part by part.
FULL = 4_000
#: Rows that a task searches at once.
CHUNK = 200_000
#: Confidence from which a pair counts as one place.
MIN_CONFIDENCE = 0.5


@functools.lru_cache(200_000)
def _near_kind(word: str) -> bool:
    """Whether a word is a kind word with one slip; names proper are hardly ever that close to one."""
    n = len(word)
    near = (k for m in (n - 1, n, n + 1) for k in LONG_KINDS.get((word[:1], m), ()))
    return n >= 5 and any(lcs_length(word, k) >= max(n, len(k)) - 1 for k in near)


def name_parts(name: str | None) -> tuple[tuple[str, ...], str]:
    """(words of the name proper, words that say the kind) of a business name."""
    text = " ".join((name or "").split())
    low = text.lower()
    remark = "branch" in low or "(" in low or " - " in low
    words = (plain(BRANCH.sub(" ", text)).split() if remark else []) or plain(text).split()
    words = [w for w in words if w not in NO_WORDS]
    proper = [w for w in words if w not in KIND_WORDS]
    if len(proper) > 2:
        proper = [w for w in proper if not _near_kind(w)] or proper
    elif proper and len(words) > len(proper) and all(_near_kind(w) for w in proper):
        proper = []
    # a possessive s may cling to the first word: both readings share nearly all q-grams
    return tuple(proper), " ".join(w for w in words if w not in proper)


def grams(words: tuple[str, ...] | list[str]) -> set[str]:
    return {t[i : i + 2] for w in words for t in [f"_{w}_"] for i in range(len(t) - 1)}


@functools.lru_cache(200_000)
def _word_bits(word: str, width: int) -> int:
    out = 0
    for g in grams((word,)):
        out |= 1 << crc32(g.encode()) % width
    return out


def bits(words, width: int) -> int:
    out = 0
    for w in words:
        out |= _word_bits(w, width)
    return out


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def website_parts(url: str | None) -> tuple[str, str]:
    """(host without www, endings and hyphens, number of the store page or "")."""
    text = re.sub(r"\s+", "", (url or "").lower())
    if plain(text) in PLACEHOLDERS:
        return "", ""
    text = re.sub(r"^www\.", "", re.sub(r"^h?t?tps?\b[:/]*", "", text)).split("?")[0].split("#")[0].rstrip("/")
    host, _, path = text.partition("/")
    store = re.search(r"(?:stores?|branch(?:es)?|locations?)/(\w*\d\w*)", path)
    return re.sub(r"[^a-z0-9]", "", host.rsplit(".", 1)[0]), store[1] if store else ""


SCHEMA = (
    "sid string, cls int, va long, vb long, generic boolean, lat double, lon double, weak int, places array<string>, address string, "
    "host string, store string, hv long, op string, ov long, retail boolean"
)


def encoded(df: DataFrame, prefix: str, localities_table: DataFrame) -> DataFrame:
    """The records of one source as vectors and parsed attributes; equal records once, with ``id``."""
    names = {"sid": "source_id"} | {k: f"{prefix}_{k}" for k in ("name", "category", "lat", "lon", "operator", "website", "address", "city")}
    source = df.select(*[F.col(v).cast("double" if k in ("lat", "lon") else "string").alias(k) for k, v in names.items()]).filter("sid IS NOT NULL")
    rows = entries(localities_table)
    shapes = localities_table.select("psgc", "geometry").filter("psgc IS NOT NULL AND geometry IS NOT NULL")
    size = shapes.agg(F.sum(F.length("geometry") + 64)).first()[0] or 0
    if size <= REGION_BYTES:
        polygons = [(r[0], bytes(r[1])) for r in shapes.collect()]
        source = source.withColumn("inside", F.lit(None).cast("array<string>"))
    else:
        # too many for every task: the records are located by the grid join of the proximity operators
        polygons = []
        numbered = shapes.withColumn("region", F.xxhash64("psgc"))
        source = source.withColumn("row", F.xxhash64(*source.columns))
        usable = source.filter("abs(lat) <= 90 AND abs(lon) <= 180 AND NOT (lat = 0 AND lon = 0)")
        located = points_in_regions(usable, numbered, "row", "region").join(numbered.select("region", "psgc"), "region")
        source = source.join(located.groupBy("row").agg(F.collect_set("psgc").alias("inside")), "row", "left").drop("row").select(*names, "inside")
    shipped = df.sparkSession.sparkContext.broadcast((rows, polygons))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, polygons = shipped.value
        gazetteer = built(rows)
        ready = [p for i, (_, w) in enumerate(polygons) if (p := prepare_region(i, w))]
        for batch in batches:
            data = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            lat = np.array([np.nan if v is None else v for v in data["lat"]], float)
            lon = np.array([np.nan if v is None else v for v in data["lon"]], float)
            good = (np.abs(lat) <= 90) & (np.abs(lon) <= 180) & ~((lat == 0) & (lon == 0))
            inside: dict[int, list[str]] = {}
            for r, region in zip(*contained(ready, np.where(good, lon, 999.0), np.where(good, lat, 999.0))):
                inside.setdefault(int(r), []).append(polygons[int(region)][0])
            out: list[list] = [[] for _ in range(16)]
            for i, sid in enumerate(data["sid"]):
                proper, kind = name_parts(data["name"][i])
                vector = bits(proper or kind.split(), 128)
                fine = bool(good[i]) and not (round(lat[i], 2) == lat[i] and round(lon[i], 2) == lon[i])
                places = set(inside.get(i, ())) | set(data["inside"][i] or ())
                address = data["address"][i] or None
                if not fine:
                    parts = street_parts(address) if address else None
                    places |= set(localities(gazetteer, parts[2] if parts else address or "", data["city"][i]))
                host, store = website_parts(data["website"][i])
                op = plain(data["operator"][i] or "")
                op = "" if op in PLACEHOLDERS else op
                owner = op.split()[:2]
                row = (
                    sid, CLASS_OF.get((data["category"][i] or "").split(" | ")[0].strip(), -1), _signed(vector & (1 << 64) - 1), _signed(vector >> 64), not proper,
                    float(lat[i]) if good[i] else None, float(lon[i]) if good[i] else None, 0 if fine else 1 if good[i] else 2, sorted(places),
                    address,
                    host, store, _signed(bits([host], 64)) if host else 0, " ".join(owner), _signed(bits(owner, 64)) if owner else 0, "retail" in op.split(),
                )
                for column, v in zip(out, row):
                    column.append(v)
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            fields = [f.split(" ")[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=fields)

    table = source.mapInArrow(run, SCHEMA)
    return cut(table.withColumn("id", F.xxhash64(*[f.split(" ")[0] for f in SCHEMA.split(", ")])).dropDuplicates(["id"]))


#: First bit and width of every block of the 128-bit vector.
BLOCKS = [(128 * i // (RADIUS + 1), 128 * (i + 1) // (RADIUS + 1) - 128 * i // (RADIUS + 1)) for i in range(RADIUS + 1)]


def _blocks(va: np.ndarray, vb: np.ndarray) -> np.ndarray:
    """The blocks (rows, RADIUS + 1) of vectors given as two halves of 64 bits."""
    out = np.empty((len(va), len(BLOCKS)), np.uint64)
    for i, (at, width) in enumerate(BLOCKS):
        piece = vb >> np.uint64(at - 64) if at >= 64 else va >> np.uint64(at)
        if at < 64 < at + width:
            piece = piece | vb << np.uint64(64 - at)
        out[:, i] = piece & np.uint64((1 << width) - 1)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ x >> np.uint64(33)


def close_vectors(gl: np.ndarray, left: tuple[np.ndarray, np.ndarray], gr: np.ndarray, right: tuple[np.ndarray, np.ndarray], counted: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all left and right vectors of one group within the radius, each pair once, exactly.

    The right vectors stand in the index under every block as it is; a left vector searches with its own
    thresholds.  ``counted`` receives the number of candidates that the index gave.
    """
    found: list[np.ndarray] = []
    lb, rb = _blocks(*left), _blocks(*right)
    ones = np.bitwise_count(lb).astype(np.int64)
    # as many of the fullest blocks are searched with one bit changed as empty ones are left out
    order = np.argsort(ones, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(BLOCKS))[None, :], axis=1)
    spare = np.minimum((ones == 0).sum(1), len(BLOCKS) // 2)[:, None]
    skipped, widened = rank < spare, rank >= len(BLOCKS) - spare
    gl, gr = gl.astype(np.uint64), gr.astype(np.uint64)
    candidates = 0
    for b, (_, width) in enumerate(BLOCKS):
        salt = np.uint64(b + 1) << np.uint64(40)
        keys = _mixed(gr ^ _mixed(rb[:, b] ^ salt))
        by = np.argsort(keys, kind="stable")
        keys = keys[by]
        at = np.flatnonzero(~skipped[:, b])
        wide = np.flatnonzero(widened[:, b])
        flips = np.uint64(1) << np.arange(width, dtype=np.uint64)
        rows = np.concatenate([at, np.repeat(wide, width)])
        values = np.concatenate([lb[at, b], (lb[wide, b][:, None] ^ flips[None, :]).ravel()])
        probes = _mixed(gl[rows] ^ _mixed(values ^ salt))
        low, high = np.searchsorted(keys, probes, "left"), np.searchsorted(keys, probes, "right")
        hit = np.flatnonzero(high > low)
        n = high[hit] - low[hit]
        candidates += int(n.sum())
        # a bounded number of candidates at once
        ends = np.cumsum(n)
        for first in range(0, len(hit), 4096):
            last = min(first + 4096, len(hit))
            m = n[first:last]
            i = np.repeat(rows[hit[first:last]], m)
            j = by[np.arange(int(m.sum())) - np.repeat(ends[first:last] - m - (ends[first] - m[0]), m) + np.repeat(low[hit[first:last]], m)]
            apart = np.bitwise_count(left[0][i] ^ right[0][j]) + np.bitwise_count(left[1][i] ^ right[1][j])
            keep = (apart <= RADIUS) & (gl[i] == gr[j])
            found.append(i[keep].astype(np.int64) * len(gr) + j[keep])
    if counted is not None:
        counted.append(candidates)
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs // max(1, len(gr)), pairs % max(1, len(gr))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Close pairs of rows (g, side, id, va, vb) that come sorted by g; whole groups are searched at once."""

    def pairs(rows: list[np.ndarray]) -> pa.RecordBatch:
        g, side, ids, va, vb = rows
        a, b = side == 0, side == 1
        i, j = close_vectors(g[a], (va[a], vb[a]), g[b], (va[b], vb[b]))
        return pa.RecordBatch.from_arrays([pa.array(ids[a][i]), pa.array(ids[b][j])], names=["l", "r"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        columns[3], columns[4] = columns[3].view(np.uint64), columns[4].view(np.uint64)
        held = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
        if len(held[0]) >= CHUNK:
            stop = int(np.searchsorted(held[0], held[0][-1], "left"))
            if stop:
                yield pairs([x[:stop] for x in held])
                held = [x[stop:] for x in held]
    if held is not None and len(held[0]):
        yield pairs(held)


def _meters(a: str, b: str) -> Column:
    la, lb = F.radians(f"{a}.lat"), F.radians(f"{b}.lat")
    h = F.pow(F.sin((lb - la) / 2), 2) + F.cos(la) * F.cos(lb) * F.pow(F.sin(F.radians(F.col(f"{b}.lon") - F.col(f"{a}.lon")) / 2), 2)
    return F.when(h.isNotNull(), F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def dice(*columns: tuple[str, str]) -> Column:
    """Dice coefficient of bit vectors given as pairs of columns of longs."""
    common = sum((F.bit_count(F.col(a).bitwiseAND(F.col(b))) for a, b in columns), F.lit(0))
    total = sum((F.bit_count(F.col(a)) + F.bit_count(F.col(b)) for a, b in columns), F.lit(0))
    return F.when(total > 0, 2 * common / total).otherwise(F.lit(0.0))


def _within(left: DataFrame, right: DataFrame, full: int = FULL) -> DataFrame:
    """``(l, r)``: ids of left and right rows (place, cls, id, va, vb) of one class and place whose vectors lie within the radius.

    Places that only one side has are dropped by counts.  A place that holds more than ``full`` rows of a
    side is cut into parts of that side, and every part of one side meets every part of the other.
    """
    rows = None
    for number, side in enumerate((left, right)):
        part = side.select(F.xxhash64("place", "cls").alias("g"), F.lit(number).alias("side"), "id", "va", "vb")
        rows = part if rows is None else rows.unionByName(part)
    counts = [F.sum((F.col("side") == k).cast("long")).alias(f"n{k}") for k in (0, 1)]
    sizes = rows.groupBy("g").agg(*counts).filter("n0 > 0 AND n1 > 0").select("g", *[F.ceil(F.col(f"n{k}") / full).cast("int").alias(f"p{k}") for k in (0, 1)])
    rows = rows.join(sizes, "g")
    own = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 0, F.col("p0")).otherwise(F.col("p1"))).cast("int")
    meet = F.when(F.col("side") == 0, F.transform(F.sequence(F.lit(0), F.col("p1") - 1), lambda o: own * F.col("p1") + o)).otherwise(F.transform(F.sequence(F.lit(0), F.col("p0") - 1), lambda o: o * F.col("p1") + own))
    placed = rows.select(F.explode(meet).alias("part"), "g", "side", "id", "va", "vb").withColumn("g", F.when(F.col("part") > 0, F.xxhash64("g", "part")).otherwise(F.col("g"))).drop("part")
    return placed.repartition("g").sortWithinPartitions("g").mapInArrow(_search, "l long, r long")


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct pairs of ids (l, r) whose name vectors lie within the radius at one place.

    Fine positions meet in grid cells; the left record also visits the neighbour cells its search
    circle reaches.  Where a position is missing or coarse, records meet by locality.
    """
    left, right = (side.select("id", "cls", "va", "vb", "weak", "lat", "lon", "places") for side in (left, right))
    fine_l, fine_r = left.filter("weak = 0"), right.filter("weak = 0")
    lat, lon = F.col("lat"), F.col("lon")
    dy = F.lit(math.degrees(FINE_M / EARTH_RADIUS_M))
    dx = dy / F.cos(F.radians(F.least(F.abs(lat), F.lit(89.0))))
    xs = F.sequence(F.floor((lon - dx) / CELL), F.floor((lon + dx) / CELL))
    ys = F.sequence(F.floor((lat - dy) / CELL), F.floor((lat + dy) / CELL))
    visits = fine_l.withColumn("x", F.explode(xs)).withColumn("y", F.explode(ys)).withColumn("place", F.format_string("%d/%d", "x", "y"))
    near = _within(visits, fine_r.withColumn("place", F.format_string("%d/%d", F.floor(lon / CELL), F.floor(lat / CELL))))
    # where a position is missing or coarse: weak ones of one side with all of the other
    towns = [side.withColumn("town", F.explode("places")) for side in (left, right)]
    parts = []
    for n, (a, b) in enumerate((("weak > 0", "true"), ("weak = 0", "weak > 0"))):
        parts.append([side.filter(c).withColumn("place", F.concat(F.lit(f"{n}:"), "town")) for side, c in zip(towns, (a, b))])
    weak = _within(parts[0][0].unionByName(parts[1][0]), parts[0][1].unionByName(parts[1][1])).distinct()
    return near.unionByName(weak)


def _parsed_addresses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns ``aa`` and ``ba``, raw addresses of a pair, followed by their house numbers and streets."""
    memo: dict[str, tuple[str | None, list[str]]] = {}

    def read(address: str | None) -> tuple[str | None, list[str]]:
        if not address:
            return None, []
        found = memo.get(address)
        if found is None:
            if len(memo) >= 20_000:
                memo.clear()
            parts = street_parts(address)
            found = memo[address] = (parts[0], sorted(n for n, _ in parts[1])) if parts else (None, [])
        return found

    for batch in batches:
        columns, names = list(batch.columns), list(batch.schema.names)
        # an address says something only where the other is known as well
        both = [(x, y) if x and y else (None, None) for x, y in zip(*(batch.column(names.index(c)).to_pylist() for c in ("aa", "ba")))]
        for k, c in enumerate(("a", "b")):
            found = [read(pair[k]) for pair in both]
            columns += [pa.array([n for n, _ in found], pa.string()), pa.array([t for _, t in found], pa.list_(pa.string()))]
            names += [f"{c}_number", f"{c}_streets"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Candidate pairs within reach with their field scores and the evidence for and against them."""
    pairs = candidates(left, right)
    a, b = left.alias("a"), right.alias("b")
    meters = _meters("a", "b")
    reach = F.when(F.greatest("a.weak", "b.weak") > 0, COARSE_M).otherwise(FINE_M)
    rows = pairs.join(a, F.col("l") == F.col("a.id")).join(b, F.col("r") == F.col("b.id")).filter("a.cls = b.cls").filter(meters.isNull() | (meters <= reach))
    hosts, owners = (F.col("a.host") != "") & (F.col("b.host") != ""), (F.col("a.op") != "") & (F.col("b.op") != "")
    stores = (F.col("a.store") != "") & (F.col("b.store") != "")
    towns = F.when(F.greatest("a.weak", "b.weak") > 0, F.array_intersect("a.places", "b.places"))
    rows = rows.select(
        towns.alias("towns"), F.col("a.sid").alias("left_sid"), F.col("b.sid").alias("right_sid"), F.col("a.cls").alias("cls"), F.col("a.va").alias("va"), F.col("a.vb").alias("vb"),
        (F.col("a.generic") == F.col("b.generic")).alias("alike"), F.col("a.generic").alias("generic"),
        F.greatest("a.weak", "b.weak").alias("weak"), meters.alias("meters"),
        dice(("a.va", "b.va"), ("a.vb", "b.vb")).alias("name"),
        F.when(hosts, dice(("a.hv", "b.hv"))).alias("host"), F.when(owners, dice(("a.ov", "b.ov"))).alias("owner"),
        F.when(stores, F.col("a.store") == F.col("b.store")).alias("store"),
        (F.col("a.retail") | F.col("b.retail") | (F.col("a.store") != "") | (F.col("b.store") != "")).alias("retail"),
        F.col("a.address").alias("aa"), F.col("b.address").alias("ba"),
    )
    kinds = ", ".join(f"{n} {k}" for n, k in rows.dtypes)
    rows = rows.mapInArrow(_parsed_addresses, kinds + ", a_number string, a_streets array<string>, b_number string, b_streets array<string>")
    numbers = F.col("a_number").isNotNull() & F.col("b_number").isNotNull()
    streets = F.exists("a_streets", lambda s: F.exists("b_streets", lambda t: F.levenshtein(s, t) <= 2))
    rows = rows.withColumn("address", F.when(numbers, (F.col("a_number") == F.col("b_number")) & streets))
    rows = rows.withColumn("other_number", F.coalesce(numbers & (F.col("a_number") != F.col("b_number")), F.lit(False)))
    return rows.drop("aa", "ba", "a_number", "a_streets", "b_number", "b_streets")


#: Weights of the fields in the score; a field that one side lacks does not count.
WEIGHTS = {"name": 0.55, "host": 0.2, "owner": 0.1, "near": 0.15}


def score() -> Column:
    near = F.when(F.col("meters").isNotNull(), F.greatest(F.lit(0.0), 1 - F.col("meters") / 300))
    parts = {"name": F.col("name"), "host": F.col("host"), "owner": F.col("owner"), "near": near}
    top = sum((F.coalesce(c, F.lit(0.0)) * WEIGHTS[n] for n, c in parts.items()), F.lit(0.0))
    return top / sum((F.when(c.isNotNull(), WEIGHTS[n]).otherwise(0.0) for n, c in parts.items()), F.lit(0.0))


def fit_curve(scores: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Logistic curve (slope, offset) by Newton steps with a weak prior; a default where one class is missing."""
    if len(scores) < 50 or truth.min() == truth.max():
        return 14.5, -9.4
    x = np.column_stack([scores, np.ones(len(scores))])
    w, prior = np.array([14.5, -9.4]), np.array([14.5, -9.4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - truth) + 0.01 * (w - prior)
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def matched(left: DataFrame, right: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(left_sid, right_sid, score, confidence)`` of every distinct pair of records that are one place.

    A pair is one place if the class agrees, the name vectors are close, nothing contradicts (another
    house number, another store page), and the positions are near; where a position is coarse or
    missing, an equal address or store page is asked for, or a name that stands at one spot only in the
    town.  Names that say only a kind match only such names.  The confidence comes from the score's calibrated curve;
    an agreeing address adds to it; pairs below ``min_confidence`` do not come out.  Empty tables give
    an empty result, repeated records one pair.
    """
    pairs = cut(compared(left, right).withColumn("score", score()))
    # of the pairs within reach, those whose addresses both are known
    sample = pairs.filter("address IS NOT NULL AND alike AND weak = 0").select("score", "address").orderBy(F.xxhash64("left_sid", "right_sid")).limit(CALIBRATION_ROWS).toPandas()
    slope, offset = fit_curve(sample["score"].to_numpy(float), sample["address"].to_numpy(float))
    same_store, same_address = F.coalesce("store", F.lit(False)), F.coalesce("address", F.lit(False))
    clear = F.col("alike") & (F.col("cls") >= 0) & ~F.col("other_number") & F.coalesce("store", F.lit(True))
    # names proper of two words that share one by chance stay well below a half
    close = F.when(F.col("generic"), (F.col("name") >= 0.65) & (F.col("meters") <= GENERIC_M)).otherwise((F.col("name") >= F.when(F.col("meters") <= 155, 0.5).otherwise(0.62)) & (F.col("meters") <= FINE_M))
    fine = pairs.filter(clear & close & (F.col("weak") == 0))
    weak = pairs.filter(clear & (F.col("weak") > 0) & (F.col("name") >= 0.7))
    told = weak.filter(same_store | same_address)
    # without an address a name tells a place if the towns in question show it at one spot only
    untold = weak.filter(~(same_store | same_address) & ~F.col("retail") & ~F.col("generic"))
    name = ["va", "vb", "cls"]
    seen = left.select(*name, "weak", "lat", "lon", "places").unionAll(right.select(*name, "weak", "lat", "lon", "places")).filter("weak = 0")
    spots = seen.join(untold.select(*name).distinct(), name, "left_semi").withColumn("town", F.explode("places")).groupBy(*name, "town").agg(F.greatest(F.max("lat") - F.min("lat"), F.max("lon") - F.min("lon")).alias("spread"))
    several = spots.filter(F.col("spread") > SPOT_DEG).groupBy(*name).agg(F.collect_set("town").alias("several"))
    untold = untold.join(several, name, "left").filter(~F.coalesce(F.arrays_overlap("towns", "several"), F.lit(False))).drop("several")
    weak = told.unionByName(untold)
    found = fine.select("left_sid", "right_sid", "score", "address").unionByName(weak.select("left_sid", "right_sid", "score", "address"))
    odds = F.lit(slope) * F.col("score") + F.lit(offset) + F.when(F.coalesce("address", F.lit(False)), 2.0).otherwise(0.0)
    return found.withColumn("confidence", 1 / (1 + F.exp(-odds))).groupBy("left_sid", "right_sid").agg(F.max("score").alias("score"), F.max("confidence").alias("confidence")).filter(F.col("confidence") >= min_confidence)


def match_sources(left: DataFrame, left_prefix: str, right: DataFrame, right_prefix: str, localities_table: DataFrame) -> DataFrame:
    return matched(encoded(left, left_prefix, localities_table), encoded(right, right_prefix, localities_table))
