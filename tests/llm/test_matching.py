import struct

import numpy as np
import pytest

from terralane.llm import matching as m

OSM = "rec_id long, source_id string, osm_name string, osm_category string, osm_lon double, osm_lat double, osm_operator string, osm_website string, osm_address string, osm_city string"
OV = OSM.replace("osm_", "overture_")


def square(x0, y0, x1, y1):
    points = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in points)


def towns(spark):
    return spark.createDataFrame([("1", "San Rovahar", "Kekevel", square(120, 9, 121, 10)), ("2", "Zalila", "Subekas", square(122, 9, 123, 10))], "psgc string, locality_name string, province string, geometry binary")


def test_names_and_sites():
    assert m.name_parts("The Kudanon and Pevido Mini Mart Co. - San Rovahar")[0] == ("kudanon", "pevido")
    assert m.name_parts("Barbershop Santo Deraku Branch") == ((), "barbershop")
    assert m.website_parts("HTTPS://WWW.A-B.EXAMPLE/STORES/77?ref=map") == ("ab", "77")
    assert m.website_parts(None) == ("", "")


def vectors(rng, n, most, least=0):
    bits = np.zeros((n, 128), np.uint8)
    for row in bits:
        row[rng.choice(128, rng.integers(least, most), replace=False)] = 1
    return bits


def halves(bits):
    packed = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return packed[:, 0].copy(), packed[:, 1].copy()


@pytest.mark.parametrize("least, most", [(0, 3), (0, 22), (9, 20), (0, 90)])
def test_the_index_finds_exactly_the_pairs_within_the_radius(least, most):
    rng = np.random.default_rng(most)
    a, b = vectors(rng, 500, most, least), vectors(rng, 500, most, least)
    for r in range(350):
        b[r] = a[r]
        b[r, rng.choice(128, rng.integers(0, m.RADIUS + 4), replace=False)] ^= 1
    g, h = rng.integers(0, 4, 500), rng.integers(0, 4, 500)
    h[:400] = g[:400]
    counted = []
    i, j = m.close_vectors(g, halves(a), h, halves(b), counted)
    got = list(zip(i.tolist(), j.tolist()))
    apart = (a[:, None, :] != b[None, :, :]).sum(2)
    meet = g[:, None] == h[None, :]
    assert len(got) == len(set(got)) and set(got) == set(zip(*map(np.ndarray.tolist, np.nonzero((apart <= m.RADIUS) & meet))))
    if most == 20:
        # vectors of names: fewer candidates than a comparison of all that meet
        assert counted[0] < meet.sum()


@pytest.mark.parametrize("full", [4_000, 7])
def test_full_places_meet_part_by_part(spark, full):
    rng = np.random.default_rng(8)
    bits = vectors(rng, 60, 16)
    bits[30:] = bits[:30]
    bits[30:, :3] ^= 1
    va, vb = (v.astype(np.int64) for v in halves(bits))
    rows = [("p" if k % 3 else "q", 1 + k % 2, k, int(va[k]), int(vb[k])) for k in range(60)]
    left = spark.createDataFrame(rows[:30] + [("alone", 1, 99, 0, 0)], "place string, cls int, id long, va long, vb long")
    right = spark.createDataFrame(rows[30:] + rows[:30], left.schema)
    got = sorted(map(tuple, m._within(left, right, full).collect()))
    want = sorted((x[2], y[2]) for x in rows[:30] for y in rows if x[:2] == y[:2] and (bits[x[2]] != bits[y[2]]).sum() <= m.RADIUS)
    assert got == want and len(want) > 30


def test_long_names_take_time_in_proportion():
    for text in ("y" * 300_000, "( " * 100_000, "san " * 50_000 + "branch", "a-" * 100_000 + " branch", " - " * 50_000):
        m.name_parts(text)
    assert m.name_parts("Botika " + "Kemapus Branch " * 3)[0] == ()


def test_matches(spark):
    left = [
        (1, "n1", "Nupolul and Rulili Fuel Stop", "amenity=fuel", 120.50012, 9.50012, None, None, None, None),
        (2, "n2", "Salon Nutamo Sekeyer", "shop=hairdresser | building=yes", 120.60012, 9.50012, None, None, "7539 Rosal St, San Rovahar", None),
        (3, "n3", "Barbershop", "shop=hairdresser", 120.70012, 9.50012, None, None, None, None),
        (4, "n4", "Mihoyo Risusa Drugstore", "amenity=pharmacy", 120.80012, 9.50012, None, None, None, None),
        (5, "n5", "Degahu Nurapo Grocery", "shop=supermarket", None, None, None, None, "14 Bumogun Boulevard", "San Rovahar"),
        (6, "n6", None, None, None, None, None, None, None, None),
        (8, "n8", "y" * 100_000, "shop=bakery", 120.1, 9.1, "z" * 50_000, "w" * 50_000, "street 1 " * 20_000, "c " * 20_000),
        (7, "n1", "Nupolul and Rulili Fuel Stop", "amenity=fuel", 120.50012, 9.50012, None, None, None, None),
    ]
    right = [
        (1, "o1", "NUPOLUL & RULLILI FUEL STOP", "gas_station", 120.50042, 9.50032, None, None, None, None),
        (2, "o2", "Nutamo Sekeyr", "beauty_salon", 120.60052, 9.50012, None, None, "8888 Rosal St", None),
        (3, "o3", "The Barbershop Main", "beauty_salon", 120.70032, 9.50012, None, None, None, None),
        (4, "o4", "Mihoyo Risusa Supermarket", "supermarket", 120.80012, 9.50012, None, None, None, None),
        (5, "o5", "Degahu Nurapo Grocery Inc.", "supermarket", 120.20012, 9.20012, None, None, "#14 Bumogun Boul.", None),
        (6, "o6", "Nupolul and Rulili Fuel Stop", "gas_station", 120.51012, 9.50012, None, None, None, None),
    ]
    a, b = spark.createDataFrame(left, OSM), spark.createDataFrame(right, OV)
    got = {(r.left_sid, r.right_sid): r.confidence for r in m.match_sources(a, "osm", b, "overture", towns(spark)).collect()}
    assert set(got) == {("n1", "o1"), ("n3", "o3"), ("n5", "o5")}
    assert all(0 <= c <= 1 for c in got.values())
    assert m.match_sources(a.limit(0), "osm", b, "overture", towns(spark)).count() == 0
