import random

import pytest

from terralane.llm.gazetteer import NONE, Gazetteer, Trie, map_values

ROWS = [("1", "City of Kinabi", "Dodezil"), ("2", "San Goyewi", "Subekas"), ("3", "San Goyewi", "Wusado del Sur"), ("4", "Yumesa", "Zanulul del Norte"), ("5", "Yumesi", "Pobobe del Sur"), ("6", "Saviña", "Bugomu"), ("7", "General Zadamer", "Giduman")]


@pytest.mark.parametrize("value,psgc", [
    ("kinabi city", "1"), ("LUNGSOD NG KINABI", "1"), ("KINABI (CITY) / DODEZIL", "1"), ("Kinbai", "1"), ("4012 Ciudad de Kinabi, PH", "1"),
    ("San Goyewi", NONE), ("S. Goyewi, Prov. of Wusado del Sur", "3"), ("sn. goyewi subekas", "2"), ("Yumesa", "4"), ("Yumesu", NONE), ("yumesi", "5"),
    ("SAVIÃ±A", "6"), ("Savinya", "6"), ("Hen. Zadamer", "7"), ("GEN. ZADMER", "7"), ("Province of Dodezil", NONE), ("Dodezil", NONE), ("n/a", NONE), ("", NONE), ("   ", NONE), (None, NONE), ("San Elsewhere", NONE),
])
def test_values(value, psgc):
    assert Gazetteer(ROWS).resolve(value) == psgc


def distance(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_equals_brute_force():
    rng = random.Random(3)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(200)}
    trie = Trie()
    for w in words:
        trie.add(w, w)
    for _ in range(150):
        q = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 8)))
        for bound in (0, 1, 2):
            assert trie.within(q, bound) == {w: distance(q, w) for w in words if distance(q, w) <= bound}


def test_rows(spark):
    places = spark.createDataFrame([(*r, "x") for r in ROWS], "psgc string, locality_name string, province string, value string")
    typed = spark.createDataFrame([(1, "Kinabi", 5), (1, "Kinabi", 5), (2, None, 5), (3, "k" * 100_000, 5)], "rec_id long, value string, psgc int")
    got = sorted((r.rec_id, r.psgc) for r in map_values(typed, "rec_id", "value", places).collect())
    assert got == [(1, "1"), (1, "1"), (2, NONE), (3, NONE)]
    assert map_values(typed.limit(0), "rec_id", "value", places).count() == 0
    assert {r.psgc for r in map_values(typed, "rec_id", "value", places.limit(0)).collect()} == {NONE}
