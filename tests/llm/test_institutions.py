import itertools
import random

import pytest

from terralane.llm.institutions import alias_names, class_rows, institution_classes, lcs_length, lcs_ratio, linked_readings, named_rows, read_institution, same_given, same_institution_pairs, same_proper


def test_reading():
    a = read_institution("Dr. Bert Kupovu-Kopovel Mat. & Child. Hosp. No. 2, Inc. (KKMCH)")
    assert a == ("children hospital maternity", 2, "roberto", False, ("kupovu", "kopovel"))
    assert read_institution("Maternity and Children's Hospital II of Roberto Kopovel Kupovu")[:3] == a[:3]
    assert read_institution("Ospital Heneral, Yasume Tolira")[0] == "general hospital"
    assert read_institution("Paaralang Elementarya ng Bado Wiru")[0] == "elementary school"
    assert read_institution("Yoka Webo St. Univ.")[0] == "state university"
    assert read_institution("Sto. Lotega de Miwedu Comm. Hosp")[3] is True
    assert read_institution("") is None and read_institution(None) is None and read_institution("Inc.") is None


def test_aliases_and_lcs():
    assert alias_names("BTPL, BOLANA TIBINIS PUBLIC LIBRARY") == ["BOLANA TIBINIS PUBLIC LIBRARY"]
    assert alias_names("Polytechnic College, Beziyo Kezovas") == ["Polytechnic College, Beziyo Kezovas"]
    assert len(alias_names("Buzuhe Huzosun District Hospital, Yilihe Mozukor District Hospital")) == 2
    assert alias_names(None) == alias_names("ZTGH; ") == []
    assert lcs_length("kitten", "sitting") == 4 and lcs_ratio("", "") == 1.0
    assert same_proper(("depoga", "tutomu"), ("tutmu", "depga")) and same_proper(("bazubusbakayer",), ("bazubus", "bakayer"))
    assert not same_proper(("varemo", "kikudal"), ("varemo", "mohubo"))


def test_pairs(spark):
    rows = [
        (1, "Depoga Tutomu College of Technology", None, 1), (2, "Tutmu Depoga Col. of Tech.", "", 1), (3, "COLL. OF TECHNOLOGY, DEPOGA TUTOMU", "Rasupus Ziroho College of Technology; DTCT", 1),
        (4, "Rasupus Zirohu College of Tech", None, 1), (5, "Depoga Tutomu College of Technology II", None, 1), (6, "Depoga Tutomu Municipal College", None, 1),
        (7, None, None, 1), (8, "  ", None, 1), (9, "Depoga Tutomu College of Technology", None, 1), (10, "z" * 20_000, None, 1),
    ]
    df = spark.createDataFrame(rows, "rec_id long, name string, aliases string, k int")
    got = sorted(map(tuple, same_institution_pairs(named_rows(df, "rec_id", "name", "aliases")).collect()))
    assert got == sorted(itertools.combinations([1, 2, 3, 4, 9], 2))
    assert same_institution_pairs(named_rows(df.limit(0), "rec_id", "name", None)).count() == 0


def syllables(rng, n):
    return "".join(rng.choice("bdgkmptvz") + rng.choice("aeiou") for _ in range(n))


def linked(spark, propers, **block):
    rows = [(i, "general hospital", 0, given, False, sorted(words)) for i, (given, words) in enumerate(propers)]
    df = spark.createDataFrame(rows, "reading long, kind string, numeral int, given string, saint boolean, proper array<string>")
    got = [tuple(r) for r in linked_readings(df, **block).collect()]
    want = {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if same_given(a[3], b[3]) and same_proper(tuple(a[5]), tuple(b[5]))}
    assert len(got) == len(set(got)) and set(got) == want
    return want


@pytest.mark.parametrize("block", [{}, {"block": 9}])
def test_common_words_lose_no_pair(spark, block):
    rng = random.Random(3)
    many = [("", ("kemapus", syllables(rng, 3))) for _ in range(40)] + [("", (syllables(rng, 3), "wavodir")) for _ in range(40)]
    givens = [(g, ("tolira", "yasume")) for g in ("", "r", "roberto", "rosario")]
    assert (0, 1) in linked(spark, [("", ("kemapuswavodir",)), ("", ("kemapus", "wavodir")), *many, *givens], **block)


def test_slips_inside_every_word_are_found(spark):
    pairs = [("kazeti", "ponuden"), ("kazoti", "ponoden"), ("tebivus",), ("tebvus",), ("lorane",), ("lorne",)]
    want = linked(spark, [("", words) for words in pairs])
    assert {(0, 1), (2, 3), (4, 5)} <= want


def test_slips_in_random_names_are_found(spark):
    """Recall of the blocks against a comparison of all pairs."""
    rng = random.Random(17)

    def slip(word):
        k = rng.randrange(len(word))
        return rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice("aeioubdgk") + word[k + 1 :], word[:k] + rng.choice("aeioubdgk") + word[k:], word[:k] + word[k + 1 : k + 2] + word[k] + word[k + 2 :]])

    propers = []
    for _ in range(150):
        words = tuple(syllables(rng, rng.randint(2, 4)) for _ in range(rng.choice([1, 2, 2, 2, 3])))
        for _ in range(3):
            some = tuple(slip(w) if rng.random() < 0.7 else w for w in words)
            propers.append(("", ("".join(some),) if rng.random() < 0.1 else some))
    propers = [(g, w) for g, w in dict.fromkeys((g, tuple(sorted(w))) for g, w in propers)]
    assert len(linked(spark, propers)) > 100


def test_classes(spark):
    rows = [(1, "Depoga Tutomu College"), (2, "Tutmu Depoga Col."), (3, "Other Name College"), (4, None)]
    named = named_rows(spark.createDataFrame(rows, "rec_id long, name string"), "rec_id", "name", None)
    got = {r.k: r.links for r in class_rows(institution_classes(named), "k", "institution").collect()}
    assert got == {1: 1, 2: 1, 3: 0}
