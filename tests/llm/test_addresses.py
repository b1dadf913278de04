import itertools

from terralane.llm.addresses import same_address_classes, same_address_pairs, street_parts

PLACES = [("1", "San Rovahar", "Kekevel"), ("2", "General Zadamer", "Giduman"), ("3", "Votoreñ", "Vizokor del Norte")]


def test_street_parts():
    assert street_parts("No. 4586 Camia Dr., Brgy. 3")[:2] == ("4586", {("camia", "drive")})
    assert street_parts("Unit 4, 2/F Savina Bldg, Camia Drive no. #4586")[:2] == ("4586", {("camia", "drive")})
    assert street_parts("B7 L12, Waling-Waling St cor. Pili Rd")[:2] == ("b7l12", {("waling waling", "street")})
    assert street_parts("Lot 12 Block 7, waling waling street")[:2] == ("b7l12", {("waling waling", "street")})
    assert ("nimupa", "street") in street_parts("6976 Calle Nimupa")[1]
    for vague in ("National Highway", "Km. 55 Camia Road", "along Pili St.", "Brgy. 12", "", "Sitio Soyeli"):
        assert street_parts(vague) is None


def test_pairs(spark):
    places = spark.createDataFrame(PLACES, "psgc string, locality_name string, province string")
    rows = [
        (1, "4586 Camia Drive, San Rovahar", None), (2, "CAMIA DR. #4586 (near the terminal)", "san-rovahar, kekevel"), (3, "Nº 4586 Camai Drv., Sn. Rovahar 4012", ""),
        (4, "4587 Camia Drive", "San Rovahar"), (5, "4586 Camia Street", "San Rovahar"), (6, "4586 Camia Drive", "Gen. Zadamer"), (7, "4586 Camia Drive", None),
        (8, None, "San Rovahar"), (9, "", ""), (10, "4586 Camia Drive, San Rovahar", None), (11, "x" * 50_000, "San Rovahar"), (12, "12 pili street " * 20_000, "San Rovahar"),
    ]
    df = spark.createDataFrame(rows, "rec_id long, address string, city string")
    got = sorted(map(tuple, same_address_pairs(df, places).collect()))
    assert got == sorted(itertools.combinations([1, 2, 3, 10], 2))
    assert same_address_pairs(df.limit(0), places).count() == 0
    classes = {r.rec_id: r.address_class for r in same_address_classes(df, places).collect()}
    assert classes[1] == classes[3] and classes[4] != classes[1] and 8 not in classes
