import pytest
from pyspark.sql import functions as F

from terralane.operators import taxonomy as tx
from terralane.operators.relational import left_join_checked
from terralane.sources import readers as rd
from terralane.streaming.windows import run_to_end

TREE = [("C", None), ("10", "C"), ("101", "10"), ("1011", "101"), ("10111", "1011"), ("10112", "1011"), ("102", "10"), ("1021", "102"), ("10210", "1021")]


def test_fusion_and_ancestors(spark):
    tree = spark.createDataFrame(TREE, "code string, parent string")
    paths = tx.closure(tree)
    sets = spark.createDataFrame([(1, "10111"), (1, "10112"), (2, "10111"), (2, "10210"), (3, "101")], "id int, code string")
    assert {r.id: r.lca for r in tx.common_ancestor(sets, paths).collect()} == {1: "1011", 2: "10", 3: "101"}
    with pytest.raises(ValueError):
        tx.closure(spark.createDataFrame([("a", "b"), ("b", "a")], "code string, parent string"), 4)


EVIDENCE = "id int, source string, grp string, kind string, codes array<string>"


def test_fusion_of_the_fixture(spark):
    rows = [
        (1, "overture", "overture", "SUBTREE", ["10111"]), (1, "osm", "osm", "SUBTREE", ["10112"]),
        (2, "overture", "overture", "SUBTREE", ["10111"]), (2, "osm", "osm", "SUBTREE", ["10210"]),
        (3, "osm", "osm", "SUBTREE", ["10111"]), (3, "overture", "overture", "NOT_ACTIVITY", None),
        (4, "a", "a", "SUBTREE", ["101"]), (4, "b", "b", "EXACT", ["10111"]), (4, "c", "c", "SUBTREE", ["C"]),
        (5, "a", "same", "SUBTREE", ["10111"]), (5, "b", "same", "SUBTREE", ["10210"]),
        (6, "a", "a", "UNION", ["10111", "10112"]),
        (7, "a", "a", "SUBTREE", ["unknown"]), (7, "b", "b", "UNCODEABLE", []),
        (8, "a", "a", "SUBTREE", ["10111"]), (8, "b", "b", "SUBTREE", ["10112"]), (8, "c", "c", "SUBTREE", ["10"]),
        (9, "a", "a", "SUBTREE", ["10111"]), (9, "b", "b", "SUBTREE", ["10112"]), (9, "c", "c", "SUBTREE", ["102"]),
        (10, "a", "a", "SUBTREE", ["1011"]), (10, "b", "b", "SUBTREE", ["1011"]),
        (11, "a", "a", "SUBTREE", ["101"]), (11, "b", "b", "SUBTREE", ["102"]),
    ]
    out = tx.fuse(spark.createDataFrame(rows + rows[:3], EVIDENCE), spark.createDataFrame(TREE, "code string, parent string"))
    got = {r.id: r for r in out.collect()}
    assert {i: (r.code, r.relation) for i, r in got.items()} == {
        1: ("1011", "INTERSECT"), 2: (None, "CONFLICT"), 3: ("10111", "SINGLE"), 4: ("10111", "NESTED"), 5: ("10", "INTERSECT"), 6: ("1011", "UNION"),
        7: (None, "EMPTY"), 8: ("1011", "INTERSECT"), 9: (None, "CONFLICT"), 10: ("1011", "INTERSECT"), 11: ("10", "INTERSECT")}
    assert got[1].flags == got[8].flags == ["INDEPENDENT_SIBLING_BACKOFF"] and got[5].flags == ["DEPENDENT_CONFLICT:same"] and not got[2].flags
    assert got[3].activity_conflict and not got[1].activity_conflict and got[5].groups == 1 and got[1].candidates == ["10111", "10112"]
    two = spark.createDataFrame([("A", None), ("B", None)], "code string, parent string")
    r = tx.fuse(spark.createDataFrame([(1, "a", "a", "UNION", ["A", "B"])], EVIDENCE), two).first()
    assert (r.code, r.relation, r.flags) == (None, "UNION", ["NO_COMMON_ANCESTOR"])


def test_points_of_interest_and_licences(spark):
    tags = [{"name": "a", "public_transport": "stop"}, {"shop": "x"}, {"name:en": "b", "railway": "subway_entrance"}, {"name": "c", "aeroway": "heliport"}, {"name": "d", "historic": "ruins"}, {"name": "unknown", "shop": "x"}, None, {"name": "e", "railway": "halt", "operator": "o", "amenity": "cafe", "cuisine": "tea"}]
    df = spark.createDataFrame(list(enumerate(tags)), "id int, tags map<string,string>")
    got = {r.id: (r.poi, r.text) for r in df.select("id", rd.is_poi(F.col("tags")).alias("poi"), rd.category_text(F.col("tags")).alias("text")).collect()}
    assert [got[k][0] for k in range(8)] == [True, False, True, False, False, False, False, True]
    assert got[7][1] == "amenity=cafe | railway=halt | cuisine=tea | operator=o" and got[4][1] == got[6][1] == ""
    items = [
        [("Meta", None, None)], [("meta_places", None, "apache 2.0"), (None, "Bright Query", None)], [("foursquare", None, "CC0-1.0")], [("osm", None, "ODbL-1.0")],
        [("meta", None, "CC-BY-4.0")], [("new one", None, None)], [], None, [("All The Places/x", None, " CC0 1.0 ")],
    ]
    df = spark.createDataFrame(list(enumerate(items)), "id int, items array<struct<dataset:string,provider:string,license:string>>")
    got = [tuple(r.x) for r in df.orderBy("id").select(rd.source_decision(F.col("items")).alias("x")).collect()]
    assert [(g[0], g[1], g[3]) for g in got] == [
        (True, "CDLA-Permissive-2.0", "permitted"), (True, "Apache-2.0|CDLA-Permissive-2.0", "permitted"), (False, "CC0-1.0", "excluded"), (False, "", "unresolved"),
        (False, "", "unresolved"), (False, "", "unresolved"), (False, "", "missing"), (False, "", "missing"), (True, "CC0-1.0", "permitted")]
    assert got[1][2] == "brightquery|meta"
    df = spark.createDataFrame([(0, ["Meta", "PIN ME TO"]), (1, ["meta", "other"]), (2, None), (3, ["All the Places"])], "id int, p array<string>")
    got = [tuple(r) for r in df.orderBy("id").select(rd.legacy_terms(F.col("p")), rd.legacy_allowed(F.col("p"))).collect()]
    assert got == [("CDLA-Permissive-2.0", True), ("CDLA-Permissive-2.0|OVERTURE-PLACES-REVIEW", False), ("OVERTURE-PLACES-REVIEW", False), ("CC0-1.0", True)]


def test_resolver(spark):
    rows = [("a1", "alpha", ["55"]), ("a2", "alpha", ["55"]), ("t", "alpha", ["55", "56"]), ("j1", "jm", ["55"]), ("j2", "jm", ["55"]), ("j3", "jm", ["66"]), ("u", "jm", ["55", "56"]), ("o1", "once", ["55"]), ("v", "once", ["55", "56"])]
    df = spark.createDataFrame(rows, "id string, name string, codes array<string>")
    assert [tuple(r) for r in tx.resolve_by_name(df).collect()] == [("t", "55", 2)]


def test_checked_join_and_points(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(ValueError):
        left_join_checked(left, spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string"), ["k"])
    good = spark.createDataFrame([("1", "n", 1.0, 2.0)], rd.POINT_SCHEMA)
    assert rd.checked_points(good).count() == 1
    with pytest.raises(ValueError):
        rd.checked_points(spark.createDataFrame([("1", "n", 500.0, 2.0)], rd.POINT_SCHEMA))


def test_csv_tables(spark, tmp_path):
    (tmp_path / "z.csv").write_text("code,01,02\n01,1,2\n02,3,0\n")
    got = {(r.src, r.dst): r.value for r in rd.io_table(spark, str(tmp_path / "z.csv")).collect()}
    assert got == {("01", "01"): 1, ("01", "02"): 2, ("02", "01"): 3, ("02", "02"): 0}
    (tmp_path / "bad.csv").write_text("code,01,02\n01,1,2\n03,3,0\n")
    with pytest.raises(ValueError):
        rd.io_table(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "r.csv").write_text("id,name\n007,x\n")
    assert rd.text_csv(spark, str(tmp_path / "r.csv"), ["id", "name"], ["id"]).first().id == "007"


def test_stream_equals_batch(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.sql("SELECT timestamp'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 7) ts, concat('t', id % 3) event_type, cast(id as double) value FROM range(100)").write.parquet(path)
    out = run_to_end(spark, path, "counts")
    assert out.agg({"n": "sum"}).first()[0] == 100
