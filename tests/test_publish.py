import pytest

from terralane.operators import publish as pb
from terralane.sources import readers as rd


def test_samples_are_nested_and_stable(spark):
    df = pb.zoom_sample(spark.range(5000).withColumnRenamed("id", "k"), "k")
    n = {r.min_zoom: r["count"] for r in df.groupBy("min_zoom").count().collect()}
    assert sum(n.values()) == 5000 and set(n) <= {8, 9, 10, 11, 12} and n[8] < n[9] + n[8] < 400


def test_changes_and_shards(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, None, 1.0), (3, "x", 1.0), (4, "x", 1.0)], "k int, l string, s double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "y", 1.0), (3, "x", 2.0), (5, "x", 1.0)], "k int, l string, s double")
    assert {r.change: r.n for r in pb.snapshot_changes(a, b, "k", "l", "s").collect()} == {"same": 1, "assigned": 1, "rescored": 1, "removed": 1, "added": 1}
    edges = spark.createDataFrame([(1, 20, 0.5), (1, 2, 0.5)], "u int, v int, w double")
    nodes = spark.createDataFrame([(1, 1), (2, 2), (20, 20)], "node int, pos int")
    assert sorted((r.shard, r.u, r.v) for r in pb.adjacency_shards(edges, nodes).collect()) == [(0, 1, 2), (0, 1, 20), (1, 1, 20)]


def test_glyphs_stay_within_the_bound(spark):
    rows = [("t", float(i) / 50, float(i % 7), i, i, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "type string, lon double, lat double, tx int, ty int, n int")
    out = pb.glyphs(df, 0.01, 40)
    assert out.count() <= 40 and out.agg({"n": "sum"}).first()[0] == 300


def test_sheet_block_and_tags(spark):
    sheet = [["title", None, None, None], [None, "A", "B", "total output"], ["A", 1, 2, 9], ["B", 3, 4, 9]]
    assert rd.transaction_block(sheet, 2) == (2, 1) and rd.total_output_column(sheet[1]) == 3
    with pytest.raises(ValueError):
        rd.transaction_block([["A", "B"]], 2)
    df = spark.sql("SELECT map('name', 'n', 'amenity', 'cafe', 'cuisine', 'local') a, map('name', 'n', 'railway', 'rail') b, CAST(null AS map<string,string>) c, map('amenity', 'cafe') d")
    r = df.select(rd.is_poi(df.a).alias("x"), rd.is_poi(df.b).alias("y"), rd.is_poi(df.c).alias("z"), rd.is_poi(df.d).alias("unnamed"), rd.category_text(df.a).alias("t")).first()
    assert (r.x, r.y, r.z, r.unnamed, r.t) == (True, False, False, False, "amenity=cafe | cuisine=local")


def test_manifest(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"abc")
    assert [tuple(r) for r in pb.manifest(spark, str(tmp_path)).collect()] == [("f.txt", 3, "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")]
