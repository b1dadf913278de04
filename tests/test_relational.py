from pyspark.sql import functions as F

from terralane.operators import relational as rel


def test_numbered_is_a_global_order(spark):
    df = spark.range(1000).select(F.pmod(F.hash("id"), F.lit(10_007)).alias("x"), "id")
    got = rel.numbered(df, ["x", "id"], "n").collect()
    want = {r: i for i, r in enumerate(sorted((r.x, r.id) for r in got))}
    assert all(r.n == want[r.x, r.id] for r in got)
    assert rel.numbered(df.limit(0), ["x"], "n").count() == 0


def test_runs_and_thresholds(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("a", 4, None), ("a", 5, "x"), ("b", 1, None)], "k string, o int, v string")
    assert [(r.k, r.o, r.run) for r in rel.runs(df, ["k"], ["o"], "v").orderBy("k", "o").collect()] == [("a", 1, 1), ("a", 2, 1), ("a", 3, 2), ("a", 4, 2), ("a", 5, 3), ("b", 1, 1)]
    w = df.withColumn("w", F.lit(2))
    assert {r.k: r.at for r in rel.first_reaching(w, ["k"], ["o"], "w", F.lit(5), "o", "at").collect()} == {"a": 3, "b": None}


def test_block_sum_keeps_the_total(spark):
    z = spark.createDataFrame([("1", "2", 3.0), ("2", "1", 4.0), ("3", "3", 5.0)], "src string, dst string, value double")
    g = spark.createDataFrame([("1", "A"), ("2", "A"), ("3", "B")], "code string, grp string")
    assert {(r.src_group, r.dst_group): r.value for r in rel.block_sum(z, g).collect()} == {("A", "A"): 7.0, ("B", "B"): 5.0}
    assert rel.lookup(z, "src", {}, "n").first().n is None
