import random

from pyspark.sql import functions as F

from terralane.functions import text as tx
from terralane.functions.similarity import lcs, similarity, with_similarity
from terralane.operators import reconcile as rc


def test_expression_equals_arrow_function(spark):
    rng = random.Random(1)
    names = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 3))) for _ in range(60)] + [""]
    pairs = [(rng.choice(names), rng.choice(names)) for _ in range(80)]
    df = with_similarity(spark.createDataFrame(pairs, "a string, b string"), "a", "b").withColumn("x", tx.name_similarity(F.col("a"), F.col("b"))).withColumn("l", tx.lcs_length(F.col("a"), F.col("b")))
    for r in df.collect():
        assert abs(r.score - r.x) < 1e-12 and r.score == similarity(r.a, r.b) and r.l == lcs(r.a, r.b)


def test_candidates_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "coffee", "store", "cafe", "house"]

    def side(n):
        return [(i, " ".join(rng.sample(words, rng.randint(1, 3))) if rng.random() > 0.05 else None, 121 + rng.random() * 0.004 if rng.random() > 0.05 else None, 14.5 + rng.random() * 0.004) for i in range(n)]

    left, right = side(120), side(120)
    want = set()
    import math

    for i, a, x, y in left:
        for j, b, u, v in right:
            if None in (a, b, x, u):
                continue
            h = math.sin(math.radians(v - y) / 2) ** 2 + math.cos(math.radians(y)) * math.cos(math.radians(v)) * math.sin(math.radians(u - x) / 2) ** 2
            d = 2 * 6371008.8 * math.asin(min(1, math.sqrt(h)))
            s = similarity(a, b)
            generic = a in rc.GENERIC or b in rc.GENERIC or len(a) <= 4 or len(b) <= 4
            need = 0.7 if d <= 20 else 0.82 if d <= 50 else 0.9 if d <= 90 else 0.94
            if d <= 120 and (d <= 15 and s >= 0.99 if generic else s >= need):
                want.add((i, j))
    schema = "id int, name string, lon double, lat double"
    got = rc.candidate_pairs(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()
    assert {(r.left_id, r.right_id) for r in got} == want and len(got) == len(want) > 20


def test_names_of_parts_are_compared_in_batches(spark):
    """f08 runs over Arrow batches, without a table per letter in an expression, and gives the expression's values."""
    import __spark_entry__ as entry

    got = entry.queries()["f08_name_similarity"](spark, "/root/testdata/sf0.001")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambdafunction(concat(" not in plan and "aggregate(" not in plan
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(40)
    a, b, c = tx.fold("p_name"), tx.fold(F.concat_ws(" ", F.reverse(F.split("p_name", " ")))), tx.fold(F.concat("p_brand", F.lit(" "), "p_type"))
    want = {r[0]: (r[1], r[2]) for r in part.select("p_partkey", F.round(tx.name_similarity(a, b), 9), F.round(tx.name_similarity(a, c), 9)).collect()}
    rows = {r.p_partkey: (r.turned, r.other) for r in got.collect()}
    assert {k: rows[k] for k in want} == want and len(rows) == 200
