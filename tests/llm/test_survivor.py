import datetime as dt
import random

from pyspark.sql import functions as F

from terralane.llm.survivor import best_values, representatives, with_layers

SCHEMA = "cid string, op string, web string, observed_at timestamp, review_state string, part string"


def day(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(days=n)


def run(spark, rows, f=best_values):
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)
    return f(df, "cid", ["op"], ["web"])


def test_writings_recency_and_rejected_rows(spark):
    rows = [
        ("a", "Kevilos Luvisis Holdings Incorporated", "https://www.x-y.example/p/one", day(1), "verified"),
        ("a", "KEVILOS LUVISIS HOLDINGS INCORPORATED", "x-y.example", day(9), None),
        ("a", "Kevilos Luvisis Holdings Inc.", "n/a", day(8), "auto"),
        ("a", "Other Name Trading Corporation", "https://other.example/p/two", day(5), "auto"),
        ("a", "Newest But Rejected Cooperative", "https://z.example/q", day(20), "rejected"),
        ("b", "One Same Foundation Incorporated", None, day(1), "auto"),
        ("b", "One Same Foundation Incorporated", None, day(2), "auto"),
        ("c", "only rejected", "x", day(1), "rejected"),
        ("c", None, None, day(2), "auto"),
        ("d", "Pure Mgt. Corp.", "https//:broken.example/a", None, "auto"),
        ("d", "Pure Management Corporation", "https://broken.example/a", day(1), "auto"),
        (None, "No Key", "x", day(1), "auto"),
    ]
    got = {(r.cid, r.field_name): r.field_value for r in run(spark, rows).collect()}
    assert got == {
        ("a", "op"): "Kevilos Luvisis Holdings Incorporated",
        ("a", "web"): "https://www.x-y.example/p/one",
        ("d", "op"): "Pure Management Corporation",
        ("d", "web"): "https://broken.example/a",
    }
    shuffled = {(r.cid, r.field_name): r.field_value for r in run(spark, rows[::-1] + rows[:4]).collect()}
    assert shuffled == got


def test_empty_and_representatives(spark):
    assert run(spark, []).count() == 0
    rows = [("a", "X Y Holdings Incorporated", None, day(1), "auto"), ("a", "", "https://h.example/x", day(2), "auto"), ("b", None, None, day(1), "auto")]
    got = {r.cid: (r.op, r.web) for r in run(spark, rows, representatives).collect()}
    assert got == {"a": ("X Y Holdings Incorporated", "https://h.example/x"), "b": (None, None)}


def test_hot_group(spark):
    rows = [("hot", f"Name {i % 50} Trading Corporation", f"https://h{i % 40}.example/a", day(i), "auto") for i in range(2000)]
    got = {r.field_name: r.field_value for r in run(spark, rows).collect()}
    assert got == {"op": "Name 49 Trading Corporation", "web": "https://h39.example/a"}


RECORDS = "cid string, a string, b string, c string, w string, observed_at timestamp, review_state string"


def test_a_dominated_record_waits_for_its_layer(spark):
    rows = [
        # the survivor, which lacks b, c and w
        ("g", "Alpha New", None, None, None, day(9), "auto"),
        # layer 1 for its b; dominates the next record, whose b is another
        ("g", "Alpha Old", "Beta New", None, None, day(7), "verified"),
        ("g", None, "Beta Old", None, None, day(7), "auto"),
        # a deeper layer of stumps and an unknown, and a rejected record that gives nothing
        ("g", None, None, "x", "n/a", day(1), "auto"),
        ("g", None, None, None, "https://rejected.example/a", day(20), "rejected"),
    ]
    df = spark.createDataFrame(rows, RECORDS)
    got = {r.field_name: r.field_value for r in best_values(df, "cid", ["a", "b", "c"], ["w"]).collect()}
    assert got == {"a": "Alpha New", "b": "Beta New"}


def brute_layers(points):
    def over(q, p):
        pairs = [(q[0], p[0]), (q[2], p[2]), *zip(q[3], p[3])]
        return all(x >= y for x, y in pairs) and any(x > y for x, y in pairs)

    left, out, layer = list(points), [], 0
    while left:
        layer += 1
        top = [p for p in left if not any(over(q, p) for q in left)]
        out += [(layer, *p) for p in sorted(top, reverse=True)]
        left = [p for p in left if p not in top]
    return out


def test_layers_equal_peeling(spark):
    rng = random.Random(11)
    kind = "seen:timestamp,total:int,trust:int,full:array<int>,v:array<string>"
    groups = []
    for g in range(40):
        points = set()
        for k in range(rng.randint(1, 14)):
            full = tuple(rng.randint(0, 2) for _ in range(3))
            points.add((day(rng.randint(0, 5)), sum(full), rng.randint(1, 2), full, (str(k),)))
        groups.append((g, [(a, b, c, list(d), list(e)) for a, b, c, d, e in points]))
    df = spark.createDataFrame(groups, f"g int, records array<struct<{kind}>>")
    for r in df.select("g", with_layers(F.col("records"), 3, kind).alias("x")).collect():
        got = [(p.layer, p.seen, p.total, p.trust, tuple(p.full), tuple(p.v)) for p in r.x]
        want = brute_layers([(a, b, c, tuple(d), tuple(e)) for a, b, c, d, e in groups[r.g][1]])
        assert [x[0] for x in got] == [x[0] for x in want] and got == want


def test_ties_and_slips(spark):
    rows = [("t", "Same Day One Inc.", None, day(3), "auto"), ("t", "Same Day Two Inc.", "https://a.example/b", day(3), "auto"), ("t", "Same Day Zoo Inc.", None, day(3), "verified"), ("u", "ab", None, day(9), "auto"), ("u", "Long Name Cooperative", None, day(1), "auto")]
    got = {(r.cid, r.field_name): r.field_value for r in run(spark, rows).collect()}
    assert got == {("t", "op"): "Same Day Two Inc.", ("t", "web"): "https://a.example/b", ("u", "op"): "Long Name Cooperative"}
