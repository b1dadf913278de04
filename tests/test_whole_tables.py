"""Queries over whole tables against brute force on small tables whose keys no modulo filter keeps."""

import math
from types import SimpleNamespace
import struct
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from terralane.operators import taxonomy as tx

TYPES = ["PROMO", "LARGE", "SMALL"]


def part_rows(n=40):
    return [(k, f"name{k % 7} shade{k % 5}", f"Brand#{k % 3 + 11}", TYPES[k % 3], k % 10, 1.0) for k in range(1, n + 1)]


def line_rows():
    return [(o, (o * 13 + n * 7) % 40 + 1, (o * 5 + n) % 9 + 1, n, float(o % 4 + n)) for o in range(1, 10) for n in range(1, o % 4 + 2)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(part_rows(), "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame(line_rows(), "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{d}/lineitem.parquet")
    return d


def run(spark, folder, name):
    return [tuple(r) for r in entry.queries()[name](spark, folder).collect()]


def code_of():
    return {k: (kind, f"{kind}/{brand}", f"{kind}/{brand}/{size % 5}") for k, _, brand, kind, size, _ in part_rows()}


def deepest(paths):
    shared = [level for level in zip(*paths) if len(set(level)) == 1]
    return shared[-1][0] if shared else None


def test_common_ancestor_of_every_order(spark, folder):
    code, orders = code_of(), defaultdict(list)
    for o, p, _, _, _ in line_rows():
        orders[o].append(code[p])
    assert dict(run(spark, folder, "t02_common_ancestor")) == {o: deepest(paths) for o, paths in orders.items()}


def test_fusion_reads_every_line(spark, folder):
    code, orders = code_of(), defaultdict(lambda: ([], []))
    for o, p, _, n, _ in line_rows():
        orders[o][n % 2 == 0].append(code[p] if n % 2 else code[p][:1])
    got = {i: (c, r) for i, c, r, _ in run(spark, folder, "t13_fusion")}
    assert set(got) == set(orders)
    for o, groups in orders.items():
        said = [set(g) for g in groups if g]
        kept = [p for p in said[0] if len(said) == 1 or any(p[: len(q)] == q for q in said[1])]
        want = deepest(kept) if kept else None
        assert got[o][0] == want
        if len(said) == 1:
            assert got[o][1] == ("UNION" if len(said[0]) > 1 or want is None else "SINGLE")
        else:
            assert (got[o][1] == "CONFLICT") == (not kept) and (got[o][1] == "UNION") == (bool(kept) and want is None)


def test_map_union_of_every_order(spark, folder):
    code, want = code_of(), defaultdict(set)
    for o, p, _, _, _ in line_rows():
        kind, brand, _ = code[p]
        want[o].add(f"B-{brand.split('/')[1]}" if brand.endswith("1") else f"T-{kind}")
    assert dict(run(spark, folder, "t19_map_union")) == {o: "; ".join(sorted(v)) for o, v in want.items()}


def rings():
    links, weight = defaultdict(set), defaultdict(float)
    for _, p, s, _, q in line_rows():
        u, v = f"p{p % 200}", f"s{s}"
        links[u].add(v)
        links[v].add(u)
        weight[u, v] += q
        weight[v, u] += q
    depth, ring = {"p7": 0}, ["p7"]
    for k in (1, 2):
        ring = sorted({v for u in ring for v in links[u]} - set(depth))
        depth |= {v: k for v in ring}
    return depth, weight


def test_ego_network_and_parents_of_every_line(spark, folder):
    depth, weight = rings()
    assert len(depth) > 2 and {n: k for n, k, cut in run(spark, folder, "n11_ego_network") if not cut} == depth
    best = {}
    for (u, v), w in weight.items():
        if u in depth and v in depth and depth[v] == depth[u] + 1:
            best[v] = min(best.get(v, (0.0, "")), (-w, u))
    assert {n: (p, w) for n, p, w in run(spark, folder, "q10_strongest_parent")} == {v: (u, -w) for v, (w, u) in best.items()}


def test_shards_hold_every_edge(spark, folder):
    want = {(x // 16, s, p % 100, q) for _, p, s, _, q in line_rows() for x in (s, p % 100)}
    got = run(spark, folder, "snk12_adjacency_shards")
    assert len(got) == len(want) and set(got) == want


def test_contract_joins_every_order(spark, folder):
    want = []
    for o in range(1, 10):
        own = sorted((n, q) for k, _, _, n, q in line_rows() if k == o)
        chain = []
        for i, (_, q) in enumerate(own, 1):
            if not chain or (o * 10 + i) % 3 == 0:
                chain.append([o, o * 10 + i, 0, 0.0])
            chain[-1][2:] = [o * 10 + i + 1, chain[-1][3] + q]
        want += [tuple(c) for c in chain]
    got = [(e, u, v, length) for e, _, u, v, length in run(spark, folder, "snk08_contract")]
    assert sorted(got) == sorted(want)


@pytest.fixture(scope="module")
def beyond(spark, tmp_path_factory):
    """Parts and localities whose keys lie beyond every former prefix."""
    d = str(tmp_path_factory.mktemp("beyond"))
    rows = [(k + 2000, *rest) for k, *rest in part_rows()]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
    square = struct.pack("<BIII10d", 1, 3, 1, 5, 0, 0, 2, 0, 2, 2, 0, 2, 0, 0)
    spark.createDataFrame([(41, bytearray(square))], "locality_id long, geometry binary").write.parquet(f"{d}/area_localities.parquet")
    spark.createDataFrame([(1, 1.0, 1.5, None), (2, 3.0, 1.0, None)], "rec_id long, latitude double, longitude double, geometry binary").write.parquet(f"{d}/places.parquet")
    return d


KEYS = range(2001, 2041)


def spot(k):
    return k * 37 % 1300 + 0.25, k * 53 % 1290 + 7.0


def test_every_point_snaps(spark, beyond):
    want = {k: round(min(abs(c - round(c / 100) * 100) for c in spot(k)), 6) for k in KEYS}
    assert dict(run(spark, beyond, "j09_snap")) == pytest.approx(want)
    assert {r[0] for r in run(spark, beyond, "j10_distinct_positions")} == set(KEYS)
    assert sum(r[2] for r in run(spark, beyond, "n03_split_arcs")) > 2 * 14 * 13


def test_every_node_distance(spark, beyond):
    want = {}
    for k in KEYS:
        a, b = k * 3 % 196, 5 if k % 2 == 0 else 100
        want[k] = (abs(a // 14 - b // 14) + abs(a % 14 - b % 14)) * 100.0
    assert {i: d for i, _, d in run(spark, beyond, "n08_point_distances")} == want


def test_neighbours_of_every_part(spark, beyond):
    pairs = {(a, b): d for a, b, d in run(spark, beyond, "n06_neighbour_graph")}
    near = {}
    for k in KEYS:
        x, y = spot(k)
        if abs(x - round(x / 100) * 100) < abs(y - round(y / 100) * 100):
            near[k] = (round(x / 100) * 100.0, y)
        else:
            near[k] = (x, round(y / 100) * 100.0)
    for a in KEYS:
        for b in KEYS:
            (x, y), (u, v) = near[a], near[b]
            if a < b and (x % 100 == 0) != (u % 100 == 0):  # on crossing roads the way is the city-block distance
                d = abs(x - u) + abs(y - v)
                assert ((a, b) in pairs) == (d <= 150) and pairs.get((a, b), d) == pytest.approx(d)
    assert pairs


def test_names_of_every_part(spark, beyond):
    assert {r[0] for r in run(spark, beyond, "f08_name_similarity")} == set(KEYS)


def test_clip_by_every_locality(spark, beyond):
    assert run(spark, beyond, "j07_boundary_clip") == [(1,)]


def nearest(queries, targets, k):
    docs = {("q", i): text for i, text in queries} | {("t", i): text for i, text in targets}
    counts = {}
    for key, text in docs.items():
        w = text.lower().replace("#", " ").split()
        counts[key] = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df = Counter(t for c in counts.values() for t in c)
    vectors = {}
    for key, c in counts.items():
        v = {t: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors[key] = {t: x / norm for t, x in v.items()}
    out = {}
    for i, _ in queries:
        scored = [(-round(sum(x * vectors["t", j].get(t, 0.0) for t, x in vectors["q", i].items()), 9), f"t{j}") for j, _ in targets]
        out[str(i)] = [(t[1:], pytest.approx(-s, abs=2e-6)) for s, t in sorted(scored)[:k] if s < 0]
    return out


@pytest.mark.parametrize("block", [7, 5_000])
def test_retrieval_of_every_part(spark, beyond, block):
    names = [(k + 2000, name) for k, name, *_ in part_rows()]
    targets = [(k + 2000, f"{name} {kind}") for k, name, _, kind, *_ in part_rows()]
    a, b = (spark.createDataFrame(x, "id long, text string") for x in (names, targets))
    got = defaultdict(list)
    for r in tx.retrieve(a, b, 5, block).orderBy("query", "rank").collect():
        got[r.query].append((r.target, r.score))
    assert got == nearest(names, targets, 5)


def test_retrieval_queries_read_every_part(spark, beyond):
    assert {r[0] for r in run(spark, beyond, "t04_retrieval")} == set(map(str, KEYS))
    assert {r[0] for r in run(spark, beyond, "t09_automatic_mapping")} == set(map(str, KEYS))


@pytest.fixture
def sizes(monkeypatch):
    """Numbers of blocks before rounding that ``retrieve`` makes."""
    seen = []
    monkeypatch.setattr(tx, "math", SimpleNamespace(ceil=lambda x: seen.append(x) or math.ceil(x)))
    return seen


def test_equal_texts_are_compared_once(spark, sizes):
    names = [(k, ("red bolt", "blue bolt", None)[k % 3]) for k in range(30)]
    targets = [(k, ("red bolt new", "blue rod", "anvil")[k % 3]) for k in range(40)]
    a, b = (spark.createDataFrame(x, "id long, text string") for x in (names, targets))
    got = defaultdict(list)
    for r in tx.retrieve(a, b, 5, 10).orderBy("query", "rank").collect():
        got[r.query].append((r.target, r.score))
    want = nearest([(k, n or "") for k, n in names], targets, 5)
    assert got == {k: v for k, v in want.items() if v} and len(got) == 20
    assert sizes == [0.3, 0.3]


def test_mapping_compares_equal_names_once(spark, sizes):
    rows = run(spark, "/root/testdata/sf0.001", "t09_automatic_mapping")
    assert len(rows) == 200 and len(sizes) == 2 and sizes[0] * 5_000 <= 64
