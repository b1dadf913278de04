import random

import numpy as np

from terralane.llm import leakage
from terralane.llm.leakage import Items, Vocabulary, fingerprints, leaked_items, similarity, words


def test_words():
    assert words("It's (Águila) no-1,\n> 0.5 x​y") == ["its", "aguila", "no", "1", "0", "5", "xy"]
    assert words(None) == words(" -- ") == []
    assert len(fingerprints(Vocabulary().hashes(["a"] * 14))) == 0


def test_the_index_finds_exactly_the_fingerprints_within_the_radius():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    item = hashes[rng.integers(0, 60, 400)]
    index = Items([(1, item)])
    prints = index.prints[rng.integers(0, len(index.prints), 900)].copy()
    for k in range(900):
        for b in rng.choice(64, k % 24, replace=False):
            prints[k] ^= np.uint64(1 << int(b))
    got = set(zip(*(x.tolist() for x in index.within(prints))))
    apart = np.bitwise_count(prints[:, None] ^ index.prints[None, :])
    assert got == set(zip(*(x.tolist() for x in np.nonzero(apart <= leakage.RADIUS)))) and len(got) > 500


def test_shingles_tell_one_altered_word_from_two():
    for k in range(15):
        same = np.ones((1, 15), bool)
        same[0, k] = False
        assert similarity(same)[0] >= leakage.SIMILARITY - 1e-9
        for j in range(15):
            if j != k:
                two = same.copy()
                two[0, j] = False
                assert similarity(two)[0] < leakage.SIMILARITY - 1e-9


def test_radius_holds_what_one_altered_word_moves():
    rng = np.random.default_rng(6)
    far = 0
    for _ in range(4000):
        h = rng.integers(0, 1 << 63, 15, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 15, dtype=np.uint64)
        g = h.copy()
        g[rng.integers(15)] = rng.integers(0, 1 << 63, dtype=np.uint64)
        far += int(np.bitwise_count(fingerprints(h) ^ fingerprints(g))[0]) > leakage.RADIUS
    assert far <= 8


def test_words_altered_or_swapped_in_two_places(spark):
    item = [f"w{k}" for k in range(20)]
    two, swapped, one, long = list(item[:15]), list(item[:15]), list(item[:15]), list(item)
    two[2], two[11] = "x", "y"
    swapped[4], swapped[9] = swapped[9], swapped[4]
    one[7] = "x"
    long[0], long[19] = "x", "y"
    docs = [(k, " ".join(t)) for k, t in enumerate([two, swapped, one, long, item[:14]])]
    got = leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(2, 7), (3, 7)]


def brute(docs, items):
    out = set()
    for d, t in docs:
        a = words(t)
        for i, u in items:
            b = words(u)
            if any(sum(x == y for x, y in zip(a[p : p + 15], b[q : q + 15])) >= 14 for p in range(len(a) - 14) for q in range(len(b) - 14)):
                out.add((d, i))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(10, 40)))) for i in range(12)] + [(12, None), (13, "")]
    docs = []
    for d in range(80):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        w = (items[rng.randrange(12)][1]).split()
        n = rng.choice([13, 14, 15, 16, 25])
        piece = w[: n]
        for _ in range(rng.randint(0, 2)):
            piece[rng.randrange(len(piece))] = "changed"
        at = rng.randint(0, len(text))
        docs.append((d, " ".join(text[:at] + [p.upper() + "," for p in piece] + text[at:])))
    docs += [(900, None), (901, ""), (902, "x " * 50_000 + items[3][1])]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute([d for d in docs if d[1] and d[0] != 902], [i for i in items if i[1]])
    if len(words(items[3][1])) >= 15:
        want.add((902, 3))
    for room in (10_000, 60):
        assert {tuple(r) for r in leaked_items(a, b, item_words=room).collect()} == want
    assert leaked_items(a.limit(0), b).count() == 0 and leaked_items(a, b.limit(0)).count() == 0
