import random

from terralane.llm.abuse import Chain, Reader, rates, scored, sentences, train


def test_disguises():
    r = Reader()
    for w in ("idiot", "1d10t", "іdіоt", "idiooooot", "i***t", "idoit", "IDIOTS"):
        assert r.read(f"You are a {w}.")[1]["insult"] > 0, w
    for s in ("You i-d-i-o-t.", "what an i d i o t", "a.s.s.h.o.l.e"):
        assert r.read(s)[1]["insult"] > 0, s
    assert not r.read("Road 1 2 3 4 is closed since 2021")[1]
    assert sentences(None) == sentences("  ") == []
    assert len(sentences("w " * 1000)) > 30


def corpus():
    rng = random.Random(4)
    clean = ["The pin is {} metres west.", "Prices start at {} pesos.", "The sex ratio of workers is {}.", "Opening hours are {} to 9.", "We waited {} minutes and the order was cold."]
    bad = ["You are a useless {}, get lost.", "I will burn down the shop with the {} inside.", "Those foreigners are {} and must be driven out.", "Send me your {} photos, baby."]
    fill = {0: ["idiot", "moron", "bastard"], 1: ["idiot", "bastard"], 2: ["vermin", "rats", "animals"], 3: ["nude", "xxx", "porn"]}
    docs = []
    for d in range(500):
        parts = [rng.choice(clean).format(rng.randint(1, 99)) for _ in range(rng.randint(1, 6))]
        abusive = d % 5 == 0
        if abusive:
            k = rng.randrange(4)
            parts.insert(rng.randint(0, len(parts)), bad[k].format(rng.choice(fill[k])))
        docs.append((d, " ".join(parts), "s%d" % (d % 3), abusive))
    return docs


def test_held_out_accuracy(spark):
    docs = corpus()
    rng = random.Random(9)
    df = spark.createDataFrame([(d, t, s) for d, t, s, _ in docs] + [(900, None, None), (901, "", None), (902, "*a" * 200_000 + " e" * 100_000, None)], "doc_id long, text string, source string")
    votes = [(d, "r", int(a) ^ (rng.random() < 0.03)) for d, _, _, a in docs if d % 2 == 0 or d % 5 == 0 and d % 3 == 0] + [(1, "r", None)]
    labels = spark.createDataFrame(votes, "doc_id long, rater string, abusive int")
    out = scored(df, train(df, labels), extra=["source"])
    got = {r.doc_id: r.score for r in out.collect()}
    assert got[900] == got[901] == 0
    held = [(d, a) for d, _, _, a in docs if d not in {v[0] for v in votes}]
    wrong = [d for d, a in held if (got[d] >= 0.5) != a]
    assert len(wrong) <= 0.03 * len(held)
    by = {r.source: r.documents for r in rates(out).collect()}
    assert by[None] == 3 and sum(by.values()) == 503


def test_no_labels(spark):
    chain = Chain([])
    df = spark.createDataFrame([(1, "you idiot")], "doc_id long, text string")
    assert scored(df, chain).first().score <= 0.5
    assert scored(df.limit(0), chain).count() == 0
