import numpy as np
import pytest

from terralane.llm import mixing


def documents(spark):
    text = {"a": "road street lane map node", "b": "tax budget council vote minutes", "c": "price food waiter menu table"}
    rows = [(i, s, " ".join([text[s]] * (3 + i % 4))) for s, n in (("a", 400), ("b", 60), ("c", 200)) for i in range(n)]
    rows = [(k, s, t) for k, (_, s, t) in enumerate(rows)] + [(9000, None, "x"), (9001, "unlisted", "y z"), (9002, "a", None), (9003, "a", "")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


TARGETS = [("a", 0.4, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("nothing", 0.1, 2)]


def test_shares(spark):
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    copies, report = mixing.mixed(documents(spark), targets)
    got = {r.source: r for r in report.collect()}
    assert got["nothing"].actual_share == 0
    for s, share in (("a", 0.4), ("b", 0.3), ("c", 0.2)):
        assert got[s].actual_share == pytest.approx(share / 0.9, rel=0.005) and got[s].most_repeats <= dict((t[0], t[2]) for t in TARGETS)[s]
    assert {r.source for r in copies.select("source").distinct().collect()} == {"a", "b", "c"}


def test_total_beyond_repeats_and_empty(spark):
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    report = {r.source: r for r in mixing.mixed(documents(spark), targets, total_tokens=1e6)[1].collect()}
    assert report["b"].mean_repeats == 3 and report["a"].most_repeats == 1
    assert mixing.mixed(documents(spark).limit(0), targets)[1].count() == 4
    counter = mixing.TokenCounter(mixing.TOKENIZER)
    for text in ("a" * 300_000, " " * 200_000 + "x", "word " * 50_000, "1" * 100_000):
        assert counter.encoding.decode(counter.ids(text)) == text
    assert counter.count(None) == counter.count("") == 0 and counter.count("a" * 300_000) > 0 and counter.count("one two") == 2


def brute(t, s, p, start, caps, weight, goal):
    """Plain projected gradient on all rates until nothing moves."""
    u = np.hstack([np.eye(len(caps))[s], p])
    r = start[s].copy()
    bound = np.linalg.eigvalsh((u * t[:, None]).T @ u * weight[None, :] ** 0.5 * weight[:, None] ** 0.5).max() + 1
    look, k = r.copy(), 0
    for _ in range(60_000):
        new = np.clip(look - (look - start[s] + u @ (weight * ((t * look) @ u - goal))) / bound, 0, caps[s])
        k = 0 if (look - new) @ (new - r) > 0 else k + 1
        r, look = new, new + k / (k + 3) * (new - r)
    return r


def test_rates_equal_plain_projected_gradient(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCE_WEIGHT", 30.0)
    rng = np.random.default_rng(4)
    n, k = 150, 3
    s, t = rng.integers(0, k, n), rng.integers(0, 60, n).astype(float)
    p = rng.dirichlet([0.5] * k, n)
    caps = np.array([1.0, 3.0, 2.0])
    rows = [(i, "abc"[s[i]], int(t[i]), p[i].tolist()) for i in range(n)]
    members = spark.createDataFrame(rows, "doc_id long, source string, tokens long, p array<double>")
    available, offered = np.array([t[s == j].sum() for j in range(k)]), t @ p
    for total in (1500.0, 4000.0, 9000.0):
        goal = np.array([0.5, 0.3, 0.2]) * total
        fit, domains = mixing.fitted(members, list("abc"), caps, available, offered, goal)
        got, _ = fit.rates(*fit.described(["abc"[x] for x in s], p))
        weight = np.concatenate([30.0 / available, 1.0 / offered])
        want = brute(t, s, p, fit.start, caps, weight, np.concatenate([goal, goal]))
        assert np.abs((got - want)[t > 0]).max() < 1e-3 and np.allclose(domains, (t * got) @ p)
        assert (got >= 0).all() and (got <= caps[s]).all()


def test_whole_copies_keep_the_totals(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "a", int(rng.integers(1, 400)), float(rng.uniform(0, 2))) for i in range(800)]
    rated = spark.createDataFrame(rows, "doc_id long, source string, tokens long, rate double")
    for bucket in (100, 10_000):
        got = mixing.whole_copies(rated, {"a": 2.0}, bucket).collect()
        assert len(got) == 800 and all(abs(r.copies - r.rate) < 1 and r.copies <= 2 for r in got)
        assert abs(sum(r.copies * r.tokens for r in got) - sum(r[2] * r[3] for r in rows)) < 0.002 * sum(r[2] * r[3] for r in rows)
