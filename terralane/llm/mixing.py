"""Mixing sources to target weights.

A classifier trained on documents with a recorded source gives every document posteriors over the
domains (the listed sources) by its text alone.  Nonnegative document rates are then fitted by
distributed projected gradient steps: the squared distance of the expected token totals of the domains
and of the totals of the recorded sources from their targets is made small under the bound that a rate
never exceeds the repeats of its source, with as little change of the rates as that takes.  The steps
are scaled by the curvature of the documents whose rates are not at a bound, so a few passes over the
table of memberships are enough, and only the sum of the steps is kept.  The fit runs until its
optimum; it raises an error if it does not get there.  Rates become whole copies by carrying the error
in tokens from document to document.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terralane.session import cut

#: Rank file of a public byte-level tokenizer; the executors read it at this path.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Labelled documents the classifier is trained on at most, chosen by a hash of their id.
MAX_LABELLED = 20_000
FEATURES = 16_384
#: Tokens of text whose evidence counts in full; longer texts give the mean of their evidence so often.
EVIDENCE_TOKENS = 12
#: Weights of the squared distances of source totals and of domain totals, against the change of the rates.
SOURCE_WEIGHT, DOMAIN_WEIGHT = 1e5, 1.0
#: Steps after which a fit that has not converged is an error, and what counts as converged.
STEPS, TOLERANCE = 80, 1e-7
#: Documents among which the error of whole copies is carried.
BUCKET = 20_000


class TokenCounter:
    """Tokens of texts of any length by a rank file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> list[int]:
        return self.encoding.encode_ordinary(text) if text else []

    def count(self, text: str | None) -> int:
        return len(self.ids(text))


def train_domains(documents: DataFrame, sources: list[str], tokenizer: str = TOKENIZER, max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """Log token probabilities (FEATURES, domains) of a smoothed multinomial model.

    Trained on at most ``max_labelled`` whole documents of the given sources; the counts are summed
    where the documents are, only the table of counts comes to the driver.
    """
    number = {s: i for i, s in enumerate(sources)}
    k = len(sources)
    labelled = documents.filter(F.col("source").isin(sources))
    # at most max_labelled ids: small enough for every task, so that no text is sorted or shuffled
    chosen = labelled.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample = labelled.select("doc_id", "source", "text").join(F.broadcast(chosen), "doc_id", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, total = TokenCounter(tokenizer), np.zeros((k, FEATURES), np.int64)
        for batch in batches:
            for source, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                ids = counter.ids(text.as_py())
                if ids:
                    total[number[source]] += np.bincount(np.array(ids) % FEATURES, minlength=FEATURES)
        where = np.argwhere(total > 0)
        yield pa.RecordBatch.from_arrays([pa.array(where[:, 0].astype(np.int32)), pa.array(where[:, 1].astype(np.int32)), pa.array(total[where[:, 0], where[:, 1]])], names=["d", "f", "n"])

    counts = np.zeros((k, FEATURES))
    for row in sample.mapInArrow(count, "d int, f int, n long").groupBy("d", "f").agg(F.sum("n").alias("n")).collect():
        counts[row["d"], row["f"]] = row["n"]
    smooth = counts + 0.1
    return np.log(smooth / smooth.sum(1, keepdims=True)).T


def memberships(documents: DataFrame, sources: list[str], model: np.ndarray, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, source, tokens, p)`` of the documents of the given sources; p are the domain posteriors.

    The posteriors come from the text, which is read as a whole and tokenized once; the evidence of a
    text counts like that of a limited number of tokens, since tokens of one text are not independent.
    A text without tokens belongs to all domains alike.
    """
    k = len(sources)
    shipped = documents.sparkSession.sparkContext.broadcast(model)
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")).filter(F.col("source").isin(sources))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, evidence = TokenCounter(tokenizer), shipped.value
        for batch in batches:
            tokens, z = np.zeros(len(batch), np.int64), np.zeros((len(batch), k))
            for i, text in enumerate(batch.column(2)):
                ids = counter.ids(text.as_py())
                tokens[i] = len(ids)
                if ids:
                    z[i] = evidence[np.array(ids) % FEATURES].sum(0) * min(1.0, EVIDENCE_TOKENS / len(ids))
            z = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
            p = z / z.sum(1, keepdims=True) if len(z) else z
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * k), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens), lists], names=["doc_id", "source", "tokens", "p"])

    return chosen.mapInArrow(run, "doc_id long, source string, tokens long, p array<double>")


class Fit:
    """State of the fit: what every document's rate follows from, without a row per document.

    A document is described by u, its recorded source (one of k) followed by its k posteriors; its rate is
    the start of its source less u times the sum of all steps, projected onto 0 .. repeats.
    """

    def __init__(self, sources: list[str], start: np.ndarray, caps: np.ndarray):
        self.number = {s: i for i, s in enumerate(sources)}
        self.start, self.caps = start, caps
        self.steps = np.zeros(2 * len(sources))

    def described(self, source: list[str], p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = np.array([self.number[x] for x in source], np.int64)
        u = np.zeros((len(s), 2 * len(self.start)))
        u[np.arange(len(s)), s] = 1.0
        u[:, len(self.start) :] = p
        return s, u

    def rates(self, s: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rates, whether a rate is at no bound)."""
        free = self.start[s] - u @ self.steps
        return np.clip(free, 0.0, self.caps[s]), (free > 0) & (free < self.caps[s])


def _totals(members: DataFrame, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """(totals, curvature): tokens of sources and domains at the present rates; sums of t u u' of documents at no bound."""
    m = len(fit.steps)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, curvature = np.zeros(m), np.zeros((m, m))
        for batch in batches:
            p = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, m // 2)
            t = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            s, u = fit.described(batch.column(0).to_pylist(), p)
            r, free = fit.rates(s, u)
            total += (t * r) @ u
            curvature += (u * (t * free)[:, None]).T @ u
        values = np.concatenate([total, curvature.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["n", "x"])

    out = np.zeros(m + m * m)
    for n, x in members.select("source", "tokens", "p").mapInArrow(add, "n int, x double").groupBy("n").agg(F.sum("x")).collect():
        out[n] = x
    return out[:m], out[m:].reshape(m, m)


def fitted(members: DataFrame, sources: list[str], caps: np.ndarray, available: np.ndarray, offered: np.ndarray, goal: np.ndarray) -> tuple[Fit, np.ndarray]:
    """(fit, expected totals of the domains) at the optimum.

    ``available`` and ``offered`` are the tokens of the sources and the expected tokens of the domains
    at one copy of every document, ``goal`` the wanted totals.
    """
    fit = Fit(sources, np.minimum(goal / np.maximum(available, 1.0), caps), caps)
    k = len(sources)
    weight = np.concatenate([SOURCE_WEIGHT / np.maximum(available, 1.0), DOMAIN_WEIGHT / np.maximum(offered, 1.0)])
    wanted = np.concatenate([goal, goal])

    def off(totals: np.ndarray) -> np.ndarray:
        # at the optimum the sum of the steps is the gradient of the squared distances
        return fit.steps - weight * (totals - wanted)

    totals, curvature = _totals(members, fit)
    miss = off(totals)
    for _ in range(STEPS):
        if np.abs(miss).max() <= TOLERANCE * max(1.0, np.abs(fit.steps).max()):
            return fit, totals[k:]
        step = np.linalg.solve(np.eye(2 * k) + weight[:, None] * curvature, miss)
        before, size, length = fit.steps, np.abs(miss / weight).sum(), 1.0
        while True:
            fit.steps = before - length * step
            totals, curvature = _totals(members, fit)
            miss = off(totals)
            if np.abs(miss / weight).sum() < size or length < 1e-3:
                break
            length /= 2
    raise RuntimeError(f"the rates did not converge within {STEPS} steps")


def whole_copies(rated: DataFrame, caps: dict[str, float], bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, source, tokens, rate, copies)``: rates made whole, so that the tokens of a source come out as fitted.

    Documents of a source are spread over buckets by a hash; in a bucket, from long to short texts, every
    document takes the whole number of copies next to its rate that leaves the smaller error in tokens,
    and hands the error on.
    """
    sizes = rated.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / bucket).cast("int").alias("buckets"))
    placed = rated.join(F.broadcast(sizes), "source").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.col("buckets")))

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "doc_id"], ascending=[False, True], kind="stable")
        cap = int(caps[pdf["source"].iloc[0]])
        copies, error = [], 0.0
        for t, r in zip(pdf["tokens"].tolist(), pdf["rate"].tolist()):
            low = min(int(r + 1e-9), cap)
            more = low < cap and r - low > 1e-9 and abs(error + (r - low - 1) * t) < abs(error + (r - low) * t)
            copies.append(low + more)
            error += (r - copies[-1]) * t
        return pdf.assign(copies=copies)[["doc_id", "source", "tokens", "rate", "copies"]]

    return placed.groupBy("source", "bucket").applyInPandas(carry, "doc_id long, source string, tokens long, rate double, copies int")


def mixed(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(copies, report) of a mix in which the sources have their target shares.

    copies: ``(doc_id, source, tokens, rate, copies)`` of every document of a listed source.  report:
    one row per row of ``targets`` with the tokens at hand, the copies taken, the actual share of the
    mix, the expected share by domain, and mean and largest repeats.  Sources that are not listed and
    null sources stay out.  Without ``total_tokens`` the mix is as large as it can be with every source
    that has text at its share; a larger total leaves the sources whose repeats are used up below
    their share.  Listed sources without text have share 0 and the others share in proportion.
    """
    listed = [(r["source"], float(r["target_share"] or 0.0), int(r["max_repeats"] if r["max_repeats"] is not None else 1)) for r in targets.filter("source IS NOT NULL").dropDuplicates(["source"]).collect()]
    present = {r["source"] for r in documents.filter(F.col("source").isin([s for s, _, _ in listed]) & (F.length("text") > 0)).select("source").distinct().collect()}
    sources = sorted(s for s, v, m in listed if s in present and v > 0 and m > 0)
    share, repeats = {s: v for s, v, _ in listed}, {s: float(max(0, m)) for s, _, m in listed}
    spark = documents.sparkSession
    if not sources:
        copies = spark.createDataFrame([], "doc_id long, source string, tokens long, rate double, copies int")
        return copies, _report(copies, targets, {})
    members = cut(memberships(documents, sources, train_domains(documents, sources, tokenizer), tokenizer))
    k = len(sources)
    offers = members.groupBy("source").agg(F.sum("tokens").alias("t"), *[F.sum(F.col("tokens") * F.col("p")[i]).alias(f"p{i}") for i in range(k)]).collect()
    tokens = {r["source"]: float(r["t"]) for r in offers}
    available = np.array([tokens.get(s, 0.0) for s in sources])
    offered = np.array([sum(r[f"p{i}"] for r in offers) for i in range(k)])
    wanted = np.array([share[s] for s in sources]) / sum(share[s] for s in sources)
    caps = np.array([repeats[s] for s in sources])
    if total_tokens is None:
        total_tokens = float((caps * available / wanted).min())
    fit, expected = fitted(members, sources, caps, available, offered, wanted * total_tokens)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            r, _ = fit.rates(*fit.described(batch.column(1).to_pylist(), p))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(r)], names=["doc_id", "source", "tokens", "rate"])

    rated = members.mapInArrow(rate, "doc_id long, source string, tokens long, rate double")
    copies = cut(whole_copies(rated, repeats))
    return copies, _report(copies, targets, dict(zip(sources, (expected / max(1e-9, expected.sum())).tolist())))


def _report(copies: DataFrame, targets: DataFrame, expected: dict[str, float]) -> DataFrame:
    by_source = copies.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("available_tokens"), F.sum((F.col("copies") > 0).cast("long")).alias("used_documents"),
        F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("tokens")).alias("mixed_tokens"), F.max("copies").alias("most_repeats"))
    rows = targets.filter("source IS NOT NULL").dropDuplicates(["source"]).select("source", "target_share", "max_repeats")
    soft = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])[F.col("source")] if expected else F.lit(None).cast("double")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("documents", "available_tokens", "used_documents", "copies", "mixed_tokens", "most_repeats")]
    joined = rows.join(by_source, "source", "left").select("source", "target_share", "max_repeats", *zero)
    # as many rows as there are targets
    return joined.withColumn("total", F.sum("mixed_tokens").over(W.partitionBy(F.lit(1)))).select(
        "source", "target_share", "max_repeats", "documents", "available_tokens", "used_documents", "copies", "mixed_tokens",
        F.when(F.col("total") > 0, F.round(F.col("mixed_tokens") / F.col("total"), 6)).otherwise(F.lit(0.0)).alias("actual_share"),
        F.round(F.coalesce(soft, F.lit(0.0)), 6).alias("expected_share"),
        F.when(F.col("documents") > 0, F.round(F.col("copies") / F.col("documents"), 6)).otherwise(F.lit(0.0)).alias("mean_repeats"), "most_repeats")
