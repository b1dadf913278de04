"""Evaluation texts leaking into training text.

Windows of 15 words, the size of the passages of items that count as leaked, are fingerprinted by
SimHash (64 bits, every word votes on every bit).  The fingerprints of the item windows stand in a
multi-index: cut into ``BLOCKS`` blocks, two fingerprints within ``RADIUS`` bits of each other agree up to
``NEAR`` bits in at least one block, so a document window that looks up its blocks with up to ``NEAR``
bits changed meets every item window within the radius and none is left out.  Candidates are verified
exactly by the weighted similarity of their shingles, single words and pairs of neighbours at the same
place; the threshold is what one altered word inside the window leaves.

One altered word of 15 moves a fingerprint by 6.7 bits on average (deviation 2.4), so the radius misses
about one in 3,000 passages that are no longer than a window and altered; longer passages have more windows.
Before the lookup, windows are passed over that hold two words that stand in no item: such a window has
two altered words against every item.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terralane.session import cut

#: Words in a row that make a leak, and how many of them may be altered.
WINDOW, ALTERED = 15, 1
#: Blocks of a 64-bit fingerprint, bits in which a block may differ, and the radius that follows.
BLOCKS, NEAR = 4, 3
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Weights of the two kinds of shingles, words and pairs of words.
WORD_WEIGHT, PAIR_WEIGHT = 1.0, 1.0
WHOLE = WORD_WEIGHT * WINDOW + PAIR_WEIGHT * (WINDOW - 1)
#: Similarity that one altered word leaves at least; two altered words leave less wherever they stand.
SIMILARITY = (WORD_WEIGHT * (WINDOW - 1) + PAIR_WEIGHT * (WINDOW - 3)) / WHOLE
#: Words of documents worked on at once, words of items sent to every task at once, words of a piece of an item.
CHUNK_WORDS, ITEM_WORDS, PIECE_WORDS = 200_000, 1_000_000, 10_000
#: Size of the table that tells words of items from others; words that share a place only weaken it.
TABLE = 1 << 22

_WORD = re.compile(r"[^\W_]+")
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x27, 0x2019, 0x2BC], None)


def words(text: str | None) -> list[str]:
    """Words without case, punctuation, accents and marks; apostrophes and invisible characters vanish."""
    if not text:
        return []
    text = text.translate(_INVISIBLE)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if not unicodedata.combining(c))
    return _WORD.findall(text.lower())


class Vocabulary:
    """64-bit hashes of words, kept at hand up to a bound."""

    def __init__(self, bound: int = 500_000):
        self.known: dict[str, int] = {}
        self.bound = bound

    def hashes(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.bound:
            known.clear()
        out = np.empty(len(tokens), np.uint64)
        for i, t in enumerate(tokens):
            h = known.get(t)
            if h is None:
                h = known[t] = int.from_bytes(blake2b(t.encode(), digest_size=8).digest(), "little")
            out[i] = h
        return out


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """SimHash of every run of WINDOW words; an odd number of votes leaves no tie in any bit."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    votes = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1), axis=0, out=votes[1:])
    return np.packbits(votes[WINDOW:] - votes[:-WINDOW] > WINDOW // 2, axis=1).view(np.uint64).ravel()


def similarity(same: np.ndarray) -> np.ndarray:
    """Weighted share of equal shingles of aligned windows; ``same`` tells equal words (candidates, WINDOW)."""
    pairs = same[:, 1:] & same[:, :-1]
    return (WORD_WEIGHT * same.sum(1) + PAIR_WEIGHT * pairs.sum(1)) / WHOLE


def _near_masks() -> np.ndarray:
    """All block values of up to NEAR set bits."""
    width = 64 // BLOCKS
    some = [0]
    for k in range(1, NEAR + 1):
        some += [sum(1 << b for b in bits) for bits in itertools.combinations(range(width), k)]
    return np.array(some, np.int64)


class Items:
    """The multi-index over the fingerprints of all windows of some items."""

    def __init__(self, rows: list[tuple[int, np.ndarray]]):
        rows = [(i, h) for i, h in rows if len(h) >= WINDOW]
        self.words = np.concatenate([h for _, h in rows]) if rows else np.zeros(0, np.uint64)
        starts = np.cumsum([0] + [len(h) for _, h in rows])
        self.at = np.concatenate([np.arange(s, s + len(h) - WINDOW + 1) for s, (_, h) in zip(starts, rows)]) if rows else np.zeros(0, np.int64)
        self.ids = np.concatenate([np.full(len(h) - WINDOW + 1, i, np.int64) for i, h in rows]) if rows else np.zeros(0, np.int64)
        self.prints = np.concatenate([fingerprints(h) for _, h in rows]) if rows else np.zeros(0, np.uint64)
        self.width = 64 // BLOCKS
        self.masks = _near_masks()
        self.index = []
        for b in range(BLOCKS):
            values = self.block(self.prints, b)
            self.index.append((np.argsort(values, kind="stable"), np.searchsorted(np.sort(values), np.arange((1 << self.width) + 1))))

    def block(self, prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(b * self.width) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(i, j): all pairs of a fingerprint and an item window within the radius, each once."""
        out = []
        for first in range(0, len(prints), 512):
            part = prints[first : first + 512]
            found = []
            for b, (order, start) in enumerate(self.index):
                probes = (self.block(part, b)[:, None] ^ self.masks[None, :]).ravel()
                low, n = start[probes], start[probes + 1] - start[probes]
                hit = np.flatnonzero(n)
                n = n[hit]
                i = np.repeat(hit // len(self.masks), n)
                j = order[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[hit], n)]
                near = np.bitwise_count(part[i] ^ self.prints[j]) <= RADIUS
                found.append(i[near] * len(self.prints) + j[near])
            pairs = np.unique(np.concatenate(found))
            out.append((pairs // max(1, len(self.prints)) + first, pairs % max(1, len(self.prints))))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def leaks(self, hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of a window, item) of every leak in stretches laid end to end in ``hashes`` from ``starts``."""
        if not len(self.prints) or len(hashes) < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = len(hashes) - WINDOW + 1
        # windows that reach over the end of a stretch are none
        whole = np.ones(n, bool)
        for s in starts[starts > 0]:
            whole[max(0, s - WINDOW + 1) : s] = False
        at = np.flatnonzero(whole)
        i, j = self.within(fingerprints(hashes)[at])
        steps = np.arange(WINDOW)
        keep = []
        for first in range(0, len(i), 100_000):
            a, b = at[i[first : first + 100_000]], self.at[j[first : first + 100_000]]
            keep.append(similarity(hashes[a[:, None] + steps] == self.words[b[:, None] + steps]) >= SIMILARITY - 1e-9)
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        return at[i[keep]], self.ids[j[keep]]


def _hashed(items: DataFrame, item_key: str, text: str) -> DataFrame:
    """``(i, h)``: the word hashes of every item, in pieces that overlap by less than a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for batch in batches:
            ids, pieces = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = vocabulary.hashes(words(t.as_py())).view(np.int64)
                for at in range(0, max(1, len(h) - WINDOW + 1), PIECE_WORDS):
                    piece = h[at : at + PIECE_WORDS + WINDOW - 1]
                    if len(piece) >= WINDOW:
                        ids.append(i)
                        pieces.append(piece)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pieces, pa.list_(pa.int64()))], names=["i", "h"])

    return items.select(F.col(item_key).cast("long").alias("i"), F.col(text).cast("string").alias("t")).filter("t IS NOT NULL AND i IS NOT NULL").mapInArrow(run, "i long, h array<long>")


def leaked_items(documents: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", item_words: int = ITEM_WORDS) -> DataFrame:
    """``(doc_id, item_id)`` for every document that repeats a passage of an item.

    Whole texts of all documents are read once, in one map that keeps the stretches whose words stand in
    items.  Items are searched for in parts of at most about ``item_words`` words, which are sent to the
    tasks; with several parts the stretches are written first, so that the corpus is not read again.
    Null and empty texts, and items of fewer than 15 words, give nothing; every pair of ids comes out
    once; an empty table on either side gives an empty result.
    """
    spark = documents.sparkSession
    pieces = cut(_hashed(items, item_key, text).dropDuplicates())
    # at most TABLE numbers
    places = pieces.select(F.explode("h").alias("w")).select(F.pmod("w", F.lit(TABLE)).cast("int").alias("w")).distinct().toPandas()["w"].to_numpy()
    table = np.zeros(TABLE, bool)
    table[places] = True
    stretches = _stretches(documents.select(F.col(doc_key).cast("long").alias("d"), F.col(text).cast("string").alias("t")).filter("t IS NOT NULL"), spark.sparkContext.broadcast(table))
    parts = max(1, -(-(pieces.agg(F.sum(F.size("h"))).first()[0] or 0) // item_words))
    if parts > 1:
        stretches = cut(stretches)
    out = None
    for k in range(parts):
        mine = pieces.filter(F.pmod(F.xxhash64("i", "h"), F.lit(parts)) == k).collect()
        block = spark.sparkContext.broadcast([(r["i"], np.array(r["h"], np.int64).view(np.uint64)) for r in mine])
        found = stretches.mapInArrow(_search(block), f"{doc_key} long, {item_key} long")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def _stretches(source: DataFrame, table) -> DataFrame:
    """``(d, h)``: the stretches of documents whose windows of 15 words have at most one word that stands in no item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = Vocabulary(), table.value
        for batch in batches:
            ids, kept = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = vocabulary.hashes(words(text.as_py()))
                if len(h) < WINDOW:
                    continue
                total = np.concatenate(([0], np.cumsum(known[(h.view(np.int64) % TABLE)])))
                good = np.flatnonzero(total[WINDOW:] - total[:-WINDOW] >= WINDOW - ALTERED)
                if len(good):
                    # runs of neighbouring windows, in pieces that overlap by less than a window
                    for run_ in np.split(good, np.flatnonzero(np.diff(good) > 1) + 1):
                        for at in range(int(run_[0]), int(run_[-1]) + 1, PIECE_WORDS):
                            ids.append(key)
                            kept.append(h[at : min(at + PIECE_WORDS, int(run_[-1]) + 1) + WINDOW - 1].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kept, pa.list_(pa.int64()))], names=["d", "h"])

    return source.mapInArrow(run, "d long, h array<long>")


def _search(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(block.value)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            first = 0
            while first < len(keys):
                # a bounded number of words at once
                ends = lists.offsets.to_numpy()
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK_WORDS, "right")) - 1)
                hashes = lists.values.to_numpy(zero_copy_only=False)[ends[first] : ends[last]].view(np.uint64)
                starts = ends[first:last] - ends[first]
                at, item = index.leaks(hashes, starts)
                owner = keys[first + np.searchsorted(starts, at, "right") - 1]
                pairs = np.unique(np.column_stack([owner, item]), axis=0) if len(at) else np.zeros((0, 2), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["d", "i"])
                first = last

    return run
