"""Indel similarity over Arrow batches, for candidate pairs that blocking has found."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Pairs of texts whose similarity one task keeps at hand; the store is emptied when full.
MEMO = 50_000


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence by bit vectors over the letters of ``a``."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    every = (1 << len(a)) - 1
    free = every
    for c in b:
        taken = free & where.get(c, 0)
        free = (free + taken | free - taken) & every
    return len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def similarity(a: str | None, b: str | None) -> float:
    """The better ratio of two folded names as written and with sorted words; 0 when one is blank."""
    if not a or not b:
        return 0.0
    return max(ratio(a, b), ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))


def with_similarity(df: DataFrame, left: str, right: str, name: str = "score") -> DataFrame:
    """``df`` with the similarity of two folded columns as a last column; no shuffle.

    A task computes a pair of texts once, as long as it keeps no more than ``MEMO`` of them.
    """
    fields = df.schema.fields
    i, j = df.columns.index(left), df.columns.index(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[tuple[str | None, str | None], float] = {}
        for batch in batches:
            scores = []
            for pair in zip(batch.column(i).to_pylist(), batch.column(j).to_pylist()):
                if (score := memo.get(pair)) is None:
                    if len(memo) >= MEMO:
                        memo.clear()
                    score = memo[pair] = similarity(*pair)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*[f.name for f in fields], name])

    return df.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{name} double"]))
