"""Several values packed in one text: a quote-aware finite-state tokenizer.

States of the automaton: before a value, inside a bare value, inside a quoted value, after an
escape inside a quoted value, after a closing quote; beside them a counter of open brackets.
Delimiters count only outside quotes and outside brackets that opened inside a value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELIMITERS = frozenset(";,|\t\n\r")
QUOTES = frozenset("\"'")
OPENERS = {"[": "]", "(": ")", "{": "}"}
CLOSERS = frozenset("])}")
BEFORE, BARE, QUOTED, ESCAPED, AFTER = range(5)
#: Distinct texts whose result one task keeps at hand; the store is emptied when full.
MEMO = 50_000


def split_packed(text: str | None) -> list[str]:
    """The values of ``text`` in order.

    * delimiters: ``; , |``, tab, line ends, and ``/`` when blanks stand on both sides;
    * a quote opens only at the start of a value; inside it ``\\`` escapes the next character and a
      doubled quote means one; a quote that is never closed is an ordinary character;
    * a bracket before the first value wraps the list and is dropped; a bracket that opens inside a
      value protects the delimiters up to its partner and stays; brackets that do not pair up are
      ordinary characters;
    * blanks around a value are dropped, empty positions give no value, repeats stay;
    * null and blank texts give the empty list.
    """
    if not text or text.isspace():
        return []
    for quotes, brackets in ((True, True), (True, False), (False, True), (False, False)):
        found = _scan(text, quotes, brackets)
        if found is not None:
            return found
    return []


def _scan(text: str, quotes: bool, brackets: bool) -> list[str] | None:
    """One pass of the automaton; None when a quote or a bracket stays open."""
    values: list[str] = []
    value: list[str] = []
    state, quote = BEFORE, ""
    wrappers: list[str] = []
    inner: list[str] = []
    n = len(text)

    def finish() -> None:
        whole = "".join(value).strip()
        if whole:
            values.append(whole)
        value.clear()

    i = 0
    while i < n:
        c = text[i]
        if state == QUOTED:
            if c == "\\" and i + 1 < n:
                state = ESCAPED
            elif c == quote:
                if i + 1 < n and text[i + 1] == quote:
                    value.append(c)
                    i += 1
                else:
                    state = AFTER
            else:
                value.append(c)
        elif state == ESCAPED:
            value.append(c)
            state = QUOTED
        else:
            splits = not inner and (c in DELIMITERS or (c == "/" and text[i - 1 : i].isspace() and text[i + 1 : i + 2].isspace()))
            if splits:
                finish()
                state = BEFORE
            elif c.isspace() and state in (BEFORE, AFTER):
                pass
            elif quotes and state == BEFORE and c in QUOTES:
                state, quote = QUOTED, c
            elif brackets and state == BEFORE and c in OPENERS and not inner:
                wrappers.append(OPENERS[c])
            elif brackets and c in OPENERS and state == BARE:
                inner.append(OPENERS[c])
                value.append(c)
            elif brackets and c in CLOSERS:
                if inner and inner[-1] == c:
                    inner.pop()
                    value.append(c)
                elif not inner and wrappers and wrappers[-1] == c:
                    wrappers.pop()
                    finish()
                    state = BEFORE
                else:
                    return None
            else:
                value.append(c)
                state = BARE
        i += 1
    if state in (QUOTED, ESCAPED) or inner or wrappers:
        return None
    finish()
    return values


def unpack_fields(df: DataFrame, key: str, fields: list[str], min_values: int = 1) -> DataFrame:
    """One row per packed value: ``(key, field_name, item_no, item_value)``, item_no from 1.

    Fields that hold fewer than ``min_values`` values give no rows.  Null keys are kept.  The table
    is read once; tokenizing is a map over Arrow batches, without any shuffle.  An empty table gives
    an empty result; other columns, also columns named like an output column, are ignored.
    """
    kind = df.schema[key].dataType
    source = df.select(F.col(key).alias("k"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list[str]] = {}
        for batch in batches:
            keys = batch.column(0)
            for f, field in enumerate(names):
                at: list[int] = []
                numbers: list[int] = []
                values: list[str] = []
                for row, text in enumerate(batch.column(1 + f).to_pylist()):
                    if text is None:
                        continue
                    found = memo.get(text)
                    if found is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        found = memo[text] = split_packed(text)
                    if len(found) >= min_values and found:
                        at.extend([row] * len(found))
                        numbers.extend(range(1, len(found) + 1))
                        values.extend(found)
                if at:
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(at, pa.int32())), pa.array(np.full(len(at), f, np.int8)), pa.array(numbers, pa.int32()), pa.array(values, pa.string())],
                        names=["k", "f", "item_no", "item_value"],
                    )

    raw = source.mapInArrow(run, f"k {kind.simpleString()}, f tinyint, item_no int, item_value string")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("f").cast("int") + 1)
    return raw.select(F.col("k").alias(key), name.alias("field_name"), "item_no", "item_value")
