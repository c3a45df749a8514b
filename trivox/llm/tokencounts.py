"""Token counts of sections by offsets (operator 2).

A document is encoded once and whole. Its tokens' character spans are joined with the spans of its sections, and a token
that crosses a boundary is given to one section by a rule that is named, so the counts of sections that cover a text
add up to the count of the text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.llm.bpe import RANKS, pretokens, vocabulary
from trivox.llm.common import table

#: ``start``: the section of a token's first character. ``most``: the section with most of its characters, of equal
#: ones the first.
RULES = ("start", "most")
#: Pre-tokens whose token lengths a worker remembers.
_REMEMBERED = 1 << 18


def token_spans(text: str, path: str = RANKS) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of each token of ``text``. Tokens that share a character both have it in their span."""
    sizes = np.fromiter(chain.from_iterable(map(_lengths(path), pretokens(text))), np.int64)
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(sizes)
    return char[ends - sizes], char[ends - 1] + 1


@functools.cache
def _lengths(path: str):
    coder = vocabulary(path)
    lengths = coder.lengths.tolist()
    return functools.lru_cache(_REMEMBERED)(lambda word: tuple([lengths[i] for i in coder.encode(word.encode())]))


def allot(starts: np.ndarray, ends: np.ndarray, section_starts: np.ndarray, section_ends: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Each token's section (-1: none) and whether it crosses a boundary. Sections are in order and do not overlap; none is
    empty."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if not len(section_starts):
        return np.full(len(starts), -1), np.zeros(len(starts), bool)
    at = np.searchsorted(section_starts, starts, side="right") - 1
    inside = (at >= 0) & (starts < section_ends[at])
    crossing = np.where(inside, ends > section_ends[at], (at + 1 < len(section_starts)) & (ends > section_starts[np.minimum(at + 1, len(section_starts) - 1)]))
    found = np.where(inside, at, -1)
    if rule == "most":
        for t in np.flatnonzero(crossing).tolist():
            first = max(int(at[t]), 0)
            last = int(np.searchsorted(section_starts, ends[t], side="left"))
            shared = np.minimum(section_ends[first:last], ends[t]) - np.maximum(section_starts[first:last], starts[t])
            found[t] = first + int(shared.argmax()) if len(shared) and shared.max() > 0 else -1
    return found, crossing


def _lines(text: str) -> list[tuple[str, int, int]]:
    """A section for each line, its end of line included; an empty text has none."""
    out, at = [], 0
    for i, line in enumerate(text.split("\n")):
        end = min(at + len(line) + 1, len(text))
        if end > at:
            out.append((str(i), at, end))
        at = end
    return out


def _count(docs: DataFrame, key: str, columns: list[str], sections, whole, rule: str, path: str) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    names = [f"c{i}" for i in range(len(columns))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = whole(values)
                spans = sections(values)
                starts, ends = token_spans(text, path)
                found, crossing = allot(starts, ends, np.array([s for _, s, _ in spans], np.int64), np.array([e for *_, e in spans], np.int64), rule)
                n = np.bincount(found + 1, minlength=len(spans) + 1).tolist()
                crossed = np.bincount(found[crossing] + 1, minlength=len(spans) + 1).tolist()
                out += [(k, name, s, e, n[i + 1], crossed[i + 1]) for i, (name, s, e) in enumerate(spans)]
                if n[0] or not spans:
                    out.append((k, None, None, None, n[0], crossed[0]))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.string()), *(pa.array(c, pa.int64()) for c in cols[2:])], ["k", "section", "first", "end", "n_tokens", "n_crossing"])

    rows = docs.select(F.col(key).alias("k"), *[F.col(c).cast("string").alias(n) for c, n in zip(columns, names, strict=True)])
    return rows.mapInArrow(work, f"k {kind}, section string, first long, end long, n_tokens long, n_crossing long").withColumnRenamed("k", key)


def tokens_by_line(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: str = "start", path: str = RANKS) -> DataFrame:
    """``(key, section, first, end, n_tokens, n_crossing)``, a row for each line of each text.

    ``section`` is the line's number from 0, ``first`` and ``end`` its characters, the end of line with it; a last line
    without characters is none. ``n_crossing`` counts the section's tokens that reach beyond it. An empty or null text
    has one row: section null, no tokens. Rows that repeat are counted as often.
    """
    return _count(docs, key, [text], lambda v: _lines(v[0] or ""), lambda v: v[0] or "", rule, path)


def tokens_by_field(docs: DataFrame, fields: list[str], key: str = "doc_id", separator: str = "\n", rule: str = "start", path: str = RANKS) -> DataFrame:
    """As ``tokens_by_line`` for columns that are one document when joined by ``separator``: a row for each field.

    Null and empty fields have no row and no separator. Tokens that no field has, those of separators, are in a row with
    section null; with rule ``start`` a token that starts in a separator is one of them.
    """

    def sections(values: list[str | None]) -> list[tuple[str, int, int]]:
        out, at = [], 0
        for name, value in zip(fields, values, strict=True):
            if value:
                out.append((name, at, at + len(value)))
                at += len(value) + len(separator)
        return out

    return _count(docs, key, fields, sections, lambda v: separator.join(x for x in v if x), rule, path)


def op2_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_by_line(table(spark, sf_dir, "documents"))
