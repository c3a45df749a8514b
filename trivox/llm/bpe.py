"""Byte-level BPE over a corpus by a global shuffle of distinct words (operator 7).

1. Tasks split texts into pre-tokens and take chunks of documents together. A chunk has each distinct word once and, for
   every position, the number of its word: the exploded pre-tokens, in columns. Chunks are dealt out by their number.
2. From there the words of all chunks meet by a hash of the word, in parts whose number follows the size of the corpus;
   each distinct one is encoded once by the merge ranks. A task holds the distinct words of one part at a time.
3. The ids go back to the chunk, whose tasks join them to the positions in order and so put the documents together.

Words and positions travel as compressed columns of a chunk, so a shuffle moves less than the texts; positions move once.
The token-byte table for decoding is as large as the vocabulary, not the corpus, and is read by each worker.

A chunk's number is that of its task and its place in it, so a task that is run again must read the same rows in the same
order, as it does from files and checkpoints: a result of a shuffle should be written first.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters of the documents in a chunk, unless one document has more.
CHUNK = 12_000_000
#: Bytes of text for each part into which a hash deals out words, and the fewest and most parts.
PART_TEXT = 64 << 20
PARTS = (64, 65_536)
_SLICE = 1 << 18
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)


@functools.cache
def _classes() -> np.ndarray:
    import regex

    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, _OTHER, np.uint8)
    # White_Space as the pattern's \s has it
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\p{White_Space}")):
        table[[ord(c) for c in regex.findall(pattern, text)]] = kind
    return table


def cuts(text: str) -> np.ndarray:
    """Where the pre-tokens of ``text`` start: the matches of ``public_tokenizers.PATTERN``, by runs of equal classes."""
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[cp]
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    # the last blank before a word is apart from those before it; a space goes with the word
    b = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE)) + 1
    start[b - 1] = True
    start[b[cp[b - 1] == 32]] = False
    # contractions: an apostrophe that starts a pre-token, with letters after it
    p = np.flatnonzero((cp[:-1] == 39) & start[:-1] & (kind[1:] == _LETTER))
    if len(p):
        one, two = cp[p + 1], cp[np.minimum(p + 2, n - 1)]
        two = np.where(p + 2 < n, two, 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for hit, size in ((p[short], 2), (p[long & ~short], 3)):
            start[hit + 1] = False
            end = hit + size
            start[end[end < n]] = True
    return np.flatnonzero(start)


def pretokens(text: str, at: np.ndarray | None = None) -> Iterator[str]:
    at = cuts(text) if at is None else at
    for i in range(0, len(at), _SLICE):
        part = at[i : i + _SLICE + 1].tolist()
        if i + _SLICE >= len(at):
            part.append(len(text))
        yield from (text[a:b] for a, b in zip(part, part[1:], strict=False))


class Vocabulary:
    """A rank file: encodes single pre-tokens, and has the bytes of each token for decoding."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        self._encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(x) for x in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, word: bytes) -> list[int]:
        return self._encoding._encode_single_piece(word)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.bytes, self.starts, self.lengths, ids).tobytes()


@functools.cache
def vocabulary(path: str = RANKS) -> Vocabulary:
    return Vocabulary(path)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i] : starts[i] + lengths[i]]`` for i in ``which``, one after another."""
    n = lengths[which]
    ends = np.cumsum(n)
    return values[np.repeat(starts[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays behind each other, each compressed; numbers as one column for each of their bytes."""
    zip_, out = zstandard.ZstdCompressor(level=3), []
    for a in arrays:
        raw = a if isinstance(a, bytes) else np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
        squeezed = zip_.compress(raw)
        out += [len(squeezed).to_bytes(8, "little"), squeezed]
    return b"".join(out)


def _unpack(data: bytes, *kinds: type | None) -> list:
    unzip, at, out = zstandard.ZstdDecompressor(), 0, []
    for kind in kinds:
        size = int.from_bytes(data[at : at + 8], "little")
        raw = unzip.decompress(data[at + 8 : at + 8 + size])
        at += 8 + size
        if kind is None:
            out.append(raw)
        else:
            wide = np.dtype(kind).itemsize
            out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(wide, -1).T).view(kind).ravel())
    return out


def _chunk(keys: list, texts: list[str], parts: int = PARTS[0]) -> Iterator[tuple[int, bytes, list | None, list | None]]:
    """``(part, data, keys, counts)``: the positions (part -1) and the words of each part."""
    number: dict[str, int] = {}
    counts, places = [], []
    for text in texts:
        at = cuts(text)
        counts.append(len(at))
        places.append(np.fromiter((number.setdefault(w, len(number)) for w in pretokens(text, at)), np.uint32, len(at)))
    place = np.concatenate(places) if places else np.zeros(0, np.uint32)
    order = np.argsort(-np.bincount(place, minlength=len(number)), kind="stable")  # frequent words have small numbers
    rank = np.empty(len(number), np.uint32)
    rank[order] = np.arange(len(number), dtype=np.uint32)
    all_words = [w.encode() for w in number]
    words = [all_words[i] for i in order.tolist()]
    part = np.fromiter((crc32(w) % parts for w in words), np.uint16, len(words))
    yield -1, _pack(rank[place] if len(place) else place, part), keys, counts
    for p in np.unique(part).tolist():
        own = [words[i] for i in np.flatnonzero(part == p).tolist()]
        yield p, _pack(np.array([len(w) for w in own], np.uint32), b"".join(own)), None, None


def _joined(docs: DataFrame, key: str, text: str, path: str, join: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """What ``join`` makes of each chunk's positions ``(part -1, data, keys, counts)`` and encoded words ``(part, data)``."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_parts = max(PARTS[0], min(PARTS[1], -(-size // PART_TEXT)))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, keys, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def made() -> pa.RecordBatch:
            parts, data, of_keys, of_counts = zip(*_chunk(keys, texts, n_parts), strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(parts), pa.int64()), pa.array(parts, pa.int32()), pa.array(data, pa.binary()), pa.array(of_keys, pa.list_(key_type)), pa.array(of_counts, pa.list_(pa.int32()))],
                ["chunk", "part", "data", "keys", "counts"],
            )

        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if texts and held + len(t or "") > CHUNK:
                    yield made()
                    chunk, keys, texts, held = chunk + 1, [], [], 0
                keys.append(k)
                texts.append(t or "")
                held += len(t or "")
        if texts:
            yield made()

    def only_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # in Python, as a filter would go below the shuffle and each side would make its own
            some = pa.array([p >= 0 for p in batch.column(1).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:3], ["chunk", "part", "data"]).filter(some)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[int]] = {}
        coder, at_part = vocabulary(path), None
        for batch in batches:
            made = []
            for p, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if p != at_part:  # rows come by part
                    known, at_part = {}, p
                sizes, raw = _unpack(data, np.uint32, None)
                ids, lengths, at = [], np.empty(len(sizes), np.uint32), 0
                for i, n in enumerate(sizes.tolist()):
                    word = raw[at : at + n]
                    at += n
                    if (own := known.get(word)) is None:
                        own = known[word] = coder.encode(word)
                    lengths[i] = len(own)
                    ids += own
                made.append(_pack(lengths, np.array(ids, np.uint32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], ["chunk", "part", "data"])

    columns = "chunk long, part int, data binary"
    # both sides below read this one shuffle
    chunks = rows.mapInArrow(explode, f"{columns}, keys array<{kind}>, counts array<int>").repartition("chunk")
    words = chunks.mapInArrow(only_words, columns).repartitionByRange(int(n_parts), "part").sortWithinPartitions("part").mapInArrow(encode, columns)
    return chunks.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(join, schema)


def _assembled(chunk: pa.Table, words: pa.Table) -> Iterator[tuple[object, np.ndarray]]:
    """Each key of a chunk with the ids of its text."""
    first = chunk.column("part").to_pylist().index(-1)
    place, part = _unpack(chunk.column("data")[first].as_py(), np.uint32, np.uint16)
    rows = {p: i for i, p in enumerate(words.column("part").to_pylist())}
    lengths, starts, flat, at = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), [], 0
    for p, i in rows.items():
        n, ids = _unpack(words.column("data")[i].as_py(), np.uint32, np.uint32)
        own = np.flatnonzero(part == p)
        lengths[own] = n
        starts[own] = at + np.cumsum(n, dtype=np.int64) - n
        flat.append(ids)
        at += len(ids)
    ids, at = np.concatenate(flat) if flat else np.zeros(0, np.uint32), 0
    for key, n in zip(chunk.column("keys")[first].as_py(), chunk.column("counts")[first].as_py(), strict=True):
        yield key, gather(ids, starts, lengths, place[at : at + n])
        at += n


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANKS) -> DataFrame:
    """``(key, ids)`` for each row: the ids of the text as the tiktoken library gives them, without special tokens.

    Null texts are empty and have no ids. Rows that repeat are encoded as often. An empty table gives no rows; other columns
    are left out, whatever their names.
    """
    kind = docs.schema[key].dataType.simpleString()

    def join(chunk: pa.Table, words: pa.Table) -> pa.Table:
        keys, ids = zip(*_assembled(chunk, words), strict=True)
        return pa.table({"k": pa.array(keys, chunk.schema.field("keys").type.value_type), "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))})

    return _joined(docs, key, text, path, join, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode(encoded: DataFrame, key: str = "doc_id", path: str = RANKS) -> DataFrame:
    """``(key, bytes)``: ids joined with the token-byte table. Null ids give null; other columns are left out, whatever their
    names."""
    kind = encoded.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if x is None else vocabulary(path).decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["k", "bytes"])

    return encoded.select(F.col(key).alias("k"), "ids").mapInArrow(work, f"k {kind}, bytes binary").withColumnRenamed("k", key)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANKS) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)``: encodes and decodes in one pass, and keeps only digests.

    Null texts are empty. Rows that repeat have a row each, null keys too; an empty table gives no rows."""
    kind = docs.schema[key].dataType.simpleString()

    def join(chunk: pa.Table, words: pa.Table) -> pa.Table:
        out: dict[str, list] = {"k": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for k, ids in _assembled(chunk, words):
            for column, value in zip(out.values(), (k, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(vocabulary(path).decode(ids)).hexdigest()), strict=True):
                column.append(value)
        return pa.table({"k": pa.array(out.pop("k"), chunk.schema.field("keys").type.value_type), "n_tokens": pa.array(out.pop("n_tokens"), pa.int64()), **out})

    made = _joined(docs, key, text, path, join, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return made.withColumnRenamed("k", key)


def tokenized(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANKS) -> DataFrame:
    """``(key, n_tokens, ids, decoded_sha256)`` for each row: the ids of its text, and the digest of what they decode to."""
    kind = docs.schema[key].dataType.simpleString()

    def join(chunk: pa.Table, words: pa.Table) -> pa.Table:
        keys, ids = zip(*_assembled(chunk, words), strict=True)
        back = [hashlib.sha256(vocabulary(path).decode(x)).hexdigest() for x in ids]
        return pa.table({"k": pa.array(keys, chunk.schema.field("keys").type.value_type), "n_tokens": pa.array([len(x) for x in ids], pa.int64()), "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), "decoded_sha256": back})

    made = _joined(docs, key, text, path, join, f"k {kind}, n_tokens long, ids array<int>, decoded_sha256 string")
    return made.withColumnRenamed("k", key)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
