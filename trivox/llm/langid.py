"""Language identification by rank-order n-gram profiles (operator 3).

A text's letters, lowered and with each run of other characters as one blank, give n-grams of one to three characters
that lie in a word or at its edge. A language's profile ranks its most frequent n-grams over all training texts; a text
goes to the profile from which the ranks of its own most frequent n-grams are least out of place.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trivox.llm.common import remainder, table

#: N-grams in a profile, of a language and of a text.
PROFILE = 400
FOLDS = 5
#: Closeness below which no text's language is taken as known, and all there is where too few labelled texts are.
REJECT = 0.05
#: A text's language is known from this share of a very low quantile of the labelled texts with about as many n-grams.
QUANTILE = 0.001
SHARE = 0.9
#: Labelled texts that a quantile takes at least; sizes with fewer are put together.
MIN_TEXTS = 500
UNKNOWN = "und"
_BLANK = 32
_SALTS = 16
_HELD = 2_000_000


@functools.cache
def _letters() -> np.ndarray:
    import regex

    table = np.zeros(0x110000, bool)
    table[[ord(c) for c in regex.findall(r"\p{L}", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))]] = True
    return table


def ngrams(text: str | None) -> np.ndarray:
    """Codes of the n-grams of a text as they occur; 21 bits a character. Empty for null or without a letter."""
    cp = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    if not letter.any():
        return np.zeros(0, np.uint64)
    cp = np.where(letter, cp, _BLANK).astype(np.uint64)
    cp = np.concatenate(([_BLANK], cp, [_BLANK])).astype(np.uint64)
    word = cp != _BLANK
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[0] = True
    cp, word = cp[keep], word[keep]
    two = (cp[:-1] << np.uint64(21)) | cp[1:]
    three = (two[:-1] << np.uint64(21)) | cp[2:]
    return np.concatenate((cp[word], two, three[word[1:-1]]))


def ranked(codes: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    grams, counts = np.unique(codes, return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Ranked n-grams by language. ``closest`` gives a language and how close it is, 0 to 1."""

    def __init__(self, by_lang: dict[str, list[int]]):
        self.langs = sorted(by_lang)
        self.grams, self.ranks = [], []
        for lang in self.langs:
            grams = np.array(by_lang[lang], np.uint64)
            order = np.argsort(grams)
            self.grams.append(grams[order])
            self.ranks.append(order)

    def closest(self, text: str | None) -> tuple[str, float]:
        return self.measured(text)[:2]

    def measured(self, text: str | None) -> tuple[str, float, int]:
        """``closest``, and the bit length of the number of the text's own ranked n-grams."""
        codes = ngrams(text)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0, 0
        own = ranked(codes)
        place, far = np.arange(len(own)), []
        for grams, ranks in zip(self.grams, self.ranks, strict=True):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            far.append(int(np.where(grams[at] == own, np.abs(ranks[at] - place), PROFILE).sum()))
        best = min(range(len(far)), key=far.__getitem__)
        return self.langs[best], min(1.0, max(0.0, 1 - far[best] / (PROFILE * len(own)))), len(own).bit_length()


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``docs`` with a language and a text, each as often as it comes; other columns may have any
    name. The driver gets ``size`` n-grams for each and salt at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        tally: dict[str, tuple] = {}

        def settle(name: str) -> None:
            codes, weights = (np.concatenate(x) for x in zip(*([tally[name]] if name in tally else []), *held.pop(name), strict=True))
            grams, place = np.unique(codes, return_inverse=True)
            tally[name] = grams, np.bincount(place, weights).astype(np.int64)

        def given(name: str) -> pa.RecordBatch:
            grams, counts = tally.pop(name)
            return pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams.view(np.int64)), pa.array(counts)], ["lang", "code", "n"])

        waiting: dict[str, int] = {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams, counts = np.unique(ngrams(t), return_counts=True)
                held.setdefault(name, []).append((grams, counts))
                waiting[name] = waiting.get(name, 0) + len(grams)
                if waiting[name] > _HELD:
                    settle(name)
                    waiting[name] = 0
                    if len(tally[name][0]) > _HELD:
                        yield given(name)
        for name in list(held):
            settle(name)
        for name in list(tally):
            yield given(name)

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("t"))
    sums = known.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang", "salt").orderBy(F.desc("n"), "code")
    first = sums.withColumn("salt", F.pmod(F.xxhash64("code"), F.lit(_SALTS))).withColumn("r", F.row_number().over(top)).where(F.col("r") <= size)
    found: dict[str, list] = {}
    for r in first.select("lang", "code", "n").collect():
        found.setdefault(r["lang"], []).append((-r["n"], r["code"]))
    return Profiles({name: [code for _, code in sorted(grams)[:size]] for name, grams in found.items()})


def predict(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score)`` for each row. Null texts, texts without a letter and all texts of a model that has
    learned nothing are ``und`` with score 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [profiles.closest(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in said], pa.string()), pa.array([y for _, y in said], pa.float64())], ["k", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    made = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(work, f"k {kind}, lang_pred string, score double")
    return made.withColumnRenamed("k", key)


def bounds(docs: DataFrame, profiles: Profiles, text: str = "text", lang: str = "lang", min_texts: int = MIN_TEXTS) -> list[float]:
    """The closeness from which a language is known, by the bit length of the number of a text's n-grams.

    It is ``SHARE`` of the ``QUANTILE`` of the closeness of all labelled texts of that size; from the smallest size on,
    sizes are put together until they have ``min_texts``, and the rest goes to the last ones. ``REJECT`` with fewer texts.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [x for x in map(profiles.measured, batch.column(0).to_pylist()) if x[0] != UNKNOWN]
            yield pa.RecordBatch.from_arrays([pa.array([n for *_, n in said], pa.int32()), pa.array([y for _, y, _ in said], pa.float64())], ["bits", "score"])

    # a bit length for each size of a profile at most
    last = PROFILE.bit_length()
    scored = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t")).mapInArrow(measure, "bits int, score double")
    tallied = scored.groupBy("bits", F.floor(F.col("score") * 1000).cast("int").alias("s")).agg(F.count("*").alias("n")).collect()
    groups: list[list[int]] = []
    have = {bits: sum(r["n"] for r in tallied if r["bits"] == bits) for bits in range(last + 1)}
    for bits in range(last + 1):
        if not groups or sum(have[x] for x in groups[-1]) >= min_texts:
            groups.append([])
        groups[-1].append(bits)
    if len(groups) > 1 and sum(have[x] for x in groups[-1]) < min_texts:
        groups[-2] += groups.pop()
    out = [REJECT] * (last + 1)
    for group in groups:
        scores = sorted((r["s"], r["n"]) for r in tallied if r["bits"] in group)
        before, low, n = 0, 0, sum(n for _, n in scores)
        for low, many in scores:
            before += many
            if before > QUANTILE * n:
                break
        if n >= min_texts:
            for bits in group:
                out[bits] = max(REJECT, SHARE * low / 1000)
    return out


def known_language(docs: DataFrame, profiles: Profiles, text: str = "text", least: list[float] | None = None) -> DataFrame:
    """The rows of ``docs`` whose language some profile knows: those with a letter and the closeness of ``bounds`` or
    more, ``REJECT`` without."""
    names = docs.columns
    least = least or [REJECT] * (PROFILE.bit_length() + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [profiles.measured(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([name != UNKNOWN and score >= least[bits] for name, score, bits in said], pa.bool_()))

    at = names.index(text)
    return docs.mapInArrow(work, docs.schema)


def train_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.where(remainder(F.col(key), FOLDS) != 0)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    made = predict(docs.select("doc_id", "text"), learn(train_rows(docs)))
    return made.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "lang_pred", "score")
