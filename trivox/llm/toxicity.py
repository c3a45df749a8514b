"""Toxicity by non-negative positive-unlabelled learning (operator 4).

Confirmed toxic texts are the positives, texts of the corpus whatever they are the unlabelled. With the share of toxic
texts as class prior p, the risk of a classifier g is p R+(g) + max(0, Ru-(g) - p R-(g)): the risk of calling
unlabelled texts toxic less what toxic ones among them add to it, which is kept from falling below zero. A logistic
linear model over distinct words, word beginnings and beginnings that several words share is fitted to it with numpy.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.llm.common import cut, remainder, table

FOLDS, HELD = 4, 2
THRESHOLD = 0.3
#: Texts that the classifier is fitted on at most, by the order of a hash of the key.
POSITIVES, UNLABELLED = 5_000, 12_000
#: Lengths of the word beginnings that are features beside whole words.
STEMS = (4, 5)
#: Distinct words with one beginning, from which on their number is a feature too.
REPEATS = (2, 3)
#: A feature must be in so many positives, and be so many standard deviations from its share in unlabelled texts.
LEAST, DEVIATIONS = 3, 4.0
STEPS, RATE, DECAY = 300, 0.05, 1e-3
_ODD = np.uint32(0x9E3779B1)
_WORD = re.compile(r"[^\W\d_]+")


def _of_word(word: str) -> tuple[int, ...]:
    return (crc32(word.encode()), *(crc32(f"^{word[:n]}".encode()) for n in STEMS if len(word) > n))


_remembered = functools.lru_cache(1 << 18)(_of_word)


def features(text: str | None) -> np.ndarray:
    """Hashes of the distinct words, lowered, of a whole text, of their beginnings, and of beginnings that several of
    the words have; sorted."""
    made: list[int] = []
    for word in set(_WORD.findall((text or "").lower())):
        made += _remembered(word)
    codes, n = np.unique(np.array(made, np.uint32), return_counts=True)
    more = [codes[n >= k] * _ODD + np.uint32(k) for k in REPEATS]
    return np.unique(np.concatenate((codes, *more)))


def finder(names: np.ndarray) -> Callable[[str | None], list[int]]:
    """Which of ``names`` a text has, as places in it: what ``features`` would say, but looking at those words only that
    some name could come from."""
    rules: dict[int, list[tuple[int, int]]] = {}
    back = pow(int(_ODD), -1, 1 << 32)
    for i, code in enumerate(names.tolist()):
        rules.setdefault(code, []).append((1, i))
        for k in REPEATS:
            rules.setdefault((code - k) * back % (1 << 32), []).append((k, i))

    @functools.lru_cache(1 << 18)
    def known(word: str) -> tuple[int, ...]:
        return tuple(c for c in _of_word(word) if c in rules)

    def find(text: str | None) -> list[int]:
        count: dict[int, int] = {}
        for word in set(_WORD.findall((text or "").lower())):
            for code in known(word):
                count[code] = count.get(code, 0) + 1
        return sorted({i for code, n in count.items() for k, i in rules[code] if n >= k})

    return find


@dataclass
class Model:
    names: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self) -> Callable[[str | None], float]:
        find = finder(self.names)

        def score(text: str | None) -> float:
            hit = find(text)
            z = self.bias + float(self.weights[hit].sum()) if hit else self.bias
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score

    def score(self, text: str | None) -> float:
        return self.scorer()(text)


def candidates(positive: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Features that ``LEAST`` positives have, and how many have each."""
    names, count = np.unique(np.concatenate([np.zeros(0, np.uint32), *positive]), return_counts=True)
    return names[count >= LEAST], count[count >= LEAST]


def shares(docs: DataFrame, names: np.ndarray, text: str = "text") -> tuple[np.ndarray, int]:
    """How many rows have each of ``names``, and how many rows there are: whole texts, added up in the executors. The
    driver gets a number for each name."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, count = finder(names), np.zeros(len(names) + 1, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                count[find(t)] += 1
                count[-1] += 1
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(count[at], pa.int64())], ["i", "n"])

    found = np.zeros(len(names) + 1, np.int64)
    for r in docs.select(F.col(text).alias("t")).mapInArrow(work, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        found[r["i"]] = r["n"]
    return found[:-1], int(found[-1])


def telling(count: np.ndarray, positives: int, seen: tuple[np.ndarray, int]) -> np.ndarray:
    """Which candidates are ``DEVIATIONS`` from their share in the corpus, ``count`` of ``positives`` having each."""
    p, u = count / positives, (seen[0] + 0.5) / (seen[1] + 1)
    return np.abs(p - u) >= DEVIATIONS * np.sqrt(u * (1 - u) / positives)


def descent(w: np.ndarray, b: float, p: tuple[np.ndarray, np.ndarray, int], u: tuple[np.ndarray, np.ndarray, int], prior: float) -> tuple[np.ndarray, float]:
    """The gradient by weights and bias of the risk on sparse rows ``(row, column, number of rows)``, positive and
    unlabelled ones. Where the risk of calling unlabelled texts clean is below zero, its step is undone instead."""
    (pr, pc, n_p), (ur, uc, n_u) = p, u
    gp, gu = b + np.bincount(pr, w[pc], n_p), b + np.bincount(ur, w[uc], n_u)
    sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    # derivatives of the two parts by the scores
    sign = 1.0 if negative >= 0 else -1.0
    dp = ((sp - 1) * prior * (negative >= 0) - sign * prior * sp) / n_p
    du = sign * su / n_u
    return np.bincount(pc, dp[pr], len(w)) + np.bincount(uc, du[ur], len(w)), dp.sum() + du.sum()


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seen: tuple[np.ndarray, int] | None = None) -> Model:
    """Fit by the non-negative risk. Without positives or unlabelled texts every score is the prior.

    ``seen`` is what ``shares`` says of the ``candidates`` over the corpus; without it the unlabelled texts are counted.
    """
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    base = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(np.zeros(0, np.uint32), np.zeros(0), base)
    names, count = candidates(positive)
    if seen is None:
        every = np.concatenate([names, *[np.intersect1d(names, x, assume_unique=True) for x in unlabelled]])
        seen = np.unique(every, return_counts=True)[1] - 1, len(unlabelled)
    names = names[telling(count, len(positive), seen)]

    def rows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, col = [], []
        for i, x in enumerate(texts):
            at = np.flatnonzero(np.isin(names, x, assume_unique=True))
            row.append(np.full(len(at), i))
            col.append(at)
        return np.concatenate(row), np.concatenate(col)

    (pr, pc), (ur, uc) = rows(positive), rows(unlabelled)
    w, b = np.zeros(len(names)), base
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    n_p, n_u = len(positive), len(unlabelled)
    for step in range(1, STEPS + 1):
        by_weight, by_bias = descent(w, b, (pr, pc, n_p), (ur, uc, n_u), prior)
        grad = np.append(by_weight + DECAY * w, by_bias)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return Model(names, w, b)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """Fit on rows outside the held-out fold: up to ``POSITIVES`` that a label calls toxic, ``UNLABELLED`` of all.

    The class prior is the share of toxic rows among labelled ones; half a row is added to either side. Which features of
    the positives are chosen follows from their shares in all rows outside the fold, each counted as often as it comes; the
    sample of unlabelled texts is for the steps of the fit alone. Features are counted and chosen in the executors; the
    driver gets those that ``LEAST`` positives have, with their counts, and of the bounded sample, one text for each key,
    which of the chosen ones each text has. Null keys and null labels are passed over, null texts are empty, and without positive or
    unlabelled rows every score is the prior.
    """
    kind = docs.schema[key].dataType.simpleString()
    open_ = lambda df: df.where(F.col(key).isNotNull() & (remainder(F.col(key), FOLDS) != HELD))
    known = open_(labels).where(F.col(toxic).isNotNull())
    n, k = known.agg(F.count("*"), F.coalesce(F.sum((F.col(toxic) == 1).cast("long")), F.lit(0))).first()
    first = lambda df, most: [r[0] for r in df.select(F.col(key).alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(most).collect()]
    positive, unlabelled = set(first(known.where(F.col(toxic) == 1), POSITIVES)), set(first(open_(docs), UNLABELLED))
    chosen = docs.sparkSession.createDataFrame([(x, x in positive, x in unlabelled) for x in sorted(positive | unlabelled)], f"c {kind}, p boolean, u boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t).view(np.int32) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(made, pa.list_(pa.int32()))], ["p", "u", "x"])

    # a key has one text, its smallest, so the sample is bounded whatever repeats
    found = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), F.col("k") == F.col("c")).groupBy("c", "p", "u").agg(F.min("t").alias("t")).select("t", "p", "u")
    made = cut(found.mapInArrow(work, "p boolean, u boolean, x array<int>"))
    counted = made.where("p").select(F.explode("x").alias("c")).groupBy("c").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST).collect()
    both = sorted((r["c"] & 0xFFFFFFFF, r["n"]) for r in counted)
    names, count = np.array([c for c, _ in both], np.uint32), np.array([n for _, n in both], np.int64)
    positives, seen = made.where("p").count(), (shares(open_(docs), names, text) if len(names) else (np.zeros(0, np.int64), 1))
    which = telling(count, positives, seen) if len(names) else np.zeros(0, bool)
    names, seen = names[which], (seen[0][which], seen[1])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(x := np.array(row, np.int32).view(np.uint32))[np.isin(x, names)].tobytes() for row in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.binary())], ["p", "u", "x"])

    # what is left of a text are the features that the model has
    rows = [(r["p"], r["u"], bytes(r["x"])) for r in made.mapInArrow(told, "p boolean, u boolean, x binary").collect()]
    rows.sort()
    as_array = lambda x: np.frombuffer(x, np.uint32)
    toxic_rows, others = [as_array(x) for p, _, x in rows if p], [as_array(x) for _, u, x in rows if u]
    return fit(toxic_rows, others, (k + 0.5) / (n + 1), seen if len(names) else None)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score)`` for each row; a null text is scored as an empty one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored = model.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scored(t) for t in batch.column(1).to_pylist()], pa.float64())], ["k", "score"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(work, f"k {docs.schema[key].dataType.simpleString()}, score double").withColumnRenamed("k", key)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return made.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
