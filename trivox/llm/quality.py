"""Quality by importance resampling (operator 5).

Two generative models, over hashed word unigrams and bigrams, are counted: one from target texts, one from all raw
texts. A text's log weight is the sum of the log ratios of its n-grams. Adding Gumbel noise, which depends on the key
alone, and taking the largest k draws k texts without replacement in proportion to their weights.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from trivox.llm.common import cut, raw_texts, table

BUCKETS = 10_000
#: Target rows, by the order of a hash of the key, from which the target model is counted at most.
TARGET_ROWS = 50_000
#: The share of rows that are drawn.
SHARE = 0.85
SMOOTHING = 1.0
_BINS, _FEW = 1024, 10_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(1 << 18)
def _hash(word: bytes) -> int:
    return xxh64_intdigest(word)


def buckets(text: bytes | None, n: int = BUCKETS) -> np.ndarray:
    """Buckets of the unigrams and bigrams of a text's blank-separated words, A-Z lowered, as often as they occur."""
    words = (text or b"").lower().split()
    h = np.fromiter(map(_hash, words), np.uint64, len(words))
    pairs = (h[:-1] * _PRIME) ^ (h[1:] >> np.uint64(7)) ^ (h[1:] << np.uint64(31))
    return (np.concatenate((h, pairs)) % np.uint64(n)).astype(np.int64)


def log_ratios(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", n: int = BUCKETS, most: int = TARGET_ROWS) -> np.ndarray:
    """By bucket: log of its share in the target texts over its share in all texts of ``docs``, both smoothed.

    ``targets`` has the keys of target rows, of which ``most`` at most are used. The driver gets two counts a bucket. Other
    columns of either may have any name.
    """
    chosen = targets.select(F.col(key).alias("t")).where("t is not null").distinct().orderBy(F.xxhash64("t"), "t").limit(most)
    keys = docs.sparkSession.createDataFrame([(r["t"], True) for r in chosen.collect()], f"t {docs.schema[key].dataType.simpleString()}, target boolean")
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("x"))
    marked = own.join(F.broadcast(keys), F.col("k") == F.col("t"), "left").select(F.coalesce("target", F.lit(False)).alias("target"), "x")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            for t, x in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                counts = np.bincount(buckets(x, n), minlength=n)
                raw += counts
                if t:
                    target += counts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(raw), pa.array(target)], ["b", "raw", "target"])

    sums = marked.mapInArrow(count, "b int, raw long, target long").groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    both = np.full((2, n), SMOOTHING)
    for r in sums:
        both[:, r["b"]] += r["target"], r["raw"]
    shares = both / both.sum(axis=1, keepdims=True)
    return np.log(shares[0] / shares[1]) if any(r["target"] for r in sums) else np.zeros(n)


def weighed(docs: DataFrame, ratios: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, log_weight)`` for each row; 0 for a text without words. Other columns are left out, whatever their names."""
    n = len(ratios)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [float(ratios[buckets(x, n)].sum()) for x in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.float64())], ["k", "log_weight"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(work, f"k {docs.schema[key].dataType.simpleString()}, log_weight double").withColumnRenamed("k", key)


def gumbel(key: Column, seed: int = 0) -> Column:
    """Standard Gumbel noise from a hash of the key."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls or NaN: counts in ever narrower bins, then the few that are left."""
    span = values.agg(F.min(column), F.max(column), F.count("*")).first()
    low, high, n = span
    if not 0 < k <= (n or 0):
        return None
    above = 0
    while low < high:
        inside = values.where((F.col(column) >= low) & (F.col(column) <= high))
        width = (high - low) / _BINS
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(_BINS - 1)) if width > 0 else F.lit(0)
        bins = {r["b"]: r for r in inside.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b]["n"] >= k:
                break
            above += bins[b]["n"]
        if bins[b]["n"] <= _FEW:
            left = values.where((F.col(column) >= bins[b]["lo"]) & (F.col(column) <= bins[b]["hi"])).select(column).collect()
            return sorted((r[0] for r in left), reverse=True)[k - above - 1]
        if (bins[b]["lo"], bins[b]["hi"]) == (low, high):
            break
        low, high = bins[b]["lo"], bins[b]["hi"]
    return low


def resample(docs: DataFrame, targets: DataFrame, share: float = SHARE, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """``(key, log_weight, noisy, kept)`` for each row of ``docs``: kept are the ceil(share x rows) largest of ``noisy``.

    Rows that tie with the last kept one, which rows with equal keys and texts do, are kept too. Null and empty texts
    weigh 0 before noise. Without target rows all weights are 0 and the draw is uniform. An empty table gives no rows.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must be from 0 to 1")
    scored = weighed(docs, log_ratios(docs, targets, key, text), key, text)
    noisy = cut(scored.withColumn("noisy", F.col("log_weight") + gumbel(F.col(key), seed)))
    rows = noisy.count()
    edge = kth_largest(noisy, "noisy", int(-(-rows * share // 1)))
    return noisy.withColumn("kept", F.lit(False) if edge is None else F.col("noisy") >= F.lit(edge))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), good)
