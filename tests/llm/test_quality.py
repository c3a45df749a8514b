import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trivox.llm.quality import buckets, kth_largest, log_ratios, resample


def brute(docs, targets, n=10_000):
    raw, target = Counter(), Counter()
    for k, t in docs:
        c = Counter(buckets(None if t is None else t.encode()).tolist())
        raw.update(c)
        if k in targets:
            target.update(c)
    a, b = sum(raw.values()) + n, sum(target.values()) + n
    return {k: sum(math.log((target[x] + 1) / b / ((raw[x] + 1) / a)) for x in buckets((t or "").encode()).tolist()) for k, t in docs}


def test_weights_and_draw(spark):
    docs = [(i, "good words of prose here" if i % 3 else "buy buy $$$ now") for i in range(300)] + [(300, None), (301, ""), (302, "x " * 20000)]
    df = spark.createDataFrame([(k, t, "x", 1.0) for k, t in docs], "doc_id long, text string, kept string, noisy double")
    targets = spark.createDataFrame([(i,) for i in range(300) if i % 3] + [(None,), (1,)], "doc_id long")
    got = {r.doc_id: r for r in resample(df, targets, share=0.5).collect()}
    want = brute(docs, {i for i in range(300) if i % 3})
    assert all(got[k].log_weight == pytest.approx(w, abs=1e-6) for k, w in want.items())
    noisy = sorted((r.noisy for r in got.values()), reverse=True)
    assert sum(r.kept for r in got.values()) == math.ceil(len(docs) * 0.5) and all(r.kept == (r.noisy >= noisy[151]) for r in got.values())
    assert resample(df.limit(0), targets).collect() == []
    assert {r.log_weight for r in resample(df, targets.limit(0)).collect()} == {0.0}
    assert not log_ratios(df, targets.limit(0)).any()


def test_repeated_rows_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c d"), (2, None)], "doc_id long, text string")
    out = resample(df, df.where("doc_id = 1").select("doc_id"), share=0.25).collect()
    assert len(out) == 4 and sum(r.kept for r in out) in (1, 2)
    assert len({(r.noisy, r.kept) for r in out if r.doc_id == 1}) == 1


@pytest.mark.parametrize("few", [5, 100_000])
def test_kth_largest(spark, monkeypatch, few):
    monkeypatch.setattr("trivox.llm.quality._FEW", few)
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(700)).cast("double") ** 3 / 7).alias("x")).cache()
    values = sorted((r.x for r in df.collect()), reverse=True)
    for k in (1, 17, 2500, 5000):
        assert kth_largest(df, "x", k) == values[k - 1]
    assert kth_largest(df, "x", 0) is None and kth_largest(df.limit(0), "x", 1) is None


def test_held_out_labels(spark):
    """Targets that the model did not count: on labelled rows of the other folds, quality 1 ranks above quality 0."""
    import duckdb
    import numpy as np

    from trivox.llm.common import remainder
    from trivox.llm.quality import resample

    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{d}/labels.parquet").where(remainder(F.col("doc_id"), 5) != 0)
    got = {r.doc_id: r for r in resample(docs, labels.where("quality = 1").select("doc_id")).collect()}
    rows = duckdb.sql(f"select doc_id, quality from '{d}/labels.parquet' where quality is not null").fetchall()
    import zlib

    held = [(i, q) for i, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    good, bad = (np.array([got[i].log_weight for i, q in held if q == x]) for x in (1, 0))
    auc = ((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])).mean()
    kept = [np.mean([got[i].kept for i, q in held if q == x]) for x in (1, 0)]
    print("held out:", len(good), len(bad), "AUC", auc, "kept", kept)
    assert auc > 0.9 and kept[0] > kept[1] + 0.3
