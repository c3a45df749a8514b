"""Differences of sources against counting and comparing every term."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trivox.llm import divergence
from trivox.llm.winnowing import LOWER, UPPER

DOCS = "text string, lang string, source string, term string"


def brute(docs, least, top):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(UPPER, LOWER)))
    rows = []
    for lang in {d[1] or "" for d in docs}:
        mine = [(terms(d[0]), d[2] or "") for d in docs if (d[1] or "") == lang]
        kept = sorted(t for t, n in Counter(t for w, _ in mine for t in set(w)).items() if n >= least)
        groups = {s: Counter(t for w, q in mine if q == s for t in w if t in kept) for s in {s for _, s in mine}}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        shares, whole = {s: p(c) for s, c in groups.items()}, p(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(o, sum(abs(shares[s][t] - shares[o][t]) for t in kept)) for o in groups if o != s]
            over = [(t, shares[s][t] - whole[t]) for t in kept if groups[s][t] and shares[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                rows += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return sorted(rows)


def docs_of(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "été", "Été", "語", "x9y", "gamma", "delta", *[f"rare{c}" for c in "abcdefgh"]]
    text = lambda: " ".join(rng.choices(vocabulary, [9, 8, 7, 3, 3, 3, 2, 2, *[0.6] * 8], k=rng.randrange(30)))
    rows = [(text(), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", "s3", "ß", "", None]), "x") for _ in range(n)]
    return rows + [(None, "en", "nothing", "x"), ("..", "xx", "a", "x"), ("one", "xx", "b", "x"), ("one", "yy", "alone", "x")] + [rows[0]] * 4


@pytest.mark.parametrize(("seed", "blocks"), [(1, None), (2, 3)])
def test_against_brute_force(spark, monkeypatch, seed, blocks):
    if blocks:  # many blocks of vectors, and pairs in several tasks
        monkeypatch.setattr(divergence, "VECTORS", blocks)
        monkeypatch.setattr(divergence, "PAIRS", 4)
    docs = docs_of(seed)
    made = divergence.divergence(spark.createDataFrame(docs, DOCS), least=12, top=4)
    assert sorted(tuple(r) for r in made.collect()) == brute(docs, 12, 4)


def test_no_terms_and_no_rows(spark):
    df = spark.createDataFrame(docs_of(3, 20), DOCS)
    made = divergence.divergence(df, least=1000).collect()
    assert made and {(r.part, r.value) for r in made} == {("pair", 0)}
    assert divergence.divergence(df.limit(0)).isEmpty()
    renamed = df.toDF("the.text", "my lang", "vector", "source")
    assert divergence.divergence(renamed, "the.text", "my lang", "vector", least=2).count() == divergence.divergence(df, least=2).count()


def test_shares_are_exact(spark):
    rng = random.Random(4)
    rows = [(c, t, v) for v in (1, 7, 10**6) for t in (0, 3, 10**9 + 7, 9 * 10**14) for c in (0, 1, t // 3, t)] + [(rng.randrange(10**14), 9 * 10**14, 10**7) for _ in range(50)]
    df = spark.createDataFrame(rows, "c long, t long, v long")
    want = [1 + 10**9 * (c + 5) // (t + 5 * v) for c, t, v in rows]
    assert [r[0] for r in df.select(divergence.share(F.col("c"), F.col("t"), F.col("v"))).collect()] == want
    assert [int(divergence.shares(np.array([[c]]), np.array([t]), v)[0, 0]) for c, t, v in rows] == want
