"""Columns with the names that the operators use inside."""

import pytest

from trivox.llm import bpe, langid, quality, tokencounts, toxicity

ODD = ["k", "t", "x", "target", "c", "p", "u", "lang_pred", "score", "n", "ids", "bytes", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"the cat and word{i} sat", "en", *["odd"] * len(ODD)) for i in range(12)] + [(None, None, None, *["odd"] * len(ODD))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in ODD))


def test_quality(spark, docs):
    ratios = quality.log_ratios(docs, spark.createDataFrame([(1, "y"), (2, "z")], "doc_id long, t string"))
    assert len(ratios) == quality.BUCKETS


def test_language_and_toxicity(spark, docs):
    assert langid.predict(docs, langid.learn(docs)).count() == 13
    labels = spark.createDataFrame([(i, i % 2, "y") for i in range(12)], "doc_id long, toxic int, k string")
    assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == 13


def test_tokens(docs):
    encoded = bpe.encode(docs.drop("ids"))
    assert encoded.columns == ["doc_id", "ids"] and bpe.decode(encoded).count() == 13
    assert tokencounts.tokens_by_line(docs).count() == 13
