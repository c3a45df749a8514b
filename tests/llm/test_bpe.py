import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from trivox.llm import bpe


@pytest.fixture(scope="module")
def library():
    with open(bpe.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def own(text):
    return [i for w in bpe.pretokens(text) for i in bpe.vocabulary().encode(w.encode())]


def test_every_character(library):
    """Each code point beside letters, digits, signs and blanks, in texts of many."""
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for i in range(0, len(points), 4096):
        text = "".join(f"a{c} {c}1{c}!{c}{c}b" for c in map(chr, points[i : i + 4096]))
        assert own(text) == library.encode_ordinary(text), hex(points[i])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aseltvmrd''' \n\t 　é1½!-<|>")), max_size=40))
def test_blanks_and_contractions(library, text):
    assert own(text) == library.encode_ordinary(text)


def test_corpus(spark, library):
    rows = [(1, "it's  we'll\n\n go'd"), (2, ""), (3, None), (None, "null key"), (1, "it's  we'll\n\n go'd"), (5, "<|endoftext|> x"), (6, "ab" * 3000), (7, "word " * 30000), (8, "日本語 текст")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, k string, part int").coalesce(2)
    made = [(r.doc_id, r.ids) for r in bpe.encode(df).collect()]
    assert sorted(map(str, made)) == sorted(str((d, library.encode_ordinary(t or ""))) for d, t in rows)
    back = sorted(str((r.doc_id, bytes(r.bytes).decode())) for r in bpe.decode(bpe.encode(df)).collect())
    assert back == sorted(str((d, t or "")) for d, t in rows)
    assert bpe.encode(df.limit(0)).collect() == []


def test_query(spark, library):
    import duckdb

    d = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op7_bpe(spark, d).collect()}
    docs = duckdb.sql(f"select doc_id, text from '{d}/documents.parquet'").fetchall()
    for k, t in docs:
        ids = library.encode_ordinary(t)
        assert got[k] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert len(got) == len(docs)
