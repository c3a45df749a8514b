import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from trivox.llm.tokencounts import allot, token_spans, tokens_by_field, tokens_by_line

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True


def brute_lines(text):
    """By the offsets of another library."""
    out = {}
    starts, at = [], 0
    for i, line in enumerate(text.split("\n")):
        if min(at + len(line) + 1, len(text)) > at:
            starts.append((str(i), at, min(at + len(line) + 1, len(text))))
        at += len(line) + 1
    for name, s, e in starts:
        out[name] = [s, e, 0, 0]
    for a, b in LIBRARY.encode(text, add_special_tokens=False).offsets:
        name = next(n for n, s, e in starts if s <= a < e)
        out[name][2] += 1
        out[name][3] += b > out[name][1]
    return out


def test_spans_are_those_of_another_library():
    for text in ("it's  we'll\n\n go'd", "naïve Ünï 日本 x", "a\r\n\t b", "word " * 50):
        starts, ends = token_spans(text)
        ids = LIBRARY.encode(text, add_special_tokens=False)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [tuple(x) for x in ids.offsets], text


def test_lines(spark):
    texts = ["one two\nthree\n\n\n  four!!\nfive", "x", "\n\n\nabc", "naïve\nÜber\n", "word\n" * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10, ""), (11, None), (None, "no key"), (0, texts[0])]
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, section string, first int")
    got = {}
    for r in tokens_by_line(df).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    for i, t in enumerate(texts):
        want = sorted((n, *v) for n, v in brute_lines(t).items())
        assert sorted(set(got[i])) == want and len(got[i]) == len(want) * (2 if i == 0 else 1)
    assert got[10] == got[11] == [(None, None, None, 0, 0)] and len(got[None]) == 1
    assert tokens_by_line(df.limit(0)).collect() == []


def test_rules():
    starts, ends, a, b = (np.array(x) for x in ([0, 2, 6, 9], [2, 6, 9, 12], [0, 3, 7], [3, 7, 11]))
    first, crossing = allot(starts, ends, a, b)
    most, _ = allot(starts, ends, a, b, "most")
    assert first.tolist() == [0, 0, 1, 2] and crossing.tolist() == [False, True, True, True] and most.tolist() == [0, 1, 2, 2]


def test_fields(spark):
    df = spark.createDataFrame([(1, "Title", None, "the body text"), (2, None, None, None)], "doc_id long, a string, b string, c string")
    got = {(r.doc_id, r.section): r.n_tokens for r in tokens_by_field(df, ["a", "b", "c"]).collect()}
    text = "Title\nthe body text"
    assert sum(n for (d, _), n in got.items() if d == 1) == len(LIBRARY.encode(text, add_special_tokens=False).ids)
    assert set(got) == {(1, "a"), (1, "c"), (1, None), (2, None)} and got[2, None] == 0


def test_most_against_counting_characters():
    rng = np.random.default_rng(1)
    for _ in range(200):
        edges = np.sort(rng.choice(60, rng.integers(2, 12), replace=False))
        keep = rng.random(len(edges) - 1) < 0.8  # gaps between some sections
        a, b = edges[:-1][keep], edges[1:][keep]
        starts = np.sort(rng.integers(0, 58, 9))
        ends = starts + rng.integers(1, 14, 9)
        found, crossing = allot(starts, ends, a, b, "most")
        for s, e, at, over in zip(starts.tolist(), ends.tolist(), found.tolist(), crossing.tolist(), strict=True):
            shared = [max(0, min(e, y) - max(s, x)) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            want = shared.index(max(shared)) if shared and max(shared) else -1
            assert at == want and (over or sum(n > 0 for n in shared) <= 1)
