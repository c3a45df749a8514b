import random
import re

import numpy as np
import pytest
import xxhash

from trivox.llm.simhash import fingerprint, near_duplicates, near_edges, representatives


def slow(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(keys, fps):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    out = {}
    for i in range(len(keys)):
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(near[todo.pop()]).tolist():
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[keys[i]] = min(keys[j] for j in seen)
    return out


def test_fingerprint(spark):
    for t in ("", None, "One", "One TWO", "a b c d", "ÀB  c d e\x0bf\n", "x y z " * 30000):
        assert fingerprint(None if t is None else t.encode()) == slow(t)
    rows = [(5, "the same text of some words"), (2, "The same  text of some words"), (9, None), (8, ""), (None, "the same text of some words"), (5, "the same text of some words"), (3, "another")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, fp string, a int")
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(df).collect()}
    assert got == {(k, format(slow(t), "016x"), c) for (k, t), c in zip(rows, (2, 2, 8, 8, 2, 2, 3), strict=True)}
    assert near_duplicates(df.limit(0)).collect() == []
    kept = representatives(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "8", "None"]


@pytest.mark.parametrize("block", [65_536, 50])
def test_links(spark, block):
    """Chains, dense groups and strangers, in one block of a population count and in many."""
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(300):
        fps.append(rng.choice(fps) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    fps += [fps[0] ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(30)]
    fps = np.array(sorted({x % 2**64 for x in fps}), np.uint64).view(np.int64)
    from trivox.llm.common import components

    edges = near_edges(spark.createDataFrame([(int(x),) for x in fps], "fp long"), block=block)
    got = {r.node: r.root for r in components(edges).collect()}
    assert {x: got.get(x, x) for x in fps.tolist()} == groups(fps.tolist(), fps.view(np.uint64))


def test_representatives_are_near_copies(spark):
    """Chains of edits at 0.8 or more over five words go, others stay, also in dense groups and under one key."""
    from trivox.llm.simhash import shingles, similarity

    rng, texts = random.Random(3), []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for n in (0, 1, 2, 3, 4, 5, 7, 9):
            made = list(base)
            for i in rng.sample(range(120), n):
                made[i] = f"e{rng.randrange(5000)}"
            texts.append(" ".join(made))
    hot = [f"h{i}" for i in range(200)]
    for i in range(150):
        texts.append(" ".join([*hot[:i], f"x{i}", *hot[i + 1 :]]))
    sets = [shingles(t.encode()) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and similarity(sets[i], sets[j]) >= 0.8:
                label = [label[j] if x == label[i] else x for x in label]
    want = sorted({min(i for i, x in enumerate(label) if x == root) for root in set(label)})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in representatives(df).collect()) == want and 13 < len(want) < 90
    one = spark.createDataFrame([(1, texts[0]), (1, texts[8]), (1, texts[8]), (2, texts[0])], "doc_id long, text string")
    assert sorted(r.text for r in representatives(one).collect()) == sorted([texts[0], texts[8]])


def test_large_groups_are_split(spark):
    """A group of near copies in many pairs of blocks has the components that one task gives it."""
    from pyspark.sql import functions as F

    from trivox.llm.simhash import copies, with_copy_marks

    rng, rows = random.Random(8), []
    hot = [f"h{i}" for i in range(120)]
    for k in range(90):
        made = list(hot)
        for i in rng.sample(range(120), 1 + k % 2):
            made[i] = f"x{k}.{i}"
        rows.append((k, " ".join(made)))
    docs = spark.createDataFrame(rows, "k long, t string").withColumn("h", F.xxhash64("t")).select("k", "h", "t")
    marked = with_copy_marks(docs)
    whole = {(r.node, r.root) for r in copies(marked, docs).collect()}
    assert whole == {(r.node, r.root) for r in copies(marked, docs, held=20_000).collect()} and len(whole) > 20


def test_reach_of_fingerprints():
    """Sets of an index of 0.8 lie within the radius, small ones too."""
    from trivox.llm.simhash import reach, wide

    rng = np.random.default_rng(4)
    for n, m, size in ((4, 1, 500), (8, 2, 500), (45, 5, 300), (400, 50, 100)):  # n + m and n shingles, or n + m of each
        for _ in range(size):
            x = rng.integers(0, 2**63, n + 2 * m).astype(np.uint64)
            a, b = (x[:n], x[: n + m]) if n < 10 else (x[: n + m], np.concatenate((x[:n], x[n + m :])))
            f = [np.array(wide(np.unique(s)), np.int64).view(np.uint64) for s in (a, b)]
            bits = np.bitwise_count(f[0] ^ f[1])
            assert bits.sum() <= reach(256, small=len(a) <= 8) and bits[0] <= reach(64, small=len(a) <= 8)
