import hashlib

from pyspark.sql import functions as F

from trivox.llm.syncmers import K, S, anchors, fingerprint, fingerprints, likeness, steps, with_next


def edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        take = len(t) // 3
        out[d] = (len(t), hashlib.sha256((t[: len(t) - take] + nxt[:take]).encode()).hexdigest())
    return out


def test_edited_text_and_likeness(spark):
    words = [f"wörd{i * 7919 % 4001}" for i in range(1500)]
    rows = [(i * 3, " ".join(words[i * 37 : i * 37 + 60])) for i in range(30)] + [(1000, ""), (1001, None), (1002, "one"), (1003, "é" * 5000), (None, "some words that have no key at all")]
    rows.append((2000, rows[0][1]))
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, n_chars string, pos int")
    got = {r.doc_id: r for r in fingerprints(df).collect()}
    want = edited(rows)
    assert len(got) == len(rows) and {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == want
    assert got[0].fingerprint == got[2000].fingerprint and got[1000].fingerprint == got[1001].fingerprint == ""
    for i in range(30):
        assert 0 <= got[i * 3].near_next <= 1 and 0.25 < got[i * 3].near_edited <= 1
    assert fingerprints(df.limit(0)).collect() == []
    assert fingerprints(df.where("doc_id = 1002")).first().near_next == 1


def test_ranges_do_not_change_neighbours(spark):
    df = spark.range(1000).select((F.col("id") * 13 % 997).alias("k"), F.col("id").alias("__order")).withColumn("v", F.col("k") * 2)
    wide = sorted(map(tuple, with_next(df, "k", ["v"]).collect()))
    assert wide == sorted(map(tuple, with_next(df, "k", ["v"], range_rows=10).collect()))
    assert all(v is not None for *_, v in wide) and dict((k, v) for k, _, _, v in wide if 3 < k)[500] == 998


def test_anchors_are_context_free(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([("a b c " + passage,), (passage + " x y",), ("p0 p1",), ("",), (None,)], "t string")
    first, second, short, none, null = (r.a for r in df.select(anchors(F.col("t")).alias("a")).collect())
    inside = {(x.pos - 3, x.hash) for x in first if x.pos >= K + 2}
    assert inside == {(x.pos, x.hash) for x in second if K - 1 <= x.pos < 60} and len(inside) > 8
    assert [x.pos for x in short] == [0, 1] and [(x.pos, x.hash) for x in short] == [(x.pos, x.hash) for x in second[:2]] and none == null == [] and S < K


def test_one_rule_for_all_texts(spark):
    """A word more, a very long word or another script beside a text leave its anchors as they are."""
    words = [f"w{i * 7919 % 4001}" for i in range(100)]
    han = "".join(chr(0x4E00 + i * 7919 % 20000) for i in range(300))
    pairs = [(" ".join(words[:16]), " ".join(words[:15])), (" ".join(words), " ".join(words) + " " + "x1y2z3" * 330), (han, han + " ".join(words[:60]))]
    df = spark.createDataFrame(pairs, "a string, b string").select(steps(fingerprint(F.col("a"))).alias("a"), steps(fingerprint(F.col("b"))).alias("b"))
    got = [r[0] for r in df.select(likeness(F.col("a"), F.col("b"))).collect()]
    assert all(x > 0.5 for x in got), got


def test_many_null_keys(spark):
    rows = [(None, f"t{i}") for i in range(300)] + [(i, f"k{i}") for i in range(20)] + [(None, "t5")] * 3
    df = spark.createDataFrame(rows, "k long, t string").withColumn("__order", F.xxhash64("t"))
    got = [(r.t, r.next_t) for r in with_next(df, "k", ["t"], range_rows=10).collect()]
    order = [r.t for r in df.orderBy(F.desc_nulls_last("k"), "__order").collect()]
    assert sorted(got) == sorted(zip(order, [*order[1:], order[0]], strict=True))


def test_few_words_and_no_blanks(spark):
    """Two thirds of a short text, or of one without blanks, stay recognisable after an edit."""
    import random

    rng = random.Random(5)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    rows = [(i, han(300 + i)) for i in range(8)] + [(10 + i, f"a short text of words number{i} here") for i in range(8)] + [(30, "someotherword"), (31, han(20000))]
    got = {r.doc_id: r for r in fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(0.1 < r.near_edited < 1 for r in got.values()), {d: r.near_edited for d, r in got.items()}
    assert all(got[i].near_next < 0.1 for i in range(7))


def brute_print(text):
    """Fingerprint and steps of a text, written without Spark."""
    import re

    import xxhash

    long = lambda x: (x & (2**64 - 1)).to_bytes(8, "little")

    def chained(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(v, h)
        return h

    units = re.findall("[^ \t-\r\u0e00-\u0eff\u2e80-\U0010ffff]{1,6}|[^ \t-\r]", text)
    h = [chained([u.encode()]) for u in units]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    found = [(i, chained([i.to_bytes(4, "little"), *[long(x) for x in h[: i + 1]]])) for i in range(min(len(h), 7))]
    m = [chained([long(x) for x in h[i : i + 3]]) for i in range(len(h) - 2)]
    for i in range(len(h) - 7):
        inner = [signed(x) for x in m[i : i + 6]]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i + 7, chained([long(m[i]), long(m[i + 3]), long(m[i + 5])])))
    low = [x & 0xFFFFFFFF for _, x in found]
    gaps = [p - (found[i - 1][0] if i else 0) for i, (p, _) in enumerate(found)]
    code = [g << 32 | x for g, x in zip(gaps, low, strict=True)]
    steps = {chained([long(low[i - 1] if i else -1), long(code[i])]) for i in range(len(code))}
    return "".join(f"{c:09x}" for c in code), steps


def test_against_brute_force(spark):
    """Fingerprints and likenesses of real texts, of short ones and of scripts without blanks."""
    import duckdb

    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows += [(10**9, None), (10**9 + 1, "a b"), (10**9 + 2, "é" * 70), (10**9 + 3, "漢字かな混じり文" * 30), (10**9 + 4, "漢字かな混じり文" * 29 + "終わり")]
    got = {r.doc_id: r for r in fingerprints(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, `x.y` int")).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    like = lambda a, b: 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0
    for i, (d, t) in enumerate(order):
        t, follows = t or "", order[(i + 1) % len(order)][1] or ""
        take = len(t) // 3
        (own, a), (changed, b) = brute_print(t), brute_print(t[: len(t) - take] + follows[:take])
        assert (got[d].fingerprint, got[d].edited_fingerprint) == (own, changed)
        assert abs(got[d].near_edited - like(a, b)) < 1e-12 and abs(got[d].near_next - like(a, brute_print(follows)[1])) < 1e-12


def test_chinese_text_with_a_third_replaced(spark):
    import random

    rng = random.Random(2)
    rows = [(i, "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(900))) for i in range(3)]
    assert all(0.6 < r.near_edited < 0.7 and r.near_next < 0.05 for r in fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_keys_of_text(spark):
    rows = [(f"key{i:03d}", " ".join(f"w{i * 31 + j}" for j in range(30))) for i in range(50)] + [(None, "x y z")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in fingerprints(df).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or ""), reverse=True)
    for i, (d, t) in enumerate(order):
        take = len(t) // 3
        assert got[d] == (len(t), hashlib.sha256((t[: len(t) - take] + order[(i + 1) % len(order)][1][:take]).encode()).hexdigest())
    led = with_next(df.withColumn("__order", F.lit(0)), "doc_id", ["text"], range_rows=7)
    follows = {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}
    assert {r.doc_id: r.next_text for r in led.collect()} == follows
