"""The set-similarity join against all pairs."""

import random

from trivox.operators import similar


def brute(rows, least):
    sets = {i: set(t) for i, t in rows}
    num, den = least
    return {(a, b, len(x & y), len(x | y)) for a, x in sets.items() for b, y in sets.items() if x and y and len(x & y) * den >= len(x | y) * num}


def test_tokens(spark):
    rows = [("a", "Budget app 2 budget"), ("b", "记账软件App"), ("c", "账"), ("d", None), ("e", " ,。 ")]
    df = spark.createDataFrame(rows, "id string, text string")
    got = {r.id: set(r.t) for r in df.select("id", similar.tokens(df.text).alias("t")).collect()}
    assert got == {"a": {"budget", "app", "2"}, "b": {"记账", "账软", "软件", "app"}, "c": {"账"}, "d": set(), "e": set()}


def test_all_pairs_at_each_index(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    # a few words are in nearly all sets, and some sets are copies
    texts = [[w for w in words if rng.random() < (0.9 if w in words[:3] else 0.25)] for _ in range(120)]
    texts += [texts[i][:] for i in range(5)] + [texts[i][1:] for i in range(5, 15)] + [["w0"], ["w0", "w1"], []]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "id int, text string")
    for least in ((3, 10), (6, 10), (9, 10), (1, 1)):
        got = {(r.left_id, r.right_id, r.shared, r.either) for r in similar.candidates(df, df, "id", "text", least).collect()}
        assert got == brute(rows, least), least
    assert similar.candidates(df.limit(0), df, "id", "text").isEmpty()


def written(spark):
    """Bytes that shuffles of this session have written so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_pairs_inside_one_frame(spark):
    rng = random.Random(4)
    # sets of more tokens than a word of bits has, and short ones
    words = [f"w{i:03d}" for i in range(150)]
    sets = {tuple(sorted(rng.sample(words, rng.choice((1, 2, 3, 90, 120))))) for _ in range(80)}
    sets |= {t[1:] for t in list(sets)[:20] if len(t) > 1} | {("w000",), ("w000", "w001")}
    rows = [(",".join(t), list(t)) for t in sets]
    df = spark.createDataFrame(rows, "set string, t array<string>")
    for least in ((3, 10), (6, 10), (9, 10)):
        got = [tuple(r) for r in similar.similar_sets(df, least=least).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {p for p in brute(rows, least) if p[0] < p[1]}, least


def test_query_writes_no_pairs_that_share_too_little(spark, tmp_path):
    """Many pairs meet in a token and have sizes and places that fit; few are similar enough."""
    from trivox.plans.catalog import queries

    rng = random.Random(5)
    rows = [(o, rng.randrange(200)) for o in range(6000) for _ in range(rng.randint(4, 6))] + [(None, 1), (7000, None), (7001, 123456789), (7002, 12345678), (7002, -5)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = written(spark)
    got = {tuple(r) for r in queries()["similar_sets"](spark, str(tmp_path)).collect()}
    size = written(spark) - before
    orders = {}
    for o, s in rows:
        orders.setdefault(o, set()).update([] if s is None else [str(s).rjust(8, "0")[:8]])
    sets = sorted({",".join(sorted(t)): t for t in orders.values() if t}.items())
    met = {}
    for i, (_, t) in enumerate(sets):
        for token in t:
            met.setdefault(token, []).append(i)
    want = set()
    for i, j in {(i, j) for ids in met.values() for a, i in enumerate(ids) for j in ids[a + 1 :]}:
        n = len(sets[i][1] & sets[j][1])
        m = len(sets[i][1] | sets[j][1])
        want |= {(sets[i][0], sets[j][0], n, m)} if 10 * n >= 6 * m else set()
    assert got == want and len(want) > 10
    assert size < 100 * len(rows)
