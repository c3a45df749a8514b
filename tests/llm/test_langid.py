import collections

from trivox.llm.langid import PROFILE, Profiles, known_language, learn, ngrams, op3_langid, predict, ranked


def brute_ngrams(text):
    low = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    out = collections.Counter()
    for w in low.split():
        w = f" {w} "
        for n in (1, 2, 3):
            out.update(g for g in (w[i : i + n] for i in range(len(w) - n + 1)) if g != " ")
    return out


def code(g):
    n = 0
    for c in g:
        n = n << 21 | ord(c)
    return n


def test_ngrams():
    for t in ("The cat; sat!", "", "123 !!", None, "a", "Äpfel über\n\nÖl", "x1y"):
        want = collections.Counter({code(g): n for g, n in brute_ngrams(t).items()})
        got = collections.Counter(ngrams(t).tolist())
        shared = {code(" ")}  # a blank between words counts in no n-gram by itself
        assert got - collections.Counter(shared) == want, t
    assert len(ranked(ngrams("abc " * 50))) <= PROFILE


def test_predict_and_edges(spark):
    rows = [(1, "the cat and the dog and the rat", "en"), (2, "der hund und die katze und der mann", "de"), (3, None, "de"), (4, "12 !!", "en"), (5, "the the " * 20000, None), (None, "und die der", None)]
    df = spark.createDataFrame([(d, t, lang, "x") for d, t, lang in rows], "doc_id long, text string, lang string, k string")
    model = learn(df)
    assert model.langs == ["de", "en"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(df, model).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 5, None)] == ["en", "de", "und", "und", "en", "de"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r.doc_id for r in known_language(df, model).collect()} == {1, 2, 5, None}
    nothing = learn(df.limit(0))
    assert {r.lang_pred for r in predict(df, nothing).collect()} == {"und"} and isinstance(nothing, Profiles)


def test_held_out_accuracy(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    got = op3_langid(spark, d).toPandas()
    truth = dict(duckdb.sql(f"select doc_id, lang from '{d}/documents.parquet'").fetchall())
    held = got[got.held_out]
    assert len(got) == len(truth) and 100 < len(held) < 300
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.97


def test_unlearned_languages_and_junk_are_rejected(spark):
    from trivox.llm.langid import bounds

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    other = [
        "Wczoraj wieczorem poszliśmy do teatru, aby zobaczyć nową sztukę młodego autora, który mieszka w naszym mieście od kilku lat.",
        "Eilen illalla menimme teatteriin katsomaan nuoren kirjailijan uutta näytelmää, joka on asunut kaupungissamme jo useita vuosia.",
        "Dün akşam şehrimizde birkaç yıldır yaşayan genç yazarın yeni oyununu görmek için tiyatroya gittik ve çok beğendik.",
        "asdfkj qwepoi zxcmnv lkjhgf poiuyt mnbvcx qazwsx edcrfv tgbyhn ujmikl asdlkj qweoiu zmxncb sldkfj",
    ]
    mixed = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(-i, t, None) for i, t in enumerate(other, 1)], "doc_id long, text string, lang string"))
    model = learn(mixed)
    kept = {r.doc_id for r in known_language(mixed, model, least=bounds(mixed, model)).collect()}
    assert not kept & {-1, -2, -3, -4} and len(kept) >= docs.count() - 2


def test_ranks_distances_and_ties(spark):
    """Profiles and out-of-place distances against counting n-grams one by one."""
    import random

    rng = random.Random(7)
    text = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 40)))
    rows = [(i, text({"x": "abcd", "y": "cdef", "z": "abcd"}[lang]), lang) for i in range(60) for lang in "xyz"]
    rows += rows[:5] + [(900, "same", "u"), (901, "same", "v"), (902, None, "x"), (903, "abc", None)]
    model = learn(spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(4), size=50)
    profile = {}
    for lang in "uvxyz":
        counts = collections.Counter()
        for _, t, own in rows:
            if own == lang and t is not None:
                counts.update(ngrams(t).tolist())
        profile[lang] = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:50]]
    got = {lang: [int(g) for _, g in sorted(zip(ranks.tolist(), grams.tolist(), strict=True))] for lang, grams, ranks in zip(model.langs, model.grams, model.ranks, strict=True)}
    assert got == profile
    for t in [text("abcdef") for _ in range(40)] + ["same", "abc " * 30]:
        counts = collections.Counter(ngrams(t).tolist())
        own = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))][:PROFILE]
        far = {lang: sum(abs(grams.index(g) - i) if g in grams else PROFILE for i, g in enumerate(own)) for lang, grams in profile.items()}
        best = min(sorted(far), key=far.get)
        assert model.closest(t) == (best, max(0.0, 1 - far[best] / (PROFILE * len(own))))
    assert model.closest("same")[0] == "u"  # equally far: the first by name
