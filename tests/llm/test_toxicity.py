import random

import numpy as np

from trivox.llm.toxicity import Model, candidates, descent, features, fit, learn, op4_toxicity, score, shares


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{i}x".replace(str(i), "abcdefghij"[i % 10]) for i in range(400)]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        bad = i % 9 == 0
        if bad:
            text[rng.randrange(len(text))] = rng.choice(["vileness", "vileword", "nastything"])
        out.append((i, " ".join(text), int(bad)))
    return out


def test_learns_from_positives_and_unlabelled():
    rows = corpus(4000)
    model = fit([features(t) for _, t, y in rows[:2000] if y], [features(t) for _, t, _ in rows[:2000]], 1 / 9)
    said = np.array([model.score(t) >= 0.3 for _, t, _ in rows[2000:]])
    truth = np.array([y == 1 for *_, y in rows[2000:]])
    assert (said & truth).sum() / truth.sum() > 0.95 and (said & truth).sum() / said.sum() > 0.9


def test_score_is_that_of_the_features():
    rows = corpus(2000)
    model = fit([features(t) for _, t, y in rows if y], [features(t) for _, t, _ in rows], 1 / 9)
    rng = random.Random(1)
    stems = ["vile" + "".join(rng.choice("abc") for _ in range(3)) for _ in range(20)]
    for text in [t for _, t, _ in rows[:300]] + [" ".join(rng.sample(stems, n)) for n in range(1, 9)] + ["", None]:
        z = model.bias + model.weights[np.isin(model.names, features(text))].sum()
        assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-12


def test_edges(spark):
    rows = [(i, t, "x", 2.0) for i, t, _ in corpus(200)] + [(500, None, "x", 1.0), (501, "", "x", 1.0), (None, "vileword", "x", 1.0), (502, "word " * 50000, "x", 1.0), (1, "again", "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus(200)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    out = score(docs, learn(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[500] == by[501]
    nothing = learn(docs.limit(0), labels.limit(0))
    assert isinstance(nothing, Model) and {r.score for r in score(docs, nothing).collect()} == {nothing.score("")}
    assert score(docs.limit(0), nothing).collect() == []


def test_held_out(spark):
    import duckdb

    d = "/root/testdata/sf0.1"
    got = op4_toxicity(spark, d).toPandas().set_index("doc_id")
    truth = duckdb.sql(f"select doc_id, toxic from '{d}/labels.parquet'").df().set_index("doc_id").toxic
    held = got[got.held_out].join(truth, how="inner")
    caught = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert len(got) == 10_000 and caught / (held.toxic == 1).sum() > 0.85 and caught / (held.predicted == 1).sum() > 0.7


def test_shares_of_all_rows(spark):
    """Counts over every row, repeated and empty ones too, against counting each text's features."""
    rows = corpus(600)
    names, count = candidates([features(t) for _, t, y in rows if y])
    texts = [t for _, t, _ in rows] + [rows[0][1]] * 3 + [None, "", "vile " * 30000]
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, i long").repartition(7)
    got, n = shares(docs, names)
    made = [features(t) for t in texts]
    assert n == len(texts) and len(names) > 50 and (count >= 3).all()
    assert got.tolist() == [sum(bool(np.isin(x, m)) for m in made) for x in names]
    assert shares(docs.limit(0), names)[1] == 0 and shares(docs, names[:0])[1] == len(texts)
    whole = [features(t) for t in texts]
    bad = [features(t) for _, t, y in rows if y]
    one, other = fit(bad, whole, 0.1), fit(bad, whole, 0.1, (got, n))
    assert (one.names == other.names).all() and np.allclose(one.weights, other.weights)


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    n_p, n_u, width = 13, 40, 6
    rows = lambda n: tuple(np.nonzero(rng.random((n, width)) < 0.4))
    (pr, pc), (ur, uc) = rows(n_p), rows(n_u)
    # all positives and no unlabelled row have the first feature
    pr, pc = np.append(pr[pc > 0], np.arange(n_p)), np.append(pc[pc > 0], np.zeros(n_p, int))
    ur, uc = ur[uc > 0], uc[uc > 0]

    def parts(w, b, prior):
        gp, gu = b + np.bincount(pr, w[pc], n_p), b + np.bincount(ur, w[uc], n_u)
        return prior * np.logaddexp(0, -gp).mean(), np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()

    seen = set()
    for prior, b in ((0.1, -1.0), (0.9, 2.0), (0.5, 0.3), (0.95, -3.0)):
        w = rng.normal(size=width) + (12 * np.eye(width)[0] if prior > 0.8 else 0)
        below = bool(parts(w, b, prior)[1] < 0)
        seen.add(below)
        risk = lambda w, b, p=prior, low=below: -parts(w, b, p)[1] if low else sum(parts(w, b, p))
        by_weight, by_bias = descent(w, b, (pr, pc, n_p), (ur, uc, n_u), prior)
        for i in range(width):
            step = np.eye(width)[i] * 1e-6
            assert abs((risk(w + step, b) - risk(w - step, b)) / 2e-6 - by_weight[i]) < 1e-6
        assert abs((risk(w, b + 1e-6) - risk(w, b - 1e-6)) / 2e-6 - by_bias) < 1e-6
    assert seen == {False, True}


def test_learned_in_executors_as_on_one_machine(spark):
    """The features chosen in the executors and the fit on them, against fitting on whole texts."""
    rows = corpus(700)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = learn(docs, labels)
    from zlib import crc32

    inside = [r for r in rows if crc32(str(r[0]).encode()) % 4 != 2]
    bad, whole = [features(t) for _, t, y in inside if y], [features(t) for _, t, _ in inside]
    other = fit(bad, whole, (len(bad) + 0.5) / (len(inside) + 1))
    assert (model.names == other.names).all() and np.allclose(model.weights, other.weights, atol=1e-9) and abs(model.bias - other.bias) < 1e-9
