"""The audit of five filters against applying them one after the other."""

import random
import re
from fractions import Fraction
from itertools import permutations

from trivox.llm import filteraudit

DOCS, LABELS = "doc_id long, text string, source string, k string", "doc_id long, quality int, toxic int"


def fails(text, key, least):
    text = text or ""
    w, caps = re.findall(r"[^\x20\x09-\x0D]+", text), len(re.findall("[A-Z]", text))
    rules = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * caps > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": key is not None and text in least and key > least[text]}
    return {f for f, bad in rules.items() if bad}


def brute(docs, labels):
    least = {}
    for key, text, *_ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    good, toxic = ({k for k, *v in labels if k is not None and v[i] == 1} for i in (0, 1))
    rows, parts = [], sorted({d[2] or "" for d in docs})
    for part in parts:
        mine = [(d[0], fails(d[1], d[0], least)) for d in docs if (d[2] or "") == part]
        whole, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                early = sum(f in d[1] for d in mine) - len(gone)
                whole.append([part, "".join(order), step, len(left), len(gone), early, sum(d[1] == {f} for d in mine), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)])
        rows += [(*r, total[r[1][r[2] - 1]]) for r in whole]
    return sorted(rows)


def test_against_applying_them(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["wort", "Wort", "WORT", "été", "a|b", "x", "y", "z"]) + str(rng.randrange(rng.choice([3, 90])))
    text = lambda: rng.choice([" ", "\n", "\x0b", "  "]).join(word() for _ in range(rng.choice([0, 5, 49, 50, 51, 80])))
    docs = [(i, text(), rng.choice(["s", "t", None, ""]), "x") for i in range(80)]
    docs += [(100 + i, docs[i % 7][1], "copies", "x") for i in range(20)] + [(100, docs[0][1], "s", "x")] * 2 + [(None, docs[1][1], "s", "x")] * 3 + [(None, None, "n", "x"), (300, None, "n", "x"), (301, "", "n", "x")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 110, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (999, 1, 1)]
    made = filteraudit.filter_audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert sorted(tuple(r) for r in made.collect()) == brute(docs, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([(1, "a", "s", "x")], DOCS), spark.createDataFrame([], LABELS)
    assert filteraudit.filter_audit(docs.limit(0), labels).isEmpty() and filteraudit.filter_audit(docs, labels).count() == 600
    named = lambda df, key: df.withColumnRenamed("doc_id", key)
    assert filteraudit.filter_audit(named(docs, "h").withColumnRenamed("source", "n"), named(labels, "h"), "h", "text", "n").count() == 600


def test_shares(spark):
    """Shapley shares by their definition: the mean of what a filter adds, over all orders."""
    rng = random.Random(5)
    counts = [rng.randrange(50) for _ in range(32)]
    p = filteraudit.polynomial(counts)
    gone = lambda on: sum(n for m, n in enumerate(counts) if m & on)
    assert [filteraudit.corner(p, on) for on in range(32)] == [gone(on) for on in range(32)]
    for i in range(5):
        adds = [gone(before | 1 << i) - gone(before) for order in permutations(range(5)) for before in [sum(1 << j for j in order[: order.index(i)])]]
        assert filteraudit.shapley(p, i) == Fraction(sum(adds), 120)
    assert sum(filteraudit.shapley(p, i) for i in range(5)) == gone(31)
