"""Decontamination against a search for every window in every document."""

import hashlib
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from trivox.llm import winnowing

LOWER = str.maketrans(winnowing.UPPER, winnowing.LOWER)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, length=10):
    held = {}
    for item, text in items:
        w = words(text)
        n = min(length, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            held.setdefault(tuple(w[p : p + n]), set()).add("" if item is None else str(item))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in held}:
            for p in range(len(w) - n + 1):
                if items_of := held.get(tuple(w[p : p + n])):
                    hit |= set(range(p, p + n))
                    found |= items_of
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def made(spark, docs, items, kind="long", length=10):
    a, b = spark.createDataFrame(docs, f"doc_id {kind}, text string"), spark.createDataFrame(items, "item_id string, text string")
    return sorted((tuple(r) for r in winnowing.contamination(a, b, length=length).drop("text").collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "É", "é", "語", "42"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(str(i), text(rng.choice([0, 1, 3, 9, 10, 11, 30]) if i > 3 else 25)) for i in range(9)] + [(None, text(12)), ("3", text(14)), ("x", None), ("y", "a")]
    docs = [(i, text(rng.randrange(60))) for i in range(40)] + [(100 + i, f"{text(3)}, {items[i % 9][1].upper()}! {text(9)}") for i in range(18)]
    docs += [(200, None), (200, None), (None, items[1][1]), (None, items[1][1]), (None, items[2][1]), (201, items[1][1]), (201, items[1][1]), (202, "a " * 3000)]
    assert made(spark, docs, items) == brute(docs, items)


def test_windows_of_ten_only(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = [(1, "x " + item + " y"), (2, " ".join(item.split()[:9])), (3, " ".join(item.split()[:10])), (4, item.upper().replace(" ", "--")), (5, "w0 w1 w2 w3 w4 z w5 w6 w7 w8 w9 w10 w11")]
    assert made(spark, docs, [("1", item)]) == brute(docs, [("1", item)])
    assert [r[2] for r in made(spark, docs, [("1", item)])] == [12, 0, 10, 12, 0]


@pytest.mark.parametrize("length", [1, 2, 5, 10])
def test_a_shared_span_is_always_found(spark, length):
    rng = random.Random(length)
    docs = [(i, " ".join(rng.choices("ab", k=25))) for i in range(30)]
    items = [(str(i), " ".join(rng.choices("ab", k=length + 2))) for i in range(6)]
    assert made(spark, docs, items, length=length) == brute(docs, items, length)


def test_a_large_benchmark_goes_by_shuffles(spark, monkeypatch):
    docs, items = [(i, " ".join(f"w{(i + j) % 40}" for j in range(30))) for i in range(50)], [(str(i), " ".join(f"w{(i + j) % 40}" for j in range(15))) for i in range(0, 40, 4)]
    small = made(spark, docs, items)
    monkeypatch.setattr(winnowing, "SENT", 0)
    assert made(spark, docs, items) == small == brute(docs, items)


def test_names_and_empty_tables(spark):
    docs = spark.createDataFrame([("k", "a b", 1, 2)], "`my key` string, `the.text` string, n_hit int, k int")
    items = spark.createDataFrame([(1, "b", 3)], "i int, t string, text int")
    r = winnowing.contamination(docs, items, "my key", "the.text", "i", "t").first().asDict()
    assert r == {"my key": "k", "the.text": "a b", "n_hit_in": 1, "k": 2, "n_words": 2, "n_hit": 1, "n_items": 1, "items_sha256": hashlib.sha256(b"1").hexdigest(), "contaminated": True}
    none = winnowing.contamination(docs, items.limit(0), "my key", "the.text", "i", "t").first()
    assert (none.n_hit, none.n_items, none.contaminated) == (0, 0, False)
    assert winnowing.contamination(docs.limit(0), items, "my key", "the.text", "i", "t").isEmpty()


def test_no_python_on_the_main_path(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    plan = winnowing.contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    each = docs.select(F.explode(winnowing.runs(F.array(*[F.lit(x).cast("long") for x in (1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2)]), 10)).alias("r")).select("r.*").collect()
    # two k-grams that alternate: every window has the same fingerprint, so there is one run of all three
    assert len(each) == 1 and (each[0].s, len(each[0].x)) == (0, 8)
    assert [winnowing.grams(n) for n, _ in product(range(1, 11), [0])] == [((n + 1) // 2, n // 2 + 1) for n in range(1, 11)]
