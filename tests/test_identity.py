"""Clusters that keep their ids from run to run."""

import random

import pytest
from pyspark.sql import functions as F

from trivox.operators import consensus

MEMBERS = "platform string, video_id string, cluster_id string, comment_id string, stable boolean, prompt_version string, rule_version string"


def members(spark, rows):
    return spark.createDataFrame([("p", v, c, m, True, "p1", "r") for v, c, m in rows], MEMBERS)


def brute(new, known, verdicts):
    """Greedy by the total order, one pair at a time."""
    sets = lambda rows: {k: {m for v, c, m in rows if (v, c) == k} for k in {(v, c) for v, c, _ in rows}}
    a, b = sets(new), sets(known)
    edges = [(-len(x & y), d, min(x), c, v) for (v, c), x in a.items() for (w, d), y in b.items() if v == w and (x & y or (v, c, d) in verdicts)]
    out, used = set(), set()
    for n, d, first, c, v in sorted(edges, key=lambda e: (e[0], e[1], e[2], e[3])):
        if (v, "n", c) not in used and (v, "k", d) not in used:
            used |= {(v, "n", c), (v, "k", d)}
            out.add((v, c, d))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_assigned(spark, seed):
    rng = random.Random(seed)
    comments = [(v, f"m{i:02}") for v in "vw" for i in range(14)]
    new = [(v, f"n{rng.randrange(5)}", m) for v, m in comments if rng.random() < 0.9]
    known = [(v, f"k{rng.randrange(5)}", m) for v, m in comments if rng.random() < 0.8]
    verdicts = {("v", "n0", "k4"), ("w", "n1", "k9")}
    told = spark.createDataFrame([("p", *x) for x in verdicts], "platform string, video_id string, cluster_id string, known_id string")
    made = consensus.assigned(members(spark, new), members(spark, known), told)
    got = {(r.video_id, r.cluster_id, r.known_id) for r in made.collect()}
    assert got == brute(new, known, verdicts)
    # another numbering of the new clusters: the same assignment
    other = {f"n{i}": f"n{(i * 3 + 2) % 5}" for i in range(5)}
    moved = [(v, other[c], m) for v, c, m in new]
    again = consensus.assigned(members(spark, moved), members(spark, known), told.replace(other, subset=["cluster_id"]))
    assert {(r.video_id, r.cluster_id, r.known_id) for r in again.collect()} == {(v, other[c], d) for v, c, d in got}


def test_identified_over_runs(spark):
    live = lambda *ids: spark.createDataFrame([("p", "v", i) for i in ids], "platform string, video_id string, comment_id string")
    of = lambda df: {i: {r.comment_id for r in df.collect() if r.cluster_id == i} for i in {r.cluster_id for r in df.collect()}}
    none = spark.createDataFrame([], MEMBERS)
    one = of(first := consensus.identified(members(spark, [("v", "0", "a"), ("v", "0", "b"), ("v", "1", "c")]), none, live("a", "b", "c"), "r1"))
    assert sorted(map(sorted, one.values())) == [["a", "b"], ["c"]]
    name = {min(v): k for k, v in one.items()}
    # the numbers change places, and a new cluster comes
    two = of(second := consensus.identified(members(spark, [("v", "0", "c"), ("v", "1", "a"), ("v", "1", "b"), ("v", "1", "d"), ("v", "2", "e")]), first, live(*"abcde"), "r2"))
    assert two[name["a"]] == {"a", "b", "d"} and two[name["c"]] == {"c"} and len(two) == 3
    # nothing is judged: what is live stays; then a verdict joins without a shared comment
    assert of(consensus.identified(none, second, live("b", "d", "e"), "r3")) == {name["a"]: {"b", "d"}, next(k for k, v in two.items() if v == {"e"}): {"e"}}
    told = spark.createDataFrame([("p", "v", "9", name["c"])], "platform string, video_id string, cluster_id string, known_id string")
    four = of(consensus.identified(members(spark, [("v", "9", "z")]), second, live(*"abcdez"), "r4", told))
    assert four[name["c"]] == {"c", "z"}
    # split: the part with more of the old comments keeps the id, the other gets one of its own
    five = of(consensus.identified(members(spark, [("v", "0", "a"), ("v", "1", "b"), ("v", "1", "d")]), second, live(*"abd"), "r5"))
    assert five[name["a"]] == {"b", "d"} and sorted(map(sorted, five.values())) == [["a"], ["b", "d"]]


def test_none_shares_a_minted_id(spark):
    new = members(spark, [("v", "0", "a"), ("v", "1", "a"), ("v", "1", "b"), ("w", "0", "a")])
    live = new.select("platform", "video_id", "comment_id")
    made = consensus.identified(new, new.limit(0), live, "r")
    assert made.select("cluster_id").distinct().count() == 3 and made.agg(F.count("*")).first()[0] == 4
