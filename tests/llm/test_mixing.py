import math
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from trivox.llm.mixing import in_mixed_order, mix, period, whole_weights


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 1.5, "d": 0.5}, {f"s{i}": i + 1 for i in range(17)}])
def test_period_is_fair(weights):
    parts = whole_weights(weights, 1000)
    assert sum(parts.values()) == 1000
    slots = period(parts)
    assert Counter(s for s, *_ in slots) == parts
    served = Counter()
    for t, (s, j, release, deadline, slot) in enumerate(slots):
        w = Fraction(parts[s], 1000)
        assert (release, deadline) == (math.floor(j / w), math.ceil((j + 1) / w)) and release <= slot < deadline and t == slot
        served[s] += 1
        for q in parts:
            assert abs(served[q] - Fraction(parts[q], 1000) * (t + 1)) < 1


def test_mix(spark):
    rows = [(i, "hot" if i % 3 else ("cold" if i % 2 else None), "x", i) for i in range(500)] + [(7, "hot", "x", 7), (None, "hot", "y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, block2 string, n int")
    out = mix(df, {"hot": 2, "cold": 1, None: 1}, block=4, resolution=100).collect()
    assert sorted(str((r.doc_id, r.source, r.block2, r.n)) for r in out) == sorted(map(str, rows))
    assert len({(r.slot, r.place) for r in out}) == len(rows)
    owner, lag = {}, Counter()
    for r in out:
        assert owner.setdefault(r.slot, r.source) == r.source and r.release <= r.slot < r.deadline
    end = max(r.slot for r in out if r.open_mix)
    for t in range(end + 1):
        lag[owner[t]] += 1
        for s, w in (("hot", 0.5), ("cold", 0.25), (None, 0.25)):
            assert abs(lag[s] - w * (t + 1)) < 1.03  # weights are rounded to hundredths
    sizes = defaultdict(Counter)
    for r in out:
        sizes[r.source][r.block] += 1
    for by_block in sizes.values():
        assert sorted(by_block) == list(range(len(by_block))) and all(n == 4 for b, n in by_block.items() if b < len(by_block) - 1)
    mixed = [r.doc_id for r in in_mixed_order(df, 3).collect()]
    order = {(r.doc_id, r.n): (r.slot, r.place) for r in mix(df).collect()}
    assert len(mixed) == len(rows) and in_mixed_order(df, 3).columns == df.columns
    got = [order[r.doc_id, r.n] for r in in_mixed_order(df, 3).collect()]
    assert sum(a > b for a, b in zip(got, got[1:], strict=False)) <= 2  # rows with equal keys may change places


def test_ranges_do_not_change_the_mix(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    places = lambda n: {(r.doc_id, r.slot, r.place) for r in mix(df, block=4, resolution=100, range_rows=n).collect()}
    assert places(1) == places(10) == places(1 << 16) and len(places(10)) == 900


def test_edges(spark):
    df = spark.createDataFrame([], "doc_id long, source string")
    assert mix(df).collect() == []
    one = spark.createDataFrame([(1, None)], "doc_id long, source string")
    assert [r.slot for r in mix(one).collect()] == [0]
    with pytest.raises(ValueError):
        mix(one, {"a": 1.0})


@pytest.mark.parametrize("n,rows,power", [(20, 3_000_000, 0.5), (20, 3_000_000, 1), (5000, 3_000_000, 1), (12_000, 3_000_000, 0.5), (20, 50_000, 1)])
def test_lag_behind_the_given_weights(n, rows, power):
    """While the mix is open, rounding adds less than half a block to the block that the schedule allows."""
    from trivox.llm.mixing import BLOCK, fine_resolution

    sizes = {f"s{i}": rows * 2 // 3 // (n - 1) for i in range(n - 1)} | {"hot": rows // 3}
    weights = {s: x**power for s, x in sizes.items()}
    total = sum(weights.values())
    end = min(-(-sizes[s] // BLOCK) * total / w for s, w in weights.items())
    resolution = fine_resolution(weights, sizes)
    parts = whole_weights(weights, resolution)
    assert sum(parts.values()) == resolution
    served = Counter()
    for slot, (s, *_) in enumerate(period(parts)):
        if slot + 1 > end:
            break
        share = weights[s] / total
        assert served[s] - share * slot > -1.5 and served[s] + 1 - share * (slot + 1) < 1.5
        served[s] += 1
    assert all(abs(served[s] - w / total * min(end, resolution)) < 2.5 for s, w in weights.items())


def test_small_parts_take_nothing_from_a_hot_source():
    weights = {f"s{i}": 0.667 / 4999 for i in range(4999)} | {"hot": 0.333}
    assert abs(whole_weights(weights, 20_000)["hot"] / 20_000 - 0.333) < 0.001
    assert sum(whole_weights({f"s{i}": 1e-9 for i in range(50)} | {"hot": 1}, 100).values()) == 100


@pytest.mark.parametrize("n", [1, 20, 5000, 20_001])
@pytest.mark.parametrize("power", [0, 0.5, 1])
def test_less_than_one_block_from_the_given_weights(n, power):
    """Weights are not rounded: windows and lag hold for the fractions that were asked for, with a hot source among many."""
    from trivox.llm.mixing import schedule

    blocks = {f"s{i}": 1 + 40_000 // n + i % 5 for i in range(n - 1)} | {"hot": 20_000}
    weights = {s: b**power for s, b in blocks.items()} | ({"hot": 0.9 * n} if not power else {})
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    turns = schedule(blocks, weights)
    assert Counter(s for s, *_ in turns) == blocks and len({t[-1] for t in turns}) == len(turns)
    last = {s: slot for s, *_, slot in turns}
    end = min(last.values())
    for i, (s, j, release, deadline, slot) in enumerate(turns):
        share = exact[s] / total if i < 2000 else float(exact[s] / total) if i % 97 == 0 else None
        if share is not None:
            if i < 2000:
                assert (release, deadline) == (math.floor(j / share), math.ceil((j + 1) / share))
            if slot <= end:
                assert release <= slot < deadline and abs(j - share * slot) < 1 and abs(j + 1 - share * (slot + 1)) < 1


def test_names_blocks_and_order(spark):
    """Clashing names, as many sources as rows, blocks that grow, and slots that a brute-force schedule gives."""
    from trivox.llm.mixing import schedule

    rows = [(i, f"s{i % 3}" if i < 300 else f"t{i}") for i in range(400)]
    df = spark.createDataFrame([(*r, r[0], r[0], r[0]) for r in rows], ["doc_id", "source", "slot", "a.b", "place"])
    out = mix(df, block=4, scheduled=100).collect()
    assert set(out[0].asDict()) == {"doc_id", "source", "slot_in", "a.b", "place_in", "block", "release", "deadline", "slot", "place", "open_mix"}
    assert all(r["slot_in"] == r["a.b"] == r.doc_id for r in out) and len(out) == 400
    sizes = Counter(s for _, s in rows)
    assert max(r.place for r in out) == 3
    turns = schedule({f"={s}": -(-n // 4) for s, n in sizes.items()}, {f"={s}": n**0.5 for s, n in sizes.items()})
    assert {(f"={r.source}", r.block, r.release, r.deadline, r.slot) for r in out} == set(turns)
    assert max(r.place for r in mix(df, block=4, scheduled=20).collect()) == 19
