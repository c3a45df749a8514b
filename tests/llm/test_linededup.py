import pytest

from trivox.llm.linededup import drop_repeated_windows

SCHEMA = "doc_id long, text string, k string, pos int"


def brute(rows):
    docs = sorted({(d is not None, d or 0, t) for d, t in rows if t is not None})
    seen, covered = {}, {}
    for has, d, t in docs:
        lines = t.split("\n")
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if "".join(w).strip() == "":
                continue
            if w in seen:
                covered.setdefault((has, d, t), set()).update((i, i + 1, i + 2))
            seen.setdefault(w, True)
    return {
        (d, t): t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in covered.get((d is not None, d or 0, t), ()))
        for d, t in rows
    }


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], SCHEMA)
    out = drop_repeated_windows(df)
    assert out.columns == ["doc_id", "text", "k", "pos", "n_lines", "n_removed"]
    return out.collect()


def test_repeats_within_and_across(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "q\nq\nq\nq\nq\nr"), (4, "a\nb"), (5, "\n\n\n\n\nz"), (6, "\n\n\n\n\nz"), (7, "a\nb\nc\nd"), (8, "m\nb\nc\nd\na\nb\nc")]
    got = {(r.doc_id, r.text) for r in run(spark, rows)}
    want = brute(rows)
    assert got == {(d, want[d, t]) for d, t in rows}
    assert (2, "x\ny") in got and (3, "q\nr") in got and (7, "") in got and (4, "a\nb") in got


def test_edges(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (2, None), (3, ""), (4, "a\nb\nc\n"), (5, "long\n" * 3000)]
    got = run(spark, rows)
    want = brute(rows)
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(d), str(want[d, t])) for d, t in rows)
    assert {(r.doc_id, r.n_lines, r.n_removed) for r in got if r.doc_id in (2, 3, 4)} == {(2, 0, 0), (3, 1, 0), (4, 4, 3)}
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", range(2))
def test_random(spark, seed):
    import random

    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))) for i in range(60)]
    want = brute(rows)
    assert {r.doc_id: r.text for r in run(spark, rows)} == {d: want[d, t] for d, t in rows}


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", 5, 6, 7), (2, "a\nb\nc", 5, 6, 7)], ["doc_id", "text", "n_lines", "n_lines_in", "cover.x"])
    out = drop_repeated_windows(df)
    assert out.columns == ["doc_id", "text", "n_lines_in_in", "n_lines_in", "cover.x", "n_lines", "n_removed"]
    assert sorted(map(tuple, out.collect())) == [(1, "a\nb\nc", 5, 6, 7, 3, 0), (2, "", 5, 6, 7, 3, 3)]
