import numpy as np
import pytest

from trivox.llm.embeddings import allowed_misses, links, near_vectors


def brute(rows, cosine=0.95):
    good = {}
    for i, (_, e) in enumerate(rows):
        if e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            v = np.array(e, np.float64)
            good[i] = v / np.linalg.norm(v)
    near = {i: [j for j in good if j != i and len(good[j]) == len(good[i]) and good[i] @ good[j] >= cosine] if i in good else [] for i in range(len(rows))}
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), c, rows[i][0] == c))
    return out


def made(seed, n, dim, noise):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 4, dim))
    x = np.concatenate((rng.standard_normal((n // 2, dim)), base[rng.integers(0, len(base), n // 2)] + noise * rng.standard_normal((n // 2, dim))))
    return x.astype(np.float32)


@pytest.mark.parametrize(("block", "noise"), [(8192, 0.2), (40, 0.25), (40, 0.02)])
def test_brute_force(spark, block, noise):
    x = made(3, 300, 32, noise)
    rows = [(int(i) * 7 % 301, [float(y) for y in v]) for i, v in enumerate(x)]
    rows += [(400, None), (401, [0.0] * 32), (402, [1.0, None]), (403, [float("nan")] * 32), (404, [float("inf")] * 32), (405, []), (None, rows[0][1]), (406, [1.0, 2.0]), (407, [2.0, 4.0]), rows[5], rows[5]]
    rows += [(500 + i, rows[9][1]) for i in range(30)]
    df = spark.createDataFrame([(k, e, "x", 1) for k, e in rows], "vec_id long, embedding array<float>, node string, n int")
    want = brute([(k, None if e is None else [None if y is None else float(np.float32(y)) for y in e]) for k, e in rows])
    assert sorted(map(str, map(tuple, near_vectors(df, block=block).collect()))) == sorted(map(str, want))


def test_edges(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(df).collect() == []
    bad = spark.createDataFrame([(1, None), (None, [])], "vec_id long, embedding array<float>")
    assert sorted(map(str, map(tuple, near_vectors(bad).collect()))) == ["(1, 0, 1, True)", "(None, 0, None, True)"]


def test_recall_at_the_threshold():
    """Pairs whose cosine is just over the threshold, the hardest ones."""
    rng = np.random.default_rng(0)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((4000, 64))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.9501 * a + np.sqrt(1 - 0.9501**2) * side
    found = {(int(i), int(j)) for x, y in links(a, b, False) for i, j in zip(x, y, strict=True)}
    exact = set(zip(*(x.tolist() for x in np.nonzero(a @ b.T >= 0.95)), strict=True))
    assert found <= exact and len(found) >= 0.999 * len(exact) and allowed_misses(16) < 8


def test_query_against_sql(spark, tmp_path):
    """The given tables have no links, so a table with links, copies and bad vectors is held against the SQL."""
    import duckdb

    from trivox.llm.embeddings import OP8_SQL, op8_embeddings

    rows = [(int(i), [float(y) for y in v]) for i, v in enumerate(made(5, 400, 64, 0.2))]
    rows += [(900, None), (901, [0.0] * 64), (902, [1.0, None]), (903, [float("nan")] * 64), (904, rows[3][1]), (905, rows[399][1])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = duck.execute(OP8_SQL).fetchall()
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in op8_embeddings(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and sum(1 for _, n, *_ in want if n) > 20


def test_keys_of_text(spark):
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.01]), (None, [1.0, 0.02]), ("c", [0.0, 1.0])]
    got = near_vectors(spark.createDataFrame(rows, "vec_id string, embedding array<float>")).collect()
    assert sorted(map(str, map(tuple, got))) == ["('a', 2, 'a', True)", "('b', 2, 'a', False)", "('c', 0, 'c', True)", "(None, 2, 'a', False)"]
