import hashlib

import duckdb
import pytest

import corpus_pipeline as cp
from trivox.llm import bpe, langid

D = "/root/testdata/sf0.001"


def brute_lines(rows):
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: r[0]):
        lines, gone = r[1].split("\n"), set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if "".join(w).strip():
                if w in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(w)
        out[r[0]] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def brute_groups(texts):
    """The smallest id of each group of texts linked by a Jaccard index of 0.8 or more over five words."""
    words = {d: t.encode().lower().split() for d, t in texts.items()}
    sets = {d: {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in words.items()}
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and label[i] != label[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {i for i, x in label.items() if i == x}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    names = docs.columns
    rows = duckdb.sql(f"select doc_id, text from '{D}/documents.parquet'").fetchall()
    for _, f in cp.STAGES[:4]:
        profiles = langid.learn(docs) if f is cp.keep_known_languages else None
        made = f(spark, docs, D)
        docs = spark.createDataFrame(made.collect(), made.schema)
        assert docs.columns == names
        got = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(got)
        if f is cp.keep_known_languages:
            rows = [r for r in rows if profiles.closest(r[1])[0] != "und" and profiles.closest(r[1])[1] >= langid.REJECT]
            want = dict(rows)
        elif f is cp.drop_repeated_lines:
            want = brute_lines(rows)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif f is cp.drop_near_duplicates:
            want = {i: want[i] for i in brute_groups(want)}
        assert got == want
    last = {r.doc_id: r for r in cp.encode_texts(spark, docs, D).collect()}
    assert last.keys() == want.keys()
    for i, t in want.items():
        ids = [x for w in bpe.pretokens(t) for x in bpe.vocabulary().encode(w.encode())]
        assert last[i].ids == ids and last[i].n_tokens == len(ids) and last[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_run(spark):
    out = cp.run(spark, D)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and 100 < out.count() <= 200


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "a b\nc\nd", "en", None, 7), (2, "a b\nc\nd", "en", "s", 7), (2, "a b\nc\nd", "en", "s", 7), (3, "", None, "s", 0), (4, "ab cd " * 20000, "en", "t", 1)]])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, f in cp.STAGES:
        made = f(spark, docs, D)
        docs = spark.createDataFrame(made.collect(), made.schema)
    got = sorted(str(r.doc_id) for r in docs.collect())
    assert got == (["2", "4", "None"] if rows else [])


def test_near_copies_of_the_stage(spark):
    """The third stage against a Jaccard index of 0.8 over five words, by brute force."""
    docs = cp.drop_repeated_lines(spark, spark.read.parquet(f"{D}/documents.parquet"), D)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = brute_groups(texts)
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, docs, D).collect()} == want and len(want) < len(texts)


ODD = ["n_lines", "n_removed", "slot", "place", "block", "release", "open_mix", "a.b", "k", "h", "s", "node", "__0", "cover"]


def test_clashing_names_and_the_order_of_the_mix(spark, tmp_path):
    """Columns with the names that stages use, through all of them as ``run`` reads and writes them; the result has the
    rows in the order that the mix gives, and nothing but near copies and rejected rows is lost."""
    from pyspark.sql import functions as F

    from trivox.llm.mixing import mix

    docs = spark.read.parquet(f"{D}/documents.parquet")
    docs = docs.select("*", *[F.col("doc_id").alias(n) for n in ODD])
    for name, f in cp.STAGES:
        names = docs.columns
        made = f(spark, docs, D)
        assert name == "bpe" or made.columns == names
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert docs.where("`a.b` <> doc_id or slot <> doc_id or node <> doc_id").isEmpty()
    kept = spark.read.parquet(str(tmp_path / "near_dedup")).select("doc_id", "source")
    want = [r.doc_id for r in mix(kept).orderBy("slot", "place").collect()]
    place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    assert [r.doc_id for r in docs.select("doc_id", *place).orderBy("file_name", "row_index").collect()] == want and len(want) > 100


def test_run_goes_on_where_it_was_broken_off(spark, monkeypatch):
    def broken(*_):
        raise RuntimeError("lost")

    whole, stages = sorted(map(tuple, cp.run(spark, D).select("doc_id", "n_tokens").collect())), list(cp.STAGES)
    monkeypatch.setattr(cp, "STAGES", [*stages[:3], ("mixing", broken), stages[4]])
    with pytest.raises(RuntimeError):
        cp.run(spark, D, "again")
    monkeypatch.setattr(cp, "STAGES", [(n, broken) for n, _ in stages[:3]] + stages[3:])
    assert sorted(map(tuple, cp.run(spark, D, "again").select("doc_id", "n_tokens").collect())) == whole


def test_equal_ids_of_different_texts(spark):
    """Each text of an id is judged by itself; nothing but copies goes."""
    from trivox.llm.simhash import representatives

    rows = [(5, "alpha beta gamma"), (2, "X"), (5, "X"), (7, "zeta eta"), (7, "other text"), (7, "other text")]
    kept = representatives(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, h int"))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "X"), (5, "alpha beta gamma"), (7, "other text"), (7, "zeta eta")]


def test_stages_beside_near_dedup(spark):
    """The stages that the Jaccard index does not touch, each against brute force on its own input."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    profiles = langid.learn(docs)
    least = langid.bounds(docs, profiles)
    said = {i: profiles.measured(t) for i, t in rows}
    want = {i: t for i, t in rows if said[i][0] != "und" and said[i][1] >= least[said[i][2]]}
    assert {r.doc_id: r.text for r in cp.keep_known_languages(spark, docs, D).collect()} == want
    lines = brute_lines(rows)
    made = cp.drop_repeated_lines(spark, docs, D).collect()
    assert {r.doc_id: r.text for r in made} == lines and all(r.n_chars == len(r.text) for r in made)
    mixed = cp.mix_sources(spark, docs, D)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, docs.collect()))
    last = {r.doc_id: r for r in cp.encode_texts(spark, docs, D).collect()}
    assert last.keys() == dict(rows).keys()
    for i, t in rows:
        ids = [x for w in bpe.pretokens(t) for x in bpe.vocabulary().encode(w.encode())]
        assert last[i].ids == ids and last[i].n_tokens == len(ids) and last[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
