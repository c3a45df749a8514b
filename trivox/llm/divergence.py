"""How sources of a language differ in their terms (operator 13), in whole numbers throughout.

Terms with the same counts in all sources differ by nothing that a comparison of sources can see. So the terms of a
language are grouped by their sparse vector of counts, every pair of sources is evaluated once for each different vector
and the result is multiplied by how many terms have it. The terms themselves are ranked one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trivox.llm.common import cut, sealed, table
from trivox.llm.winnowing import ascii_lower

#: Documents of a language that a kept term is in, at least.
LEAST = 30
#: What is added to each count, and the unit of shares.
ADDED, UNIT = 5, 1_000_000_000
TOP = 50
#: Vectors of a block, counts (vectors times sources) of a block at most, and pairs of sources that one task evaluates.
VECTORS, COUNTS, PAIRS = 1 << 12, 1 << 22, 1 << 20
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``(lang, source, term, n, d)``: occurrences of each term and the documents that have it."""
    terms = F.filter(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), BETWEEN), lambda w: w != "")
    group = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    both = docs.select(*group, terms.alias("w")).select("lang", "source", F.posexplode(F.array("w", F.array_distinct("w"))).alias("once", "w"))
    each = both.select("lang", "source", "once", F.explode("w").alias("term"))
    return each.groupBy("lang", "source", "term").agg(F.count_if(F.col("once") == 0).alias("n"), F.count_if(F.col("once") == 1).alias("d"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + ADDED) / (total + ADDED * terms)), exact for all counts."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = F.lit(UNIT).cast("decimal(10,0)") * wide(count + ADDED)
    return F.lit(1).cast("long") + F.call_function("div", over, wide(total + ADDED * terms))


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``share`` of a matrix (vectors x sources), by three digits at a time so that nothing leaves 64 bits."""
    whole, rest, below = np.zeros_like(counts), counts + ADDED, total + ADDED * terms
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + rest // below
        rest %= below
    return whole + 1


def kept_terms(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, term, vector)`` of the terms in at least ``least`` documents of their language; the vector has an entry
    ``(source, n)`` for each source with the term, in the order of sources."""
    met = counts.groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vector"))
    return met.where(F.col("d") >= least).select("lang", "term", "vector")


def groups(docs: DataFrame, kept: DataFrame, lang: str, source: str) -> DataFrame:
    """``(lang, source, total, terms, lang_total)`` of every occurring group, also of those without a kept term."""
    there = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    sums = kept.select("lang", F.explode("vector").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("total"))
    whole = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(F.aggregate("vector", F.lit(0).cast("long"), lambda a, e: a + e["n"])).alias("lang_total"))
    zero = F.lit(0).cast("long")
    joined = there.join(sums, ["lang", "source"], "left").join(whole, "lang", "left")
    return joined.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])


def pair_sums(kept: DataFrame, found: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` for each pair of sources a < b of a language: the sum of the differences of their shares
    over all kept terms.

    A task has the sources of one language, a block of its different vectors, and some of the rows of pairs; blocks and
    rows follow from the sizes, so that a task is bounded whatever the number of terms or sources.
    """
    each = kept.groupBy("lang", "vector").agg(F.count("*").alias("times"))
    langs = cut(found.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("sources"), F.max("terms").alias("terms")))
    most, width = (x or 0 for x in langs.agg(F.max("terms"), F.max(F.size("sources"))).first())
    blocks = max(1, -(-most // max(1, min(VECTORS, COUNTS // max(1, width)))))
    tiles = max(1, -(-(width**2) // (2 * PAIRS)))
    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = langs.withColumn("block", to_all(blocks)).withColumn("tile", to_all(tiles))
    right = each.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int")).withColumn("tile", to_all(tiles))

    def judge(which: pa.Table, vectors: pa.Table) -> pa.Table:
        out = {"lang": [], "a": [], "b": [], "value": []}
        for lang, listed, terms, tile in zip(*(which.column(c).to_pylist() for c in ("lang", "sources", "terms", "tile")), strict=True):
            names, total = [x["source"] for x in listed], np.array([x["total"] for x in listed], np.int64)
            rows = vectors.column("vector").combine_chunks()
            table = np.zeros((len(rows), len(names)), np.int64)
            if len(rows):
                entries, place = rows.flatten(), np.repeat(np.arange(len(rows)), pc.list_value_length(rows).to_numpy())
                table[place, pc.index_in(entries.field("source"), pa.array(names)).to_numpy()] = entries.field("n").to_numpy()
                table = shares(table, total, terms)
            times = vectors.column("times").to_numpy()[:, None]
            for i in range(tile, len(names) - 1, tiles):
                out["lang"] += [lang] * (len(names) - i - 1)
                out["a"] += [names[i]] * (len(names) - i - 1)
                out["b"] += names[i + 1 :]
                out["value"] += (np.abs(table[:, i + 1 :] - table[:, i : i + 1]) * times).sum(axis=0).tolist()
        return pa.table({c: pa.array(v, pa.int64() if c == "value" else pa.string()) for c, v in out.items()})

    keys = ["lang", "block", "tile"]
    made = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(judge, "lang string, a string, b string, value long")
    return made.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source of a language is from the others, and its terms.

    Terms are runs of letters A-Z, lowered, a-z and characters beyond ASCII; a language keeps those in at least ``least``
    of its documents. A group of documents gives each kept term a share, 1 + floor(10^9 (count + 5) / (N + 5 V)). Part
    ``pair`` has each other source of the language with the sum of differences of shares, 0 without kept terms; part
    ``term`` the ``top`` kept terms that the source has and gives a larger share than the language does, with the
    difference. Ranks go by value, the larger first, then by item as bytes. Null texts, languages and sources are empty;
    rows that repeat count each; a language with one source has no pairs; an empty table gives no rows. Other columns may
    have any name.
    """
    plain, of = sealed(docs)
    names = of(lang), of(source)
    kept = cut(kept_terms(term_counts(plain, of(text), *names), least))
    found = cut(groups(plain, kept, *names))
    two = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pair_sums(kept, found).select("lang", two.alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    count = F.aggregate("vector", F.lit(0).cast("long"), lambda a, e: a + e["n"])
    entries = kept.select("lang", "term", count.alias("all"), F.explode("vector").alias("e")).select("lang", "e.source", "term", "all", "e.n")
    value = share(F.col("n"), F.col("total"), F.col("terms")) - share(F.col("all"), F.col("lang_total"), F.col("terms"))
    over = entries.join(found, ["lang", "source"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")).where("value > 0")
    return _ranked(pairs).unionByName(_ranked(over).where(F.col("rank") <= top))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
o AS (SELECT id, lang, source, unnest(regexp_extract_all(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
p AS (SELECT k.lang, t.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)::HUGEINT) // (t.total::HUGEINT + 5 * v.v) AS p
      FROM k JOIN t USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = k.lang AND c.source = t.source AND c.term = k.term),
l AS (SELECT lang, sum(total) AS total FROM t GROUP BY lang),
q AS (SELECT a.lang, a.term, 1 + (1000000000::HUGEINT * (a.n + 5)::HUGEINT) // (l.total::HUGEINT + 5 * v.v) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) a JOIN l USING (lang) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
            coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
