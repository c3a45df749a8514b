"""How five filters overlap (operator 12): what each removes in every order, and its Shapley share.

Each document fails a set of filters, a mask of five bits. The masks are counted for each source, and from those counts
comes the removal polynomial: the multilinear extension of "documents that the chosen filters remove". Its values at the
corners of the cube tell what is left after any step of any order; its partial derivative, integrated along the diagonal
in exact rationals, is the Shapley share of a filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trivox.llm.common import cut, sealed, table

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Parts that rows without a key are dealt to.
SPREAD = 1024
SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 0 to 3; null is empty."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, r"[ \t-\r]+"), lambda w: w != "")
    capitals = F.char_length(whole) - F.char_length(F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))

    def bits(w: Column) -> Column:
        conditions = [
            F.size(w) < 50,
            100 * F.size(F.array_distinct(w)).cast("long") < 65 * F.size(w).cast("long"),
            100 * capitals.cast("long") > 5 * F.char_length(whole).cast("long"),
            whole.rlike(r"[#$%&*|]"),
        ]
        return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))

    return F.get(F.transform(F.array(words), bits), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by source and the filters that they fail, and the labelled ones.

    Filter E, bit 4, is failed by a text that a smaller key has as well, anywhere in the table. Equal texts are met by
    their SHA-256, counted by part and label before they meet, so a text that a third of all rows have is a few rows.
    A null key is neither smaller nor larger than others, so it does not fail E; it has no labels.
    """
    plain, of = sealed(docs)
    whole = F.coalesce(F.col(of(text)), F.lit(""))
    digest = F.unhex(F.sha2(whole, 256))
    flagged = plain.select(F.col(of(key)).alias("k"), F.coalesce(F.col(of(source)), F.lit("")).alias("part"), digest.alias("h"), failures(F.col(of(text))).alias("bits"))
    # rows without a key are dealt out, as they would all meet in one task
    flagged = flagged.withColumn("z", F.when(F.col("k").isNull(), 1 + F.pmod(F.xxhash64("h"), F.lit(SPREAD))).otherwise(F.lit(0)).cast("long"))
    is_one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).cast("boolean").alias(c)
    known = cut(labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(is_one("quality"), is_one("toxic")).withColumn("z", F.lit(0).cast("long")))
    no = F.lit(False)
    joined = flagged.join(known, ["k", "z"], "left").select("k", "part", "h", "bits", F.coalesce("quality", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    kind = ["h", "part", "bits", "good", "toxic"]
    once = joined.groupBy(*kind, "k").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("k").isNotNull(), F.struct("k", "n")))
    nulls = F.sum(F.when(F.col("k").isNull(), F.col("n")).otherwise(0))
    by_text = once.groupBy(*kind).agg(F.sum("n").alias("n"), least.alias("low"), nulls.alias("nulls"))
    by_text = by_text.withColumn("first", F.min("low.k").over(Window.partitionBy("h")))
    passing = F.col("nulls") + F.when(F.col("low.k") == F.col("first"), F.col("low.n")).otherwise(0)
    two = F.array(F.struct(F.col("bits").alias("mask"), passing.alias("n")), F.struct((F.col("bits") + 16).alias("mask"), (F.col("n") - passing).alias("n")))
    each = by_text.select("part", "good", "toxic", F.explode(two).alias("e")).select("part", "good", "toxic", "e.*")
    of_those = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return each.groupBy("part", "mask").agg(F.sum("n").alias("n"), of_those("good"), of_those("toxic"))


def polynomial(counts: list[int]) -> list[int]:
    """The removal polynomial of mask counts: the coefficient of each product of variables, by the product's mask.

    A document that fails M is removed with 1 - prod(1 - x_i for i in M), where x_i is the chance that filter i is on.
    """
    coefficients = []
    for product in range(ALL + 1):
        above = sum(n for mask, n in enumerate(counts) if mask & product == product)
        coefficients.append(0 if not product else above if product.bit_count() % 2 else -above)
    return coefficients


def corner(coefficients: list[int], on: int) -> int:
    """The polynomial where the filters of ``on`` are 1 and the others 0: how many documents they remove."""
    return sum(c for product, c in enumerate(coefficients) if product & on == product)


def shapley(coefficients: list[int], i: int) -> Fraction:
    """The integral over t of the partial derivative by x_i where all variables are t: a product of m variables with x_i
    among them gives the integral of t^(m-1), 1/m."""
    return sum((Fraction(c, product.bit_count()) for product, c in enumerate(coefficients) if product >> i & 1), Fraction(0))


def audited(part: str, counts: list[int], good: list[int], toxic: list[int]) -> Iterator[tuple]:
    """The rows of one part, of its counts by mask: one for each order and step."""
    whole, total = [polynomial(c) for c in (counts, good, toxic)], sum(counts)
    gone = [[corner(p, on) for on in range(ALL + 1)] for p in whole]
    scaled = [shapley(whole[0], i) * len(ORDERS) for i in range(len(FILTERS))]
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            i = FILTERS.index(letter)
            after = before | 1 << i
            removed, good_lost, toxic_lost = (g[after] - g[before] for g in gone)
            yield part, order, step, total - gone[0][after], removed, gone[0][1 << i] - removed, counts[1 << i], good_lost, toxic_lost, int(scaled[i])
            before = after


def interaction(counts: DataFrame) -> DataFrame:
    """One row for each part, order and step of ``counts(part, mask, n, good, toxic)``; a part has 32 masks at most."""
    rows = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by = {c: [0] * (ALL + 1) for c in ("n", "good", "toxic")}
                for x in found:
                    for c, line in by.items():
                        line[x["mask"]] = x[c]
                columns = zip(*audited(part, *by.values()), strict=True)
                kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return rows.mapInArrow(work, SCHEMA)


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per source, order of the five filters and step, zeros included.

    Failure: A under 50 words; B fewer than 65 different words in 100; C over 5 capitals A-Z in 100 code points; D any of
    ``#$%&*|``; E a text that a smaller key has too, removed or not. ``removed`` counts the documents of the part that go
    at the step, ``kept`` those left after it, ``redundant`` those that fail its filter and went earlier,
    ``unique_fails`` those that fail no other; ``good_lost`` and ``toxic_lost`` the labelled ones that go at the step;
    ``shapley`` is what the filter removes, summed over all orders. Null texts and sources are empty. Labels that repeat
    for a key count if any says so. Rows that repeat count each and, having equal keys, do not fail E by one another. An
    empty table gives no rows; other columns may have any name.
    """
    return interaction(mask_counts(docs, labels, key, text, source))


def op12_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda v: v <> '') AS l FROM documents),
f AS (SELECT part, (len(l) < 50)::INT + 2 * (100 * len(list_distinct(l)) < 65 * len(l))::INT
        + 4 * (100 * (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) > 5 * length(x))::INT
        + 8 * regexp_matches(x, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false)::INT AS mask,
        coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad FROM w LEFT JOIN labels USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad FROM f GROUP BY part, mask),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS own,
        list_sum(list_transform(range(1, step), lambda j: 1 << (ascii(filter_order[j]) - 65))) AS earlier
      FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
r AS (SELECT part, filter_order, step, own,
        sum(n) FILTER (WHERE mask & (coalesce(earlier, 0)::INT | own) = 0) AS kept,
        sum(n) FILTER (WHERE mask & coalesce(earlier, 0)::INT = 0 AND mask & own > 0) AS removed,
        sum(n) FILTER (WHERE mask & coalesce(earlier, 0)::INT > 0 AND mask & own > 0) AS redundant,
        sum(n) FILTER (WHERE mask = own) AS unique_fails,
        sum(good) FILTER (WHERE mask & coalesce(earlier, 0)::INT = 0 AND mask & own > 0) AS good_lost,
        sum(bad) FILTER (WHERE mask & coalesce(earlier, 0)::INT = 0 AND mask & own > 0) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley FROM r
"""
