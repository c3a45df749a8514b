"""Removal of repeated three-line windows (operator 6), in DataFrame functions only.

Every document gives its overlapping windows of three consecutive lines as two 64-bit hashes and a position. An
aggregation finds the windows that occur again anywhere, with their first place; a join marks the later places; their
positions merge into covered intervals per document, and the text is put together from the slices between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trivox.llm.common import apart, sealed, table

LINES = 3


def _windows(docs: DataFrame, lines: int) -> DataFrame:
    """``(k, th, pos, h1, h2)``: each window's document, place (from 0) and hashes. All-blank windows do not count."""

    def at(i: Column, j: int) -> Column:
        return F.get("l", i + j)

    parts = docs.select("k", "th", F.split("t", "\n", -1).alias("l")).where(F.size("l") >= lines)
    places = F.sequence(F.lit(0), F.size("l") - lines)
    hashed = F.transform(
        places,
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(*[at(i, j) for j in range(lines)]).alias("h1"),
            F.xxhash64(*[at(i, j) for j in reversed(range(lines))], F.lit(lines)).alias("h2"),
            F.concat(*[at(i, j) for j in range(lines)]).rlike(r"\S").alias("some"),
        ),
    )
    return parts.select("k", "th", F.explode(hashed).alias("w")).where("w.some").select("k", "th", "w.pos", "w.h1", "w.h2")


def covered(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``(k, th, cover)`` for documents with something to remove: sorted, disjoint line intervals ``(s, e)``."""
    windows = _windows(docs, lines)
    place = F.struct("k", "th", "pos")
    first = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    later = windows.join(first, ["h1", "h2"]).where(place > F.col("first")).select("k", "th", "pos")
    by_doc = Window.partitionBy("k", "th").orderBy("pos")
    opens = F.coalesce((F.col("pos") > F.lag("pos").over(by_doc) + lines).cast("int"), F.lit(1))
    islands = later.withColumn("opens", opens).withColumn("island", F.sum("opens").over(by_doc))
    spans = islands.groupBy("k", "th", "island").agg(F.min("pos").alias("s"), (F.max("pos") + lines - 1).alias("e"))
    return spans.groupBy("k", "th").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("cover"))


def drop_repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", lines: int = LINES) -> DataFrame:
    """All rows and columns of ``docs`` with later occurrences of repeated windows taken out of ``text``.

    Lines end at ``\\n`` and count as they stand. A window's first occurrence is that with the smallest (key, text hash,
    position); every line that a later one covers goes, whether in the same document or in another. Texts of fewer than
    three lines and null texts stay as they are, and a text that is covered whole becomes empty. Rows that repeat in key
    and text are one document, so they do not remove each other. Two columns follow: ``n_lines`` and ``n_removed``; a
    column of ``docs`` with such a name gets ``_in`` behind it, other names do not matter. An empty table gives no rows.
    """
    plain, of = sealed(docs)
    own, hashed = of(text), F.xxhash64(of(text))
    keyed = plain.select(F.col(of(key)).alias("k"), hashed.alias("th"), F.col(own).alias("t"))
    cover = covered(keyed.where(F.col("t").isNotNull()), lines)
    joined = plain.join(cover, F.col(of(key)).eqNullSafe(F.col("k")) & (hashed == F.col("th")), "left")
    split, cuts = F.split(F.col(own), "\n", -1), F.col("cover")

    def before(j: Column) -> Column:
        """The slice of lines between interval j - 1 and interval j."""
        start = F.when(j == 0, F.lit(0)).otherwise(F.get(cuts, j - 1)["e"] + 1)
        end = F.when(j == F.size(cuts), F.size(split)).otherwise(F.get(cuts, j)["s"])
        return F.slice("lines", start + 1, end - start)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts)), before)), "\n")
    removed = F.aggregate(cuts, F.lit(0), lambda n, c: n + c["e"] - c["s"] + 1)
    made = joined.withColumn("lines", split).select(
        *[F.when(cuts.isNull(), F.col(own)).otherwise(kept).alias(n) if n == own else n for n in plain.columns],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long"), F.coalesce(removed, F.lit(0)).cast("long"),
    )
    added = ["n_lines", "n_removed"]
    return made.toDF(*apart(docs.columns, added), *added)


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS pos FROM d WHERE len(l) >= 3),
k AS (SELECT doc_id, pos, l[pos] || chr(10) || l[pos + 1] || chr(10) || l[pos + 2] AS window_text FROM w),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY window_text ORDER BY doc_id, pos) AS n
      FROM k WHERE regexp_matches(window_text, '[^ \t-\r]')),
c AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM r WHERE n > 1),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d)
SELECT x.doc_id AS doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY x.pos) FILTER (WHERE c.pos IS NULL), '') AS text,
       count(*) AS n_lines, count(c.pos) AS n_removed
FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.pos = x.pos GROUP BY x.doc_id
"""
