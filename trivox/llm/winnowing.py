"""Benchmark decontamination by winnowing (operator 11), in DataFrame functions only.

A window is ``length`` words in a row. It is made of word k-grams, and its fingerprint is the smallest of their hashes: two
equal windows have equal fingerprints, wherever they stand, so a shared span of ``length`` words is always found.
Consecutive windows with the same fingerprint are one run, and only runs are joined with the benchmark. Runs that meet
are extended to their windows, which are compared by the two k-grams that cover them, 128 bits. What a document shares
is told by sets of items: windows that the same items hold lead to one set, and documents with equal sets to one list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trivox.llm.common import apart, cut, sealed, table

LENGTH = 10
#: Windows of the benchmark up to which they are sent to all executors, 40 bytes each; more are joined by shuffles.
SENT = 1 << 20
#: What separates words: all of ASCII but digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lowered and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def grams(length: int) -> tuple[int, int]:
    """``(k, w)``: words of a k-gram and k-grams of a window; two k-grams cover the window and ``w + k - 1 = length``."""
    k = (length + 1) // 2
    return k, length - k + 1


def runs(hashes: Column, length: int) -> Column:
    """``array<struct<n int, g bigint, s int, x array<bigint>>>``: the runs of windows with one fingerprint ``g``.

    ``s`` is the first window's place and ``x`` the k-grams of all windows of the run, so that ``x[j]`` and
    ``x[j + w - 1]`` are those that cover window ``s + j``. Fewer words than ``length`` have no window.
    """
    k, w = grams(length)
    span = lambda upto: F.sequence(F.lit(0), upto)

    def of_hashes(h: Column) -> Column:
        made = F.transform(span(F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return _bound(made, of_grams)

    def of_grams(g: Column) -> Column:
        least = F.transform(span(F.size(g) - w), lambda i: F.least(*[F.get(g, i + j) for j in range(w)])) if w > 1 else g
        return _bound(F.struct(g.alias("g"), least.alias("m")), of_least)

    def of_least(z: Column) -> Column:
        g, m = z["g"], z["m"]
        firsts = F.filter(span(F.size(m) - 1), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1)))
        return _bound(F.struct(g.alias("g"), m.alias("m"), F.concat(firsts, F.array(F.size(m))).alias("f")), of_firsts)

    def of_firsts(z: Column) -> Column:
        at = lambda j: F.get(z["f"], j)
        return F.transform(
            span(F.size(z["f"]) - 2),
            lambda j: F.struct(F.lit(length).alias("n"), F.get(z["m"], at(j)).alias("g"), at(j).alias("s"), F.slice(z["g"], at(j) + 1, at(j + 1) - at(j) + w - 1).alias("x")),
        )

    none = F.array().cast("array<struct<n:int,g:bigint,s:int,x:array<bigint>>>")
    return _bound(hashes, lambda h: F.when(F.size(h) >= length, of_hashes(h)).otherwise(none))


def windows(found: DataFrame, keep: list[str]) -> DataFrame:
    """``(*keep, n, g, p, a, b)``: the windows of runs ``(*keep, n, g, s, x)``, with their places and covering k-grams."""
    apart_by = F.floor(F.col("n") / 2).cast("int")  # w - 1 for k = ceil(n / 2)
    each = F.transform(F.sequence(F.lit(0), F.size("x") - 1 - apart_by), lambda j: F.struct((F.col("s") + j).alias("p"), F.get("x", j).alias("a"), F.get("x", j + apart_by).alias("b")))
    return found.select(*keep, "n", "g", F.explode(each).alias("w")).select(*keep, "n", "g", "w.p", "w.a", "w.b")


def benchmark_windows(items: DataFrame, item: str, text: str, length: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """``(windows, sets, lengths)`` of a benchmark.

    ``windows(n, g, a, b, sid)`` has each different window once with the id of the set of items that hold it,
    ``sets(sid, item)`` the items of each set; ``lengths`` are those of windows, at most ``length`` different ones.
    """
    each = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("h"))
    each = each.withColumn("len", F.least(F.size("h"), F.lit(length))).where("len > 0")
    lengths = sorted(r["len"] for r in each.select("len").distinct().collect())
    by_length = F.lit(None).cast("array<struct<n:int,g:bigint,s:int,x:array<bigint>>>")
    for n in lengths:
        by_length = F.when(F.col("len") == n, runs(F.col("h"), n)).otherwise(by_length)
    held = windows(each.select("item", F.explode(by_length).alias("r")).select("item", "r.*"), ["item"]).select("n", "g", "a", "b", "item").distinct()
    one, two = F.xxhash64("item").cast("decimal(38,0)"), F.xxhash64("item", F.lit(1)).cast("decimal(38,0)")
    made = held.groupBy("n", "g", "a", "b").agg(F.xxhash64(F.sum(one), F.sum(two), F.count("*")).alias("sid"))
    # the items of a set are those of any of its windows
    chosen = made.groupBy("sid").agg(F.min(F.struct("n", "g", "a", "b")).alias("w")).select("sid", "w.*")
    return made, chosen.join(held, ["n", "g", "a", "b"]).select("sid", "item"), lengths


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", length: int = LENGTH) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    Words are runs of digits, a-z (A-Z lowered) and characters beyond ASCII. A window of an item is ``length`` words in a
    row, or the whole of an item with fewer; an item without words has none. ``n_hit`` counts the words of the document
    inside any occurrence of a window, ``n_items`` the items with one; the hash is that of their ids, sorted as strings
    and joined by commas. Rows of the benchmark with equal ids are one item, a null id reads as empty. Null and empty
    texts have no words. Rows of ``docs`` that repeat, and null keys, are judged each like any other; a column with an
    added name gets ``_in`` behind it, other names do not matter. Empty tables give no hits or no rows.
    """
    known, sets, lengths = benchmark_windows(items, item, item_text, length)
    # a bound that is looked at: a benchmark beyond it is written and joined by shuffles, whose hot keys can be split
    small = known.count() <= SENT
    known, send = (known, F.broadcast) if small else (cut(known), lambda df: df)
    plain, of = sealed(docs)
    own = F.col(of(text))
    named = plain.select(F.col(of(key)).alias("k"), F.xxhash64(own).alias("th"), own.alias("t"))
    every = F.concat(*[runs(F.col("h"), n) for n in lengths]) if lengths else F.array().cast("array<struct<n:int,g:bigint,s:int,x:array<bigint>>>")
    found = named.select("k", "th", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("h")).select("k", "th", F.explode(every).alias("r")).select("k", "th", "r.*")
    met = found.join(send(known.select("n", "g")), ["n", "g"], "left_semi")
    hits = cut(windows(met, ["k", "th"]).join(send(known), ["n", "g", "a", "b"]).select("k", "th", "p", "n", "sid"))

    before = F.max("e").over(Window.partitionBy("k", "th").orderBy("p", "e").rowsBetween(Window.unboundedPreceding, -1))
    places = hits.select("k", "th", "p", (F.col("p") + F.col("n")).alias("e")).distinct().withColumn("u", before)
    n_hit = places.groupBy("k", "th").agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("p", F.coalesce("u", F.lit(0))))).alias("n_hit"))
    mine = hits.groupBy("k", "th").agg(F.array_sort(F.collect_set("sid")).alias("sids"))
    mine = mine.withColumn("sig", F.sha2(F.array_join(F.transform("sids", lambda x: x.cast("string")), ","), 256))
    lists = mine.groupBy("sig").agg(F.first("sids").alias("sids")).select("sig", F.explode("sids").alias("sid")).join(sets, "sid").groupBy("sig").agg(F.array_sort(F.collect_set("item")).alias("items"))
    told = lists.select("sig", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("sha"))
    result = n_hit.join(mine.select("k", "th", "sig"), (n_hit["k"].eqNullSafe(mine["k"])) & (n_hit["th"] == mine["th"])).select(n_hit["k"], n_hit["th"], "n_hit", "sig").join(told, "sig")

    side = plain.withColumn("__th", F.xxhash64(own)).withColumn("__n", F.size(words(own)).cast("long"))
    joined = side.join(result, F.col(of(key)).eqNullSafe(F.col("k")) & (F.col("__th") == F.col("th")), "left")
    zero = F.lit(0).cast("long")
    made = joined.select(*plain.columns, "__n", F.coalesce("n_hit", zero), F.coalesce("n_items", zero), F.coalesce("sha", F.sha2(F.lit(""), 256)), F.col("n_hit").isNotNull())
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return made.toDF(*apart(docs.columns, added), *added)


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return made.drop("text")


OP11_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
        FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT n, item_id, array_to_string(w[p:p + n - 1], ' ') AS x
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS x
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
hit AS (SELECT doc_id, p, n, item_id FROM dw JOIN iw USING (n, x)),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
