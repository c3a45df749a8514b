"""Document fingerprints from closed syncmers (operator 9), in DataFrame functions only.

A text is cut into units by one rule for all: up to six characters of a word, or one character of a script that has no
blanks. Units are hashed; a k-mer is k units in a row and an s-mer s units. A k-mer is an anchor if the smallest of its
s-mer hashes is the first or the last one, which depends on nothing outside of it: the same passage has the same anchors
wherever it stands. The beginning of a text, where there are no k units yet, has an anchor for each of its first units, so
that short texts have some as well. A fingerprint has all anchors with their positions. Two fingerprints are matched by
position: an anchor counts with the one before it, if both texts have the two at the same distance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from trivox.llm.common import cut, sealed, table

K = 8
S = 3
#: A unit: one character of scripts without blanks (from U+2E80 on, Thai and Lao), else up to six of a word.
UNIT = r"[^ \t-\r\x{E00}-\x{EFF}\x{2E80}-\x{10FFFF}]{1,6}|[^ \t-\r]"
#: Documents in a range of neighbours, and the most ranges.
RANGE_ROWS = 4096
MAX_RANGES = 100_000
_LOW = 0xFFFFFFFF


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """``array<struct<pos int, hash bigint>>``: the anchors of a text, by the place of their last unit.

    The first k - 1 anchors are those of the text's beginning, of one unit, of two and so on. A text without units, or null,
    has none.
    """
    if not 0 < s < k:
        raise ValueError("an s-mer must be shorter than a k-mer")
    inner = k - s
    # s-mers that cover the k-mer
    over = [*range(0, inner, s), inner]

    def of_units(h: Column) -> Column:
        smers = F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)])) if s > 1 else h
        first = F.transform(F.sequence(F.lit(0), F.least(F.size(h), F.lit(k - 1)) - 1), lambda i: F.struct(i.alias("pos"), F.xxhash64(i, *[F.get(h, F.when(i >= j, F.lit(j))) for j in range(k - 1)]).alias("hash")))
        whole = F.when(F.size(h) >= k, F.concat(first, _bound(smers, of_smers))).otherwise(first)
        return F.when(F.size(h) > 0, whole).otherwise(F.slice(F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).cast("long").alias("hash"))), 1, 0))

    def of_smers(m: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(m) - inner - 1)
        edge = lambda i: F.least(F.get(m, i), F.get(m, i + inner))
        inside = lambda i: F.least(*[F.get(m, i + j) for j in range(1, inner)], F.lit(2**63 - 1))
        chosen = F.filter(places, lambda i: edge(i) <= inside(i)) if inner > 1 else places
        return F.transform(chosen, lambda i: F.struct((i + (k - 1)).alias("pos"), F.xxhash64(*[F.get(m, i + j) for j in over]).alias("hash")))

    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))
    return _bound(F.transform(units, lambda u: F.xxhash64(u)), of_units)


def fingerprint(text: Column, k: int = K, s: int = S) -> Column:
    """All anchors of a text in their order, each as a long: its distance from the one before (the first one's from the
    start) in the high half, 32 bits of its hash in the low one. A text without units, or null, has none."""

    def coded(found: Column) -> Column:
        at = lambda i: F.get(found, i)["pos"]
        low = lambda i: F.get(found, i)["hash"].bitwiseAND(F.lit(_LOW))
        gap = lambda i: (at(i) - F.when(i > 0, at(i - 1)).otherwise(0)).cast("long")
        codes = F.transform(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.shiftleft(gap(i), 32).bitwiseOR(low(i)))
        return F.when(F.size(found) > 0, codes).otherwise(F.array().cast("array<long>"))

    return _bound(anchors(text, k, s), coded)


def printed(made: Column, k: int = K) -> Column:
    """A fingerprint as text: for each anchor its distance, in as many hex digits as k has, and eight of its hash."""
    wide = len(f"{k:x}") + 8
    return F.array_join(F.transform(made, lambda x: F.lpad(F.lower(F.hex(x)), wide, "0")), "")


def steps(made: Column) -> Column:
    """The distinct steps of a fingerprint: a hash of an anchor, the one before it, none before the first, and their
    distance."""

    def of(codes: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(codes, i - 1).bitwiseAND(F.lit(_LOW))).otherwise(F.lit(-1).cast("long"))
        found = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(codes) - 1), lambda i: F.xxhash64(before(i), F.get(codes, i))))
        return F.when(F.size(codes) > 0, found).otherwise(F.array().cast("array<long>"))

    return _bound(made, of)


def likeness(a: Column, b: Column) -> Column:
    """Twice the steps that two arrays of steps share, over the steps of both: 1 for equal texts and about 2/3 where
    two thirds are equal. Two empty ones are alike, an empty and another are not."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def _ranged(docs: DataFrame, key: str, range_rows: int) -> DataFrame:
    """``docs`` with ``__at``: ranges of the key in its order, and of ``__order`` below all for rows with a null key."""
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col(key).isNull())).first()
    ranges, pieces = (max(1, min(MAX_RANGES, -(-x // range_rows))) for x in (n, nulls))
    low = (-1 - F.least(F.floor((F.col("__order").cast("double") / 2.0**64 + 0.5) * pieces), F.lit(pieces - 1))).cast("int")
    if not isinstance(docs.schema[key].dataType, NumericType):
        dealt = docs.repartitionByRange(ranges, F.col(key).asc_nulls_first(), F.col("__order").desc())
        # kept, as another run might cut the ranges elsewhere
        return cut(dealt.withColumn("__at", F.when(F.col(key).isNull(), low).otherwise(F.spark_partition_id())))
    parts = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx(F.col(key), parts, max(10_000, 10 * ranges)).alias("b")).first()["b"] if parts else None
    bounds = sorted(set(map(float, bounds or [])))
    if not bounds:
        return docs.withColumn("__at", F.when(F.col(key).isNull(), low).otherwise(F.lit(0)))
    from pyspark.ml.feature import Bucketizer

    # by binary search
    find = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="__key", outputCol="__at", handleInvalid="keep")
    at = find.transform(docs.withColumn("__key", F.col(key).cast("double"))).drop("__key")
    return at.withColumn("__at", F.when(F.col(key).isNull(), low).otherwise(F.col("__at").cast("int")))


def with_next(docs: DataFrame, key: str, values: list[str], range_rows: int = RANGE_ROWS, made: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``docs`` with ``next_<value>`` of the row that follows in descending order of ``key``; the first follows the last.

    Rows with equal keys go by ``__order``, null keys last. The keys are cut into ranges at quantiles, null ones into equal
    parts of ``__order``, so one sort and one shuffle of the rows serve; the first row of each range is also sent to the
    range above, where it ends the order. ``made`` adds columns when the rows have moved.
    """
    kind, at = docs.schema[key].dataType.simpleString(), _ranged(docs, key, range_rows)
    # a row for each range
    heads = sorted(at.groupBy("__at").agg(F.max(key).alias("m"), F.min("__order").alias("o")).collect(), key=lambda r: r["__at"])
    above = [*[r["__at"] for r in heads[1:]], heads[0]["__at"]] if heads else []
    order_kind = docs.schema["__order"].dataType.simpleString()
    tops = docs.sparkSession.createDataFrame([(r["__at"], r["m"], r["o"], up) for r, up in zip(heads, above, strict=True)], f"__a int, __m {kind}, __o {order_kind}, __up int")
    is_top = F.when(F.col(key).isNull(), F.col("__order") == F.col("__o")).otherwise(F.col(key) == F.col("__m"))
    sent = at.join(F.broadcast(tops), (F.col("__at") == F.col("__a")) & is_top, "left")
    here, guest = F.struct(F.col("__at").alias("to"), F.lit(False).alias("guest")), F.struct(F.col("__up").alias("to"), F.lit(True).alias("guest"))
    rows = sent.withColumn("__e", F.explode(F.when(F.col("__up").isNull(), F.array(here)).otherwise(F.array(here, guest))))
    rows = rows.select(*docs.columns, F.col("__e.to").alias("__to"), F.col("__e.guest").alias("__guest")).repartition("__to")
    rows = made(rows) if made else rows
    columns = [c for c in rows.columns if c not in ("__to", "__guest")]
    order = Window.partitionBy("__to").orderBy("__guest", F.desc_nulls_last(key), "__order")
    led = rows.select("*", *[F.lead(v).over(order).alias(f"next_{v}") for v in values])
    return led.where("not __guest").select(*columns, *[f"next_{v}" for v in values])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for each row.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next row's
    text, in descending order of the key (rows with equal keys by text hash, null keys last; the first row follows the
    last, so a single row follows itself). Null texts are empty. Rows that repeat have a row each; columns of any name
    are left out. An empty table gives no rows.
    """
    plain, of = sealed(docs)
    own = plain.select(F.col(of(key)).alias("__k"), F.coalesce(F.col(of(text)), F.lit("")).alias("__t"))
    own = own.withColumn("__order", F.xxhash64("__t"))
    led = with_next(own, "__k", ["__t", "__s"], made=lambda rows: rows.withColumn("__s", fingerprint(F.col("__t"), k, s)))
    n = F.char_length("__t").cast("long")
    take = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("__t", F.lit(1), (n - take).cast("int")), F.substring("next___t", F.lit(1), take))
    rows = led.select("__k", n.alias("n_chars"), edited.alias("__e"), "__s", steps(F.col("__s")).alias("__a"), steps(F.col("next___s")).alias("__n"))
    rows = rows.withColumn("__es", fingerprint(F.col("__e"), k, s))
    return rows.select(
        F.col("__k").alias(key), "n_chars", F.sha2("__e", 256).alias("edited_sha256"), printed(F.col("__s"), k).alias("fingerprint"), printed(F.col("__es"), k).alias("edited_fingerprint"),
        likeness(F.col("__a"), steps(F.col("__es"))).alias("near_edited"), likeness(F.col("__a"), F.col("__n")).alias("near_next"),
    )


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
