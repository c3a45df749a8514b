"""Pairs of texts that share enough of their words: an exact join of sets by Jaccard index, over an inverted index.

Tokens are put in the order of their rarity. Two sets of an index of ``t`` or more share a token among the first
``n - ceil(t n) + 1`` of each, so only those are joined; sizes and places leave few pairs to compare. Equal sets are one
until the end. The result is a list of candidates for a judgement, not a judgement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivox.functions.lineage import cut

#: The index from which a pair is worth a judgement, as a fraction in whole numbers.
LEAST = (3, 10)


def tokens(text: Column) -> Column:
    """The different tokens of a text: runs of a-z and digits, and pairs of neighbouring characters of other scripts, as
    these have no blanks; a lone character is a token. Null has none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    runs = F.filter(F.split(low, r"[^\p{L}\p{N}]+|(?<=[a-z0-9])(?=[^a-z0-9])|(?<=[^a-z0-9])(?=[a-z0-9])"), lambda r: r != "")
    pairs = lambda r: F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2)))
    return F.array_distinct(F.flatten(F.transform(runs, lambda r: F.when(r.rlike("^[a-z0-9]+$"), F.array(r)).otherwise(pairs(r)))))


def _sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, set, t)`` of rows with a token: ``set`` names equal sets, ``t`` are their tokens."""
    found = df.select(F.col(key).alias("id"), F.array_sort(tokens(F.col(text))).alias("t")).where(F.size("t") > 0)
    return found.select("id", F.sha2(F.array_join("t", "\u0001"), 256).alias("set"), "t")


def _bits(seed: int) -> Column:
    """Of a group of tokens, a word of 64 bits with one bit set for each token by its hash."""
    at = F.pmod(F.xxhash64("token", F.lit(seed)), F.lit(64)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at))


def similar_sets(left: DataFrame, right: DataFrame | None = None, least: tuple[int, int] = LEAST, told: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(left_set, right_set, shared, either)`` of all pairs with ``shared / either >= least``, of frames ``(set, t)`` with
    a row for each different set: exact, with nothing left out. Without ``right`` the pairs are those inside ``left``,
    each once, ``left_set`` the smaller name. Where a name holds the tokens, ``told`` reads them from it; there is no ``t``
    then, and nothing is written twice.

    A token that many sets have stands behind their rare ones, so it is joined only where a set has nothing rarer; what
    is still hot is split by the adaptive skew join, since both sides come straight from their shuffles. Sets go by a
    number, and two words of token bits go along: tokens of one side alone are at least as many as the bits in which the
    words differ, so most pairs that share too little are gone before anything is written of them.
    """
    num, den = least
    up = lambda a, b: F.floor((a + b - 1) / b).cast("int")
    kept = ["t"] if told is None else []
    if right is None:
        every = left.select("set", *kept, F.lit(3).alias("sides"))
    else:
        every = left.select("set", *kept, F.lit(1).alias("sides")).unionByName(right.select("set", *kept, F.lit(2).alias("sides")))
        every = every.groupBy("set").agg(*[F.first(k).alias(k) for k in kept], F.bit_or("sides").alias("sides"))
    # the two low bits of a number are the sides that have the set
    every = cut(every.select((F.monotonically_increasing_id() * 4 + F.col("sides")).alias("id"), "set", *kept))
    t = lambda n="": told(F.col(f"{n}set")) if told else F.col(f"{n}t")
    each = every.select("id", F.explode(t()).alias("token"))
    rarity = each.groupBy("token").agg(F.count("*").alias("n"))
    # plain rows are dealt by set; what collect_list would send ahead of that is larger
    ranked = each.join(rarity, "token").select("id", "n", "token").repartition("id").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("r"), _bits(1).alias("x"), _bits(2).alias("y"))
    size = F.size("r")
    indexed = ranked.select("id", size.alias("size"), "x", "y", F.posexplode(F.slice("r", F.lit(1), size - up(num * size, den) + 1)).alias("at", "e")).select("id", "size", "x", "y", "at", "e.token")
    indexed = indexed if right is None else cut(indexed)
    of = lambda df, n: df.toDF(*[f"{n}_{c}" for c in ("id", "size", "x", "y", "at")], "token")
    of_side = lambda n, bit: of(indexed if right is None else indexed.where(F.col("id").bitwiseAND(bit) != 0), n)
    c, l, r, both = F.col, F.col("left_size"), F.col("right_size"), F.col("left_size") + F.col("right_size")
    fits = (num * l <= den * r) & (num * r <= den * l) & ((num + den) * F.least(l - c("left_at"), r - c("right_at")) >= num * both)
    for word in ("x", "y"):
        fits &= (num + den) * (both - F.bit_count(c(f"left_{word}").bitwiseXOR(c(f"right_{word}")))) >= 2 * num * both
    met = of_side("left", 1).join(of_side("right", 2), "token").where(fits)
    pairs = (met.where("left_id < right_id") if right is None else met).select("left_id", "right_id").distinct()
    of = lambda n: every.toDF(*[f"{n}_{c}" for c in every.columns])
    named = pairs.join(of("left"), "left_id").join(of("right"), "right_id")
    counted = named.select("left_set", "right_set", F.size(F.array_intersect(t("left_"), t("right_"))).alias("shared"), (F.size(t("left_")) + F.size(t("right_"))).alias("sizes"))
    made = counted.select("left_set", "right_set", "shared", (F.col("sizes") - F.col("shared")).alias("either")).where(F.col("shared") * den >= F.col("either") * num)
    return made if right is not None else made.select(F.least("left_set", "right_set").alias("left_set"), F.greatest("left_set", "right_set").alias("right_set"), "shared", "either")


def candidates(left: DataFrame, right: DataFrame, key: str, text: str, least: tuple[int, int] = LEAST) -> DataFrame:
    """``(left_id, right_id, shared, either)`` of rows whose texts have a Jaccard index of ``least`` or more.

    Rows without a token meet nothing. Rows with equal sets are compared once and listed each.
    """
    a, b = cut(_sets(left, key, text)), cut(_sets(right, key, text))
    pairs = similar_sets(a.select("set", "t").dropDuplicates(["set"]), b.select("set", "t").dropDuplicates(["set"]), least)
    named = pairs.join(a.select(F.col("set").alias("left_set"), F.col("id").alias("left_id")), "left_set").join(b.select(F.col("set").alias("right_set"), F.col("id").alias("right_id")), "right_set")
    return named.select("left_id", "right_id", "shared", "either")
