"""Mixing sources to target weights by Pfair scheduling (operator 10).

A source with weight w, its share of all weights, releases its block j (from 0) at floor(j / w), due at ceil((j + 1) / w),
in slots of one block. Serving the released block with the earliest deadline keeps every source within one block of its
share at any time. Weights are taken as they are, in exact whole numbers, not rounded to a period. The driver works the
schedule out; blocks grow with the rows, so it has ``SCHEDULED`` blocks and one for each source at most.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trivox.llm.common import apart, sealed, table

#: Slots of a period at least, where weights are rounded to parts of one.
RESOLUTION = 10_000
#: Parts that a period has at most for the sake of a very small weight.
FINEST = 250_000
#: Documents in a block, unless that makes more than ``SCHEDULED`` blocks.
BLOCK = 32
SCHEDULED = 200_000
#: Rows of a schedule or a table of sources that are broadcast at most.
_SENT = 500_000
#: Slots are longs; behind this one blocks follow each other as they are released.
_LAST = 1 << 62
#: Rows in a range of the order hash, about and at most twice as many: ranges are counted and numbered apart.
RANGE_ROWS = 1024
#: Ranges that are summed together first.
_GROUPED = 256


def whole_weights(weights: Mapping[str, float], resolution: int = RESOLUTION) -> dict[str, int]:
    """Positive whole parts of ``resolution`` in proportion to ``weights``: largest remainders, ties by name.

    Only parts that would be none are raised to one, at the cost of the largest parts.
    """
    if not weights:
        return {}
    if len(weights) > resolution:
        raise ValueError(f"{len(weights)} sources need a resolution of as many parts at least")
    if min(weights.values()) <= 0:
        raise ValueError("target weights must be positive")
    total = sum(weights.values())
    exact = {s: w / total * resolution for s, w in weights.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    spare = resolution - sum(parts.values())
    for s in sorted(exact, key=lambda s: (parts[s] - exact[s], s))[: max(0, spare)]:
        parts[s] += 1
    while spare < 0:
        large = [s for s in sorted(parts, key=lambda s: (exact[s] - parts[s], s)) if parts[s] > 1][:-spare]
        for s in large:
            parts[s] -= 1
        spare += len(large)
    return parts


def fine_resolution(weights: Mapping[str, float], rows: Mapping[str, int], block: int = BLOCK, least: int = RESOLUTION) -> int:
    """Slots of a period by which rounding of the weights stays under half a block as long as the mix is open.

    A weight is rounded by less than one part, so a period of twice the slots of the open mix is enough; it also gives
    the smallest weight a whole part, up to ``FINEST`` slots.
    """
    if not weights:
        return least
    total = sum(weights.values())
    slots = min(-(-rows[s] // block) * total / w for s, w in weights.items())
    small = min(FINEST, total / min(weights.values()))
    return max(least, 2 * math.ceil(slots), 2 * math.ceil(small), 2 * len(weights))


def schedule(blocks: Mapping[str, int], weights: Mapping[str, float]) -> list[tuple[str, int, int, int, int]]:
    """``(source, j, release, deadline, slot)`` of all blocks in the order of their slots: earliest deadline first among
    the released.

    Equal deadlines go by the weight, larger first, then by name. Slots stay empty where nothing is released, as sources
    end. Numbers beyond the range of longs (a weight under about 1e-18 of all) are cut to it.
    """
    import heapq

    ratios = {s: float(weights[s]).as_integer_ratio() for s in blocks}
    # floats have powers of two below the line, so the largest one serves all
    below = max((d for _, d in ratios.values()), default=1)
    whole = {s: n * (below // d) for s, (n, d) in ratios.items()}
    total = sum(whole.values())
    waiting = [(0, -w, s, 0) for s, w in whole.items() if blocks[s] > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int, int]] = []
    out, slot = [], 0
    while waiting or ready:
        if not ready and waiting[0][0] > slot:
            slot = max(slot, min(waiting[0][0], _LAST))
        while waiting and (waiting[0][0] <= slot or not ready):
            release, weight, source, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-((j + 1) * total // weight), weight, source, j, release))  # weights are negative here
        deadline, weight, source, j, release = heapq.heappop(ready)
        out.append((source, j, min(release, _LAST), min(deadline, _LAST), slot))
        slot += 1
        if j + 1 < blocks[source]:
            heapq.heappush(waiting, ((j + 1) * total // -weight, weight, source, j + 1))
    return out


def period(parts: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """The schedule of as many blocks as each source has parts: it repeats after that."""
    return schedule(parts, parts)


def _name(source: Column) -> Column:
    """Sources by name; the null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, key: str = "doc_id", source: str = "source", block: int = BLOCK, resolution: int | None = None,
    range_rows: int = RANGE_ROWS, scheduled: int = SCHEDULED,
) -> DataFrame:
    """All rows and columns of ``docs``, with their place in the mix.

    Columns that follow: ``block`` (number of the block in its source, from 0), ``release``, ``deadline`` and ``slot``
    (longs, in slots), ``place`` (in the block, from 0) and ``open_mix`` (whether all sources still have blocks at that
    slot); a column of ``docs`` with such a name gets ``_in`` behind it, other names do not matter. ``slot, place`` is a
    total order of the mix. While ``open_mix`` holds, each source has had its share of the slots by its target weight to
    less than one block. No row is dropped: when a source ends its slots stay empty and the others go on in their order.

    ``weights`` gives each source's target (the null source by the key None); the sources in the table must all have
    one. Without it a source weighs the square root of its rows, which raises small sources without repeating them.
    ``resolution`` rounds weights to parts of at least so many slots, which gives a schedule with a period. Inside a
    source, documents come in the order of a hash of their key, however many ranges count them; rows with equal keys come
    together, in any order. A block has ``block`` rows or, with more than ``scheduled`` such blocks, so many that there
    are no more. An empty table gives no rows.
    """
    plain, at = sealed(docs)
    k, added = at(key), ["block", "release", "deadline", "slot", "place", "open_mix"]
    named = plain.withColumn("s", _name(F.col(at(source)))).withColumn("h", F.xxhash64(F.col(k), F.lit("order")))
    # as many rows as there are sources
    totals = {r["s"]: r["n"] for r in named.groupBy("s").agg(F.count("*").alias("n")).collect()}
    if weights is None:
        chosen = {s: n**0.5 for s, n in totals.items()}
    else:
        given = {"null" if s is None else f"={s}": w for s, w in weights.items()}
        if lacking := sorted(totals.keys() - given.keys()):
            raise ValueError(f"no target weight for {lacking}")
        chosen = {s: given[s] for s in totals}
    if chosen and min(chosen.values()) <= 0:
        raise ValueError("target weights must be positive")
    block = max(block, -(-sum(totals.values()) // scheduled))
    if resolution is not None:
        chosen = whole_weights(chosen, fine_resolution(chosen, totals, block, resolution))
    turns = schedule({s: -(-n // block) for s, n in totals.items()}, chosen)
    last: dict[str, int] = {s: slot for s, *_, slot in turns}
    spark = docs.sparkSession
    sent = lambda df, rows: F.broadcast(df) if rows <= _SENT else df
    columns = list(zip(*turns, strict=True)) or [()] * 5
    kinds = (pa.string(), *[pa.int64()] * 4)
    slots = spark.createDataFrame(pa.table({n: pa.array(c, t) for n, c, t in zip(("s", "b", "r0", "d0", "s0"), columns, kinds, strict=True)}))
    share = spark.createDataFrame([(s, ((n - 1) // range_rows).bit_length()) for s, n in totals.items()], "s string, bits int")
    # a source is cut by the first bits of the hash into ranges in the hash's order, so a hot one is many tasks
    shared = named.join(sent(share, len(totals)), "s")
    ranged = shared.withColumn("r", F.when(F.col("bits") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftright(h, 64 - bits)")))
    numbered = ranged.withColumn("i", F.row_number().over(Window.partitionBy("s", "r").orderBy("h", k)) - 1)
    # both sides are partitioned by (source, range); there is an offset for each RANGE_ROWS rows
    joined = numbered.join(_offsets(ranged.groupBy("s", "r").agg(F.count("*").alias("n"))), ["s", "r"])
    number = F.col("offset") + F.col("i")
    timed = joined.select(*plain.columns, "s", F.floor(number / block).alias("b"), (number % block).cast("int").alias("p"))
    placed = timed.join(sent(slots, len(turns)), ["s", "b"])
    made = placed.select(*plain.columns, "b", "r0", "d0", "s0", "p", F.col("s0") <= F.lit(min(last.values(), default=0)))
    return made.toDF(*apart(docs.columns, added), *added)


def _offsets(sizes: DataFrame) -> DataFrame:
    """``(s, r, offset)``: the rows of a source before each of its ranges, by sums of groups of ranges and within them."""
    ranges = sizes.withColumn("c", F.floor(F.col("r") / _GROUPED))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = ranges.groupBy("s", "c").agg(F.sum("n").alias("n")).select("s", "c", before(Window.partitionBy("s").orderBy("c")).alias("far"))
    within = ranges.withColumn("near", before(Window.partitionBy("s", "c").orderBy("r")))
    return within.join(groups, ["s", "c"]).select("s", "r", (F.col("far") + F.col("near")).alias("offset"))


def in_mixed_order(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows and columns of ``docs``, dealt and sorted in the order of the mix, so that files are written in it."""
    plain, at = sealed(docs)
    mixed = mix(plain, key=at("doc_id"), source=at("source"))
    order = ["slot", "place"]
    dealt = mixed.repartitionByRange(partitions, *order) if partitions else mixed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).select(*plain.columns).toDF(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
