"""SimHash near-duplicates (operator 1).

Fingerprints are made from whole texts, then equal ones are merged by an aggregation, so a group of copies is one
fingerprint from there on. The distinct fingerprints are packed into blocks of one population count, and only pairs of
blocks whose population counts differ by the radius or less meet. Inside a pair, tiles of equal half-word population
counts are compared by exclusive-or and bit counts, again only where the counts allow it. A pair of blocks returns a
spanning forest of its links, not the links, so a group of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from trivox.llm.common import components, cut, forest, raw_texts, sealed, table, tile_edges

SHINGLE = 3
RADIUS = 3
#: Fingerprints in a block, on average at most: two blocks are what a task holds.
BLOCK = 65_536
#: Rows and columns that are compared at once.
TILE = 512
#: Near copies: words in a shingle, and the Jaccard index from which texts are near copies.
COPY_SHINGLE = 5
SIMILARITY = 0.8
#: Standard deviations by which a pair at that index may have more bits apart than it has on average.
SPREAD = 4.3
#: Sets of so few shingles or fewer have uneven bits, and a wider radius.
SMALL = 8
#: Texts of about one size in a block: 65,536, or a sixteenth of them, up to 262,144.
COPY_BLOCK = (65_536, 262_144)
#: Bytes of shingle sets that a task holds on a side of one group.
SETS = 4 << 20
#: Tasks that pairs of blocks are dealt to at most.
TASKS = 4096
_PIECE = 1 << 15
_WIDE = 4 * TILE


def fingerprint(text: bytes | None, words_in_shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text as an unsigned number; zero without words.

    A-Z are lowered; words are runs without space and the controls 9 to 13; shingles count as often as they occur, and
    fewer words than a shingle has are one shingle. Null is a text without words.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = len(words) - words_in_shingle + 1
    if n < 1:
        words, n = [b" ".join(words)], 1
        shingles: Iterator[bytes] = iter(words)
    else:
        shingles = map(b" ".join, zip(*(words[i : n + i] for i in range(words_in_shingle)), strict=True))
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _PIECE):
        count = min(_PIECE, n - start)
        h = np.fromiter((xxh64_intdigest(next(shingles), 42) for _ in range(count)), np.uint64, count)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp)`` for each row; ``fp`` is the fingerprint's bits as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(map(fingerprint, raw_texts(batch.column(1))), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(work, f"k {kind}, fp long")


def links(a: np.ndarray, b: np.ndarray, same: bool, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Pairs that connect the members of two blocks (or of one, if ``same``) as links of ``radius`` bits or fewer do."""

    def tiles(x: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        high, low = np.bitwise_count(x >> np.uint64(32)), np.bitwise_count(x & np.uint64(0xFFFFFFFF))
        order = np.lexsort((low, high))
        cuts = np.flatnonzero((np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)) + 1
        out = []
        for group in np.split(order, cuts):
            if len(group):
                out += [(int(high[group[0]]), int(low[group[0]]), x[group[i : i + TILE]]) for i in range(0, len(group), TILE)]
        return out

    left, right = tiles(a), tiles(b)
    for i, (high_a, low_a, xs) in enumerate(left):
        for high_b, low_b, ys in right[i:] if same else right:
            if abs(high_a - high_b) + abs(low_a - low_b) <= radius:
                mask = np.bitwise_count(xs[:, None] ^ ys[None, :]) <= radius
                if mask.any():
                    for r, c in tile_edges(mask):
                        if xs[r] != ys[c]:
                            yield int(xs[r].astype(np.int64)), int(ys[c].astype(np.int64))


def _met(rows: DataFrame, key: str, parts: dict[int, int], radius: int) -> DataFrame:
    """``(p, q, first, xs)``: blocks of ``rows(w, key, x)`` in pairs, of values of ``w`` that differ by ``radius`` at most.

    ``parts`` has the blocks of each value, few values. The pairs are dealt out by number, as they are small to move but
    long to compare.
    """
    spark = rows.sparkSession
    shape = spark.createDataFrame(list(parts.items()), "w int, parts long")
    near = [(w, v, n) for w in parts for v, n in parts.items() if abs(v - w) <= radius]
    partners = spark.createDataFrame(near, "w int, w2 int, parts2 long")
    blocks = rows.join(F.broadcast(shape), "w").groupBy("w", F.pmod(F.xxhash64(key), "parts").alias("s")).agg(F.collect_list("x").alias("xs"))
    met = blocks.join(F.broadcast(partners), "w").withColumn("s2", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts2") - 1)))
    mine, other = F.struct("w", "s"), F.struct(F.col("w2").alias("w"), F.col("s2").alias("s"))
    pairs = met.select(F.least(mine, other).alias("p"), F.greatest(mine, other).alias("q"), (mine <= other).alias("first"), "xs")
    return pairs.repartition(max(1, min(TASKS, sum(parts[w] * n for w, _, n in near) // 2)), "p", "q")


def near_edges(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: edges whose components are those of all links among distinct fingerprints ``fps(fp)``."""
    weighed = fps.select("fp", F.bit_count("fp").cast("int").alias("w"), F.col("fp").alias("x"))
    # 65 population counts at most
    parts = {r["w"]: -(-r["n"] // block) for r in weighed.groupBy("w").agg(F.count("*").alias("n")).collect()}

    def compare(found: pa.Table) -> pa.Table:
        order = sorted(range(found.num_rows), key=lambda i: not found.column("first")[i].as_py())
        sides = [found.column("xs")[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for i in order]
        return _edges(forest(links(sides[0], sides[-1], len(sides) == 1, radius)))

    return _met(weighed, "fp", parts, radius).groupBy("p", "q").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``(key, fingerprint, component_id)`` for each row of ``docs``, rows that repeat included.

    ``component_id`` is the smallest key that links of ``radius`` differing bits or fewer reach, itself included; null
    keys are passed over (null if there are no others). Rows without words have fingerprint zero and are linked like
    any other. An empty table gives no rows; other columns are left out.
    """
    marked = cut(with_fingerprint(docs, key, text))
    root = components(near_edges(marked.select("fp").distinct(), radius)).withColumnRenamed("node", "fp")
    least = marked.groupBy("fp").agg(F.min("k").alias("m")).join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = least.groupBy("root").agg(F.min("m").alias("component_id"))
    by_fp = cut(least.join(ids, "root").select("fp", "component_id"))
    return marked.join(by_fp, "fp").select(F.col("k").alias(key), hexed(F.col("fp")).alias("fingerprint"), "component_id")


def hexed(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def shingles(text: bytes | None, words_in_shingle: int = COPY_SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; fewer words than a shingle has are one, no words are none."""
    words = (text or b"").lower().split()
    n = max(1, len(words) - words_in_shingle + 1) if words else 0
    joined = map(b" ".join, (words[i : i + words_in_shingle] for i in range(n)))
    return np.unique(np.fromiter((xxh64_intdigest(x, 42) for x in joined), np.uint64, n))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard index of two arrays of distinct hashes; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def wide(hashes: np.ndarray) -> tuple[int, ...]:
    """A SimHash of 256 bits of distinct hashes as four signed longs, each from another mixing of the hashes."""
    if not len(hashes):
        return 0, 0, 0, 0
    out = []
    for word in range(4):
        h = hashes + np.uint64((word + 1) * 0x9E3779B97F4A7C15 % 2**64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        ones = np.zeros(64, np.int64)
        for start in range(0, len(h), _PIECE):
            ones += np.unpackbits(h[start : start + _PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0]))
    return tuple(out)


def reach(bits: int, least: float = SIMILARITY, small: bool = False) -> int:
    """The bits of ``bits`` in which fingerprints of sets of similarity ``least`` differ at most, but for a share of 1e-5.

    A bit differs with the chance that a random plane parts the sets, acos(2 J / (1 + J)) / pi for sets of one size and
    less for others. Small sets have a chance of up to 3/16 at 0.8, that of four of five shingles.
    """
    p = math.acos(min(1.0, 2 * least / (1 + least))) / math.pi + (0.036 if small else 0)
    return math.ceil(bits * p + SPREAD * math.sqrt(bits * p * (1 - p)))


def copy_links(a: dict[str, np.ndarray], b: dict[str, np.ndarray], same: bool, least: float = SIMILARITY) -> Iterator[tuple[int, int]]:
    """Pairs of nodes that connect the members of two blocks (or of one, if ``same``) as pairs that may be near copies do.

    These have sizes ``n`` and fingerprints ``f0`` to ``f3`` that similarity ``least`` allows. Blocks are in the order of
    size, so a tile of rows meets a range of columns; tiles whose population counts differ beyond the radius are passed.
    """
    counts = [sum(np.bitwise_count(x[f"f{i}"]).astype(np.int64) for i in range(4)) for x in (a, b)]
    for i in range(0, len(a["n"]), TILE):
        rows = slice(i, i + TILE)
        small = a["n"][i] <= SMALL
        half, radius = reach(64, least, small), reach(256, least, small)
        low, high = counts[0][rows].min(), counts[0][rows].max()
        first, last = np.searchsorted(b["n"], [a["n"][rows][0] * least - 1e-9, a["n"][rows][-1] / least + 1e-9])
        for j in range(max(int(first), i) if same else int(first), int(last), _WIDE):
            cols = slice(j, min(j + _WIDE, int(last)))
            if counts[1][cols].min() - high > radius or low - counts[1][cols].max() > radius:
                continue
            r, c = np.nonzero(np.bitwise_count(a["f0"][rows][:, None] ^ b["f0"][cols][None, :]) <= half)
            x, y = r + i, c + j
            apart = sum(np.bitwise_count(a[f"f{k}"][x] ^ b[f"f{k}"][y]).astype(np.int64) for k in range(4))
            sized = np.minimum(a["n"][x], b["n"][y]) >= least * np.maximum(a["n"][x], b["n"][y]) - 1e-9
            ok = (apart <= radius) & sized & (a["node"][x] != b["node"][y])
            if same:
                ok &= x < y
            if ok.any():
                mask = np.zeros((rows.stop - i, cols.stop - j), bool)
                mask[r[ok], c[ok]] = True
                yield from ((int(a["node"][i + p]), int(b["node"][j + q])) for p, q in tile_edges(mask))


def copy_edges(nodes: DataFrame, least: float = SIMILARITY, sizes: tuple[int, int] = COPY_BLOCK) -> DataFrame:
    """``(a, b)``: edges that connect the ``nodes(node, n, f0, f1, f2, f3)`` which may be near copies.

    Sizes of near copies lie in one band or in neighbouring ones, so only blocks of these meet. A set too small for any
    other to reach ``least`` is passed over.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(least)).cast("int")
    shaped = nodes.where(F.col("n") / (F.col("n") + 1) >= least - 1e-9).withColumn("w", band)
    # a band for each factor of 1 / least in size
    count = {r["w"]: r["n"] for r in shaped.groupBy("w").agg(F.count("*").alias("n")).collect()}
    parts = {w: -(-n // max(sizes[0], min(sizes[1], n // 16))) for w, n in count.items()}
    pairs = _met(shaped.select("w", "node", F.struct("node", "n", "f0", "f1", "f2", "f3").alias("x")), "node", parts, 1)

    def compare(found: pa.Table) -> pa.Table:
        sides = []
        for i in sorted(range(found.num_rows), key=lambda i: not found.column("first")[i].as_py()):
            one = found.column("xs")[i].values
            x = {k: one.field(k).to_numpy(zero_copy_only=False) for k in ("node", "n", "f0", "f1", "f2", "f3")}
            order = np.argsort(x["n"], kind="stable")
            sides.append({k: v[order].view(np.uint64) if k[0] == "f" else v[order] for k, v in x.items()})
        return _edges(forest(copy_links(sides[0], sides[-1], len(sides) == 1, least)))

    return pairs.groupBy("p", "q").applyInArrow(compare, "a long, b long")


def _edges(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def near_sets(a: list[np.ndarray], b: list[np.ndarray] | None = None, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Row and column numbers that connect sets as all links of a Jaccard index of ``least`` or more do: those between
    ``a`` and ``b``, or within ``a``. Sets are arrays of distinct values, none empty, in the order of their size."""
    same, sets = b is None, a + (b or [])
    n = np.array([len(x) for x in sets], np.int64)
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(n)
    starts, first = ends - n, 0 if same else len(a)
    marked, label, edges = np.zeros(len(values), np.int32), np.arange(len(sets)), []
    for i in range(len(a)):
        low, high = first + np.searchsorted(n[first:], [n[i] * least - 1e-9, n[i] / least + 1e-9])
        low = max(int(low), i + 1) if same else int(low)
        if low >= high:
            continue
        own = ids[starts[i] : ends[i]]
        marked[own] = 1
        both = np.add.reduceat(marked[ids[starts[low] : ends[high - 1]]], starts[low:high] - starts[low])
        marked[own] = 0
        for j in (low + np.flatnonzero(both / (n[i] + n[low:high] - both) >= least)).tolist():
            if label[j] != label[i]:
                edges.append((i, j - first))
                label[label == label[j]] = label[i]
    return edges


def copies(marked: DataFrame, docs: DataFrame, words_in_shingle: int = COPY_SHINGLE, least: float = SIMILARITY, held: int = SETS) -> DataFrame:
    """``(node, root)`` of each text that a chain of texts of similarity ``least`` or more links to a text of another node.

    ``docs(k, h, t)`` are the texts, ``marked`` what ``with_copy_marks`` makes of them. SimHash says which nodes may be
    linked; the shingles of the texts of each of the groups so formed are then compared exactly, a large group in
    pairs of blocks of ``held`` bytes or less. So each text of a small group travels once, and pairs are never rows.
    """
    nodes = cut(marked.select("node", "n", "f0", "f1", "f2", "f3").distinct())
    group = components(copy_edges(nodes, least)).withColumnRenamed("root", "g")
    # one row for each node that is in a group
    once = marked.groupBy("node").agg(F.first("n").alias("n"), F.min(F.struct("h", "k")).alias("one"))
    chosen = cut(once.join(group, "node").select("node", "g", "n", F.col("one.h").alias("h1"), F.col("one.k").alias("k1")))
    weight = chosen.groupBy("g").agg((8 * F.sum("n")).alias("size"))
    total = weight.agg(F.sum("size")).first()[0] or 0
    # up to eight blocks of an eighth, then blocks of ``held`` bytes
    blocks = F.greatest(F.ceil(F.col("size") / held), F.least(F.lit(8), F.ceil(8 * F.col("size") / held)))
    chosen = chosen.join(weight.where(8 * F.col("size") > held).select("g", blocks.alias("parts")), "g", "left")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(t, words_in_shingle).tobytes() for t in raw_texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary()), batch.column(3)], ["node", "g", "x", "parts"])

    texts = docs.join(chosen, (F.col("h") == F.col("h1")) & F.col("k").eqNullSafe(F.col("k1"))).select("node", "g", "t", "parts").mapInArrow(sets, "node long, g long, x binary, parts long")
    placed = texts.withColumn("s", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))))
    met = placed.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)))
    # as many deals of small groups as their bytes make, so that each stays small; a task may have several
    deals = max(8, -(-total // held))
    deal = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("g"), F.lit(deals))).otherwise(F.col("g"))
    pairs = met.select(F.col("parts").isNotNull().alias("big"), deal.alias("d"), F.least("s", "o").alias("p"), F.greatest("s", "o").alias("q"), "s", "node", "g", "x")

    def judge(found: pa.Table) -> pa.Table:
        names, of_group, side = (found.column(c).to_numpy() for c in ("node", "g", "s"))
        rows, out = found.column("x").to_pylist(), []
        _, once = np.unique(names, return_index=True)  # rows that repeat
        sized = sorted(once.tolist(), key=lambda i: (of_group[i], len(rows[i]), names[i]))
        for part in np.split(np.array(sized), np.flatnonzero(np.diff(of_group[sized])) + 1):
            ids = [part[side[part] == s] for s in np.unique(side[part])]
            cross = found.column("p")[0].as_py() != found.column("q")[0].as_py()
            if len(part) < 2 or cross and len(ids) < 2:
                continue
            a, b = ids[0], ids[-1] if cross else ids[0]
            read = lambda which: [np.frombuffer(rows[i], np.uint64) for i in which]
            out += [(int(names[a[i]]), int(names[b[j]])) for i, j in near_sets(read(a), read(b) if cross else None, least)]
        return _edges(out)

    keys = ["big", "d", "p", "q"]
    return components(pairs.repartition(int(min(TASKS, deals)), *keys).groupBy(*keys).applyInArrow(judge, "a long, b long"))


def with_copy_marks(docs: DataFrame, words_in_shingle: int = COPY_SHINGLE) -> DataFrame:
    """``(k, h, node, n, f0, f1, f2, f3)`` of each row of ``docs(k, h, t)``: ``node`` is a hash of the text's set of
    shingles, so texts with equal sets are one node; ``n`` is its size, the rest a SimHash of 256 bits."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(xxh64_intdigest(x.tobytes()), len(x), *wide(x)) for x in (shingles(t, words_in_shingle) for t in raw_texts(batch.column(2)))]
            node = pa.array(np.fromiter((x[0] for x in made), np.uint64, len(made)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), node, *[pa.array([x[i] for x in made], pa.int64()) for i in range(1, 6)]], ["k", "h", "node", "n", "f0", "f1", "f2", "f3"])

    return docs.mapInArrow(sign, f"k {docs.schema['k'].dataType.simpleString()}, h long, node long, n long, f0 long, f1 long, f2 long, f3 long")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", words_in_shingle: int = COPY_SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """One row of each group of near copies: that with the smallest key, of rows with equal keys the one with the
    smallest text hash. Groups are of texts, so rows with equal keys and different texts are each in their own.

    Texts are near copies at a Jaccard index of ``least`` or more of their sets of shingles, A-Z lowered. Null texts are
    empty, and texts without words are copies of each other. Of rows equal in key and text one stays, by a hash of all
    columns. Rows with a null key have no identity that a decision could name, so they stay. Columns may have any name;
    an empty table gives no rows.
    """
    plain, at = sealed(docs)
    k = at(key)
    hashed = plain.withColumn("h", F.xxhash64(F.coalesce(F.col(at(text)), F.lit(""))))
    whole = hashed.select(F.col(k).alias("k"), "h", F.coalesce(F.col(at(text)), F.lit("")).alias("t"))
    marked = cut(with_copy_marks(whole, words_in_shingle))
    root = copies(marked, whole, words_in_shingle, least)
    # equal texts are met by aggregation before groups are
    known = marked.where("k is not null").groupBy("node").agg(F.min(F.struct("k", "h")).alias("one")).join(root, "node", "left")
    chosen = known.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("one").alias("one")).select(F.col("one.k").alias("k1"), F.col("one.h").alias("h1"))
    kept = hashed.join(chosen, (F.col(k) == F.col("k1")) & (F.col("h") == F.col("h1")), "left_semi")
    every = F.xxhash64(*[F.col(c).cast("string") for c in plain.columns])
    first = kept.withColumn("n", F.row_number().over(Window.partitionBy(k, "h").orderBy(every))).where("n = 1")
    return first.select(*plain.columns).unionByName(plain.where(F.col(k).isNull())).toDF(*docs.columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
