"""Near-duplicate vectors by collision-counting projections (operator 8).

Unit vectors are turned by a random rotation, which gives as many one-dimensional projections as there are dimensions.
Blocks of vectors meet in pairs, one task each, and there each of many projections is sorted. A query's window in a
projection, centred on its value, is then a range of ranks, found by two binary searches; a vector collides with the query
if its rank lies in it. Collisions are counted per pair. For a pair at the threshold the number of windows missed is
binomial, whatever the pair, so the count that it must pass is set from the wanted recall; pairs that pass are verified
by their cosine. The order of the first projection also bounds the columns that a tile of queries can meet at all.

Equal vectors are one node from the start, and tasks return numbers of links by node and a spanning forest, not links.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.llm.common import components, cut, forest, table, tile_edges

COSINE = 0.95
#: Half width of a window, in standard deviations of the difference of a pair at the threshold.
WIDTH = 2.5
#: Chance that the count rejects a pair at the threshold; much less for closer ones.
MISS = 1e-6
#: Vectors in a block, on average at most.
BLOCK = 8192
#: Tasks that pairs of blocks are dealt to at most.
TASKS = 4096
_ROWS, _COLS, _DENSE, _VERIFY = 256, 2048, 16, 1 << 15


@functools.cache
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def allowed_misses(n: int, miss: float = MISS, width: float = WIDTH) -> int:
    """The windows of n that a pair at the threshold may miss, so that a share of ``miss`` at most misses more."""
    p, tail = math.erfc(width / math.sqrt(2)), 1.0
    for c in range(n + 1):
        tail -= math.comb(n, c) * p**c * (1 - p) ** (n - c)
        if tail <= miss / 4:
            return c
    return n


def links(a: np.ndarray, b: np.ndarray, same: bool, cosine: float = COSINE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and column numbers, piece by piece, of links between unit vectors ``a`` and ``b``; above the diagonal if same."""
    dim = a.shape[1]
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    window = np.float32(WIDTH * radius / math.sqrt(dim) + 1e-5)
    turn = rotation(dim)
    pa_, pb_ = (a @ turn).astype(np.float32), (b @ turn).astype(np.float32)
    order_a, order_b = np.argsort(pa_[:, 0], kind="stable"), np.argsort(pb_[:, 0], kind="stable")
    qa, qb = np.ascontiguousarray(pa_[order_a].T), np.ascontiguousarray(pb_[order_b].T)
    dense = min(_DENSE, dim)
    first, later = allowed_misses(dense), min(2 * _DENSE, dim)
    last = allowed_misses(later)
    reach = np.float32(radius + 1e-5)  # no projection of a link differs by more
    sorted_b = np.sort(qb[:dense], axis=1)
    kind = np.uint16 if len(b) < 1 << 16 else np.uint32
    ranks = np.empty((dense, len(b)), kind)
    for p in range(dense):
        ranks[p, np.argsort(qb[p], kind="stable")] = np.arange(len(b), dtype=kind)
    for i in range(0, len(a), _ROWS):
        rows = qa[:, i : i + _ROWS]
        lo, hi = np.searchsorted(qb[0], [rows[0, 0] - reach, rows[0, -1] + reach])
        # windows as ranges of ranks, centred on the queries
        opens = np.array([np.searchsorted(sorted_b[p], rows[p] - window, side="left") for p in range(dense)], kind)
        sizes = np.array([np.searchsorted(sorted_b[p], rows[p] + window, side="right") for p in range(dense)], kind) - opens
        for j in range(int(lo), int(hi), _COLS):
            cols = qb[:, j : min(j + _COLS, int(hi))]
            missed = np.zeros((rows.shape[1], cols.shape[1]), np.uint8)
            for p in range(dense):
                # ranks below the window wrap round to large numbers
                missed += ranks[p, None, j : j + cols.shape[1]] - opens[p, :, None] >= sizes[p, :, None]
                if p == dense // 2 and missed.min() > first:
                    break
            r, c = np.nonzero(missed <= first)
            for at in range(0, len(r), _VERIFY):
                rr, cc = r[at : at + _VERIFY], c[at : at + _VERIFY]
                if later > dense:
                    more = (np.abs(rows[dense:later, rr] - cols[dense:later, cc]) > window).sum(axis=0)
                    keep = missed[rr, cc] + more <= last
                    rr, cc = rr[keep], cc[keep]
                x, y = order_a[i + rr], order_b[j + cc]
                if same:
                    x, y = x[x < y], y[x < y]
                hit = np.einsum("ij,ij->i", a[x], b[y]) >= cosine
                if hit.any():
                    yield x[hit], y[hit]


def _finite(vector: str) -> Column:
    """Whether a vector can be compared: no nulls, only finite numbers, not all zero."""
    wide = lambda x: x.cast("double")
    good = lambda x: x.isNotNull() & ~F.isnan(wide(x)) & (F.abs(wide(x)) < float("inf"))
    return F.coalesce(F.col(vector).isNotNull() & F.forall(vector, good) & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for each row of ``vectors``; other columns are left out.

    Rows link at a cosine, in double precision, of ``cosine`` or more. Vectors that are null, empty, zero or hold a null
    or non-finite number link with nothing, nor do vectors of different lengths. Rows that repeat are vectors of their
    own and link with each other. ``component_id`` is the smallest key that links reach, null keys passed over; ``kept``
    is whether it is the row's own (both null counts as own). An empty table gives no rows.
    """
    rows = vectors.select(F.col(key).alias("k"), F.col(vector).alias("e"), _finite(vector).alias("valid"))
    name = F.concat(F.lpad(F.hex(F.xxhash64("e")), 16, "0"), F.lpad(F.hex(F.xxhash64(F.reverse("e"), F.lit(1))), 16, "0"))
    rows = rows.withColumn("h", F.when(F.col("valid"), name))
    each = rows.where("valid").groupBy("h").agg(F.first("e").alias("e"), F.count("*").alias("n"), F.min("k").alias("m"))
    # a node starts with its smallest key, so the smallest node of a component has the component's
    nodes = cut(each.select(F.struct(F.when(F.col("m").isNull(), 1).when(F.col("m").isNotNull(), 0).alias("z"), "m", "h").alias("node"), "e", "n"))
    dims = {r["d"]: -(-r["n"] // block) for r in nodes.groupBy(F.size("e").alias("d")).agg(F.count("*").alias("n")).collect()}
    shape = vectors.sparkSession.createDataFrame(list(dims.items()), "d int, parts long")
    placed = nodes.withColumn("d", F.size("e")).join(F.broadcast(shape), "d").withColumn("s", F.pmod(F.xxhash64("node"), "parts"))
    blocks = placed.groupBy("d", "s", "parts").agg(F.collect_list(F.struct("node", "e", "n")).alias("v"))
    met = blocks.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pairs = met.select("d", F.least("s", "o").alias("p"), F.greatest("s", "o").alias("q"), (F.col("s") <= F.col("o")).alias("first"), "v")

    def compare(found: pa.Table) -> pa.Table:
        sides = []
        for i in sorted(range(found.num_rows), key=lambda i: not found.column("first")[i].as_py()):
            one = found.column("v")[i].values
            e = one.field("e").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(one), -1)
            e = e / np.abs(e).max(axis=1, keepdims=True)
            sides.append((one.field("node"), e / np.linalg.norm(e, axis=1, keepdims=True), one.field("n").to_numpy()))
        (ids, a, na), (jds, b, nb) = sides[0], sides[-1]
        same, counts, edges = len(sides) == 1, [np.zeros(len(x[0]), np.int64) for x in sides], []
        for x, y in links(a, b, same, cosine):
            counts[0] += np.bincount(x, nb[y], len(ids)).astype(np.int64)
            counts[-1] += np.bincount(y, na[x], len(jds)).astype(np.int64)
            shift = 0 if same else len(ids)
            edges = forest(edges + [(int(r), int(c) + shift) for r, c in _thinned(x, y)])
        names = ids if same else pa.concat_arrays([ids, jds])
        some = np.flatnonzero(np.concatenate(counts[: 1 if same else 2]))
        ends = np.array(edges, np.int64).reshape(-1, 2)
        n = np.concatenate((np.concatenate(counts[: 1 if same else 2])[some], np.zeros(len(ends), np.int64)))
        a_, b_ = names.take(pa.array(np.concatenate((some, ends[:, 0])))), pa.concat_arrays([pa.nulls(len(some), names.type), names.take(pa.array(ends[:, 1]))])
        return pa.table({"a": a_, "b": b_, "n": pa.array(n)})

    kind = nodes.schema["node"].dataType.simpleString()
    tasks = sum(p * (p + 1) // 2 for p in dims.values())
    dealt = pairs.repartition(max(1, min(TASKS, tasks)), "d", "p", "q")
    found = cut(dealt.groupBy("d", "p", "q").applyInArrow(compare, f"a {kind}, b {kind}, n long"))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("l"))
    root = components(found.where("b is not null").select("a", "b"))
    facts = nodes.select("node", "n").join(root, "node", "left").join(counts, "node", "left")
    facts = cut(facts.select(F.col("node.h").alias("h"), (F.coalesce("l", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node")["m"].alias("component_id")))
    good, bad = rows.where("valid").join(facts, "h"), rows.where("not valid")
    both = good.select("k", "n_links", "component_id").unionByName(bad.select("k", F.lit(0).cast("long").alias("n_links"), F.col("k").alias("component_id")))
    return both.select(F.col("k").alias(key), "n_links", "component_id", F.col("k").eqNullSafe(F.col("component_id")).alias("kept"))


def _thinned(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs that connect what (x, y) connect, few of them where they are dense."""
    rows, r = np.unique(x, return_inverse=True)
    cols, c = np.unique(y, return_inverse=True)
    if len(x) <= 2 * (len(rows) + len(cols)):
        yield from zip(x.tolist(), y.tolist(), strict=True)
        return
    mask = np.zeros((len(rows), len(cols)), bool)
    mask[r, c] = True
    for i, j in tile_edges(mask):
        yield int(rows[i]), int(cols[j])


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP8_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT c.vec_id AS vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id AS component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.vec_id = c.vec_id
"""
