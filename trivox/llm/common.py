"""What several training-data operators share: lineage cuts, raw text access, tiles and components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines see: what ``spark.checkpoint.dir`` names.

    Only a session on one machine may do without; a cluster without one is refused, as its machines' own folders are
    lost with them.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    import tempfile

    return tempfile.mkdtemp(prefix="checkpoints-")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def sealed(docs: DataFrame) -> tuple[DataFrame, Callable[[str], str]]:
    """``docs`` with names by position, which clash with nothing and need no quoting, and the new name of an old one."""
    names = docs.columns
    return docs.toDF(*[f"__{i}" for i in range(len(names))]), lambda name: f"__{names.index(name)}"


def apart(names: list[str], added: Iterable[str]) -> list[str]:
    """``names`` of input columns beside ``added`` ones: one of a name that is added gets ``_in`` behind it, until it is free."""
    added, out = {a.lower() for a in added}, []
    taken = added | {n.lower() for n in names}
    for name in names:
        if name.lower() in added:
            while name.lower() in taken:
                name += "_in"
            taken.add(name.lower())
        out.append(name)
    return out


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def remainder(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``: the fold of a document. A null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def forest(edges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning forest of ``edges``: the same components with at most one edge less than there are nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    kept = []
    for a, b in edges:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def tile_edges(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row and column numbers of pairs that connect just what ``mask`` (rows x columns) connects.

    A sparse mask gives its own links. A dense one, as inside a group of copies, gives a star for each of its
    components: never more than rows + columns.
    """
    n_rows, n_cols = mask.shape
    if mask.sum() <= 2 * (n_rows + n_cols):
        yield from zip(*(x.tolist() for x in np.nonzero(mask)), strict=True)
        return
    rows, cols = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    mask, label = mask[np.ix_(rows, cols)], np.arange(len(cols))
    while True:  # each column takes the smallest column number that its rows reach
        of_row = np.where(mask, label[None, :], len(cols)).min(axis=1)
        new = np.where(mask, of_row[:, None], len(cols)).min(axis=0)
        if (new == label).all():
            break
        label = new
    first_row: dict[int, int] = {}
    for i, c in zip(rows.tolist(), of_row.tolist(), strict=True):
        first_row.setdefault(c, i)
        yield i, int(cols[c])
    for j, c in zip(cols.tolist(), label.tolist(), strict=True):
        yield first_row[c], j


#: Edges in a file of a round of components, on average at most.
EDGES = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs) as ``(node, root)``, root the smallest node; alternating stars.

    Each round links the larger neighbours of every node to its smallest neighbour, then the smaller ones. Both work
    on aggregates and equi-joins, so a hub's links are spread by the adaptive skew join, and each round ends in a
    checkpoint of as many files as the edges of the round before ask for. Nodes without edges are not returned.
    """
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    sign = _sign(state)
    while sign[0]:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        # a round has two rows for each edge at most
        state = cut(small.select("e.u", "e.v").where("u <> v").distinct().coalesce(int(max(1, -(-2 * sign[0] // EDGES)))))
        new = _sign(state)
        if new == sign:
            break
        sign = new
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
