"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in halves, each half has its own codebook of ``K``
centroids, and a pair of centroids is a cell of the K x K product grid.  Every
vector is listed in its nearest cell.  A query visits cells in the order of the
sum of its two distances (the multi-sequence order); how many is measured once:
the fewest that reach the target recall against brute force on a sample of
queries, drawn until a stated number of them has a link or every vector has
been asked.  All vectors are queries, and candidates are verified by their
cosine in double precision.

Cells are cut into blocks of members and of queries, so a crowded cell is many
bounded groups.  A block returns sums and spanning edges, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import materialised, small_batches
from tallyspark.llm.graph import connected_components

#: centroids per half, at least and at most, and the vectors of a cell on
#: average that they grow with
K = 64
MOST_K = 256
CELL_VECTORS = 256
#: entries of the table of a block of vectors by cells
TABLE = 1 << 21
#: vectors that the codebooks are fitted on, in the order of a hash
SAMPLE = 16_384
ROUNDS = 12
#: the number of cells is measured with a block of so many queries, and with
#: further ones (each twice as large, up to MOST_QUERIES or BLOCK_BYTES) until LINKED queries
#: with a link were met; a recall of 0.98 passes 256 of them by luck in 0.6 %
QUERIES = 2048
MOST_QUERIES = 32_768
BLOCK_BYTES = 32 << 20
LINKED = 256
#: the recall to reach
TARGET = 0.999
#: vectors of a dimension that are too few for an index: compared pair by pair
FEW = 256
#: a group's members and queries
MEMBERS = 1024
VISITS = 2048


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = np.argmin((c**2).sum(1) - 2 * x @ c.T, axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


@dataclass(frozen=True)
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    def visits(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest cells of each vector, nearest first (ties by cell
        number)."""
        step = max(1, TABLE // (min(n, len(self.first)) * min(n, len(self.second))))
        if len(x) > step:
            return np.concatenate([self.visits(x[lo : lo + step], n) for lo in range(0, len(x), step)])
        half = x.shape[1] // 2
        a = ((x[:, None, :half] - self.first) ** 2).sum(2)
        b = ((x[:, None, half:] - self.second) ** 2).sum(2)
        k = len(self.second)
        # a cell among the n nearest has fewer than n halves before either of its own
        m = min(n, len(self.first)), min(n, k)
        ia, ib = np.argsort(a, axis=1, kind="stable")[:, : m[0]], np.argsort(b, axis=1, kind="stable")[:, : m[1]]
        sums = (np.take_along_axis(a, ia, 1)[:, :, None] + np.take_along_axis(b, ib, 1)[:, None, :]).reshape(len(x), -1)
        cells = (ia[:, :, None] * k + ib[:, None, :]).reshape(len(x), -1)
        order = np.lexsort((cells, sums), axis=1)[:, :n]
        return np.take_along_axis(cells, order, 1)


def fit(sample: np.ndarray, k: int = K) -> Codebooks:
    half = sample.shape[1] // 2
    k = max(1, min(k, int(len(sample) ** 0.5)))
    return Codebooks(_kmeans(sample[:, :half], k, 1), _kmeans(sample[:, half:], k, 2))


def _matrix(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float64).reshape(len(column), -1)


def unit_vectors(df: DataFrame, vec_col: str, id_col: str) -> DataFrame:
    """(id, dim, digest, unit) of each row; digest and unit are null for a
    vector that links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, digests, units = [], [], []
            for v in b.column(1).to_pylist():
                x = np.array([np.nan if c is None else c for c in v or ()], dtype=np.float64)
                top = np.abs(x).max(initial=0.0)
                if not np.isfinite(x).all() or not top > 0:
                    dims.append(None), digests.append(None), units.append(None)
                    continue
                x = x / top  # no overflow in the norm
                dims.append(len(x)), digests.append(xxhash.xxh3_128_digest((x + 0.0).tobytes()))
                units.append((x / np.sqrt((x * x).sum())).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(units, pa.binary())], names=["id", "dim", "digest", "unit"])

    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    return slim.mapInArrow(run, "id long, dim int, digest binary, unit binary")


def _sample(vectors: DataFrame, n: int, seed: int, after: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, tuple[int, int] | None]:
    """Nodes and units of the ``n`` vectors that follow ``after`` in the order
    of a hash, and the place of the last."""
    told = vectors.select("node", "unit", F.xxhash64(F.lit(seed), "digest").alias("o"))
    if after is not None:
        told = told.where((F.col("o") > after[0]) | ((F.col("o") == after[0]) & (F.col("node") > after[1])))
    rows = told.orderBy("o", "node").limit(n).collect()
    place = (rows[-1]["o"], rows[-1]["node"]) if rows else after
    return np.array([r["node"] for r in rows], np.int64), np.array([np.frombuffer(r["unit"]) for r in rows]), place


def _shares(vectors: DataFrame, books: Codebooks, nodes: np.ndarray, asked: np.ndarray, threshold: float, most: int) -> tuple[np.ndarray, int]:
    """The share of a query's links, by brute force, whose homes are among its
    1, 2, ... ``most`` nearest cells, added up over the queries that have a
    link, and the number of these."""
    shared = vectors.sparkSession.sparkContext.broadcast((nodes, asked, books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q, own = shared.value
        homes: dict[tuple[int, int], int] = {}
        for b in batches:
            ids, x = b.column(0).to_numpy(), _matrix(b.column(1))
            home = own.visits(x, 1)[:, 0]
            for at in range(0, len(q), QUERIES):
                close = q[at : at + QUERIES] @ x.T >= threshold
                close &= names[at : at + QUERIES, None] != ids[None, :]
                i, j = np.nonzero(close)
                for key in zip((i + at).tolist(), home[j].tolist(), strict=True):
                    homes[key] = homes.get(key, 0) + 1
        rows = [(*k, n) for k, n in homes.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["q", "cell", "n"])

    found = vectors.select("node", "unit").mapInArrow(run, "q long, cell long, n long").groupBy("q", "cell").agg(F.sum("n").alias("n")).toPandas()
    q, cell, n = (found[c].to_numpy(dtype=np.int64) for c in ("q", "cell", "n"))
    linked = np.unique(q)
    row = np.searchsorted(linked, q)
    total = np.zeros(most)
    for lo in range(0, len(linked), 128):
        order = books.visits(asked[linked[lo : lo + 128]], most)
        ranks = np.zeros((len(order), most + 1))
        at = np.nonzero((row >= lo) & (row < lo + 128))[0]
        for block in np.array_split(at, len(at) // 10_000 + 1):
            hit = order[row[block] - lo] == cell[block][:, None]
            np.add.at(ranks, (row[block] - lo, np.where(hit.any(1), hit.argmax(1), most)), n[block])
        total += (np.cumsum(ranks[:, :-1], axis=1) / ranks.sum(1, keepdims=True)).sum(0)
    return total, len(linked)


def cells_to_visit(vectors: DataFrame, books: Codebooks, threshold: float, target: float) -> tuple[int, float, int]:
    """The fewest cells (a power of two) that find the target share of a query
    sample's links (mean over queries), that share, and the number of queries
    with a link that it was measured with.  Fewer than LINKED of them means
    that every vector was asked."""
    most = len(books.first) * len(books.second)  # all cells: the exact search
    block, after, linked, total = QUERIES, None, 0, np.zeros(most)
    while linked < LINKED:
        nodes, asked, after = _sample(vectors, block, 11, after)
        if not len(asked):
            break
        more, n = _shares(vectors, books, nodes, asked, threshold, most)
        # the mean over queries, so a crowded group does not speak for the rest
        total, linked = total + more, linked + n
        if len(asked) < block:
            break
        block = max(QUERIES, min(2 * block, MOST_QUERIES, BLOCK_BYTES // asked[0].nbytes))
    if not linked:
        return 1, 1.0, 0  # all were asked: there is no link to find
    share = total / linked
    n = 1
    while n < most and share[n - 1] < target:
        n = min(2 * n, most)
    return n, float(share[n - 1]), linked


def _labels(n: int, m: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the two sides of a bipartite graph."""
    left, right = np.arange(n), np.full(m, n + m)
    while True:
        old = left.copy()
        np.minimum.at(right, j, left[i])
        np.minimum.at(left, i, right[j])
        if (left == old).all():
            return left, right


def _all_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, other) of classes that are few per dimension."""

    def compare(x: pd.DataFrame) -> pd.DataFrame:
        a, n, mult = np.array([np.frombuffer(u) for u in x["unit"]]), len(x), x["mult"].to_numpy()
        i, j = np.nonzero(a @ a.T >= threshold)
        links = np.zeros(n, np.int64)
        np.add.at(links, i[i != j], mult[j[i != j]])
        left, _ = _labels(n, n, np.concatenate((i, np.arange(n))), np.concatenate((j, np.arange(n))))
        node = x["node"].to_numpy()
        return pd.DataFrame({"node": node, "links": links, "other": node[left]})

    return classes.select("dim", "node", "mult", "unit").groupBy("dim").applyInPandas(compare, "node long, links long, other long")


def _linked(classes: DataFrame, dim: int, threshold: float, target: float) -> tuple[DataFrame, float]:
    """(node, links, other) of the classes of one dimension, and the recall
    that was measured."""
    spark = classes.sparkSession
    mine = classes.where(F.col("dim") == dim)
    k = min(MOST_K, max(K, math.ceil((mine.count() / CELL_VECTORS) ** 0.5)))
    books = fit(_sample(mine, SAMPLE, 7)[1], k)
    n_cells, recall, _ = cells_to_visit(mine, books, threshold, target)
    shared = spark.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                cells = shared.value.visits(_matrix(part.column(2)), n_cells)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells.tolist(), pa.list_(pa.int32()))], names=["node", "mult", "unit", "cells"])

    told = mine.select("node", "mult", "unit").mapInArrow(assign, "node long, mult long, unit binary, cells array<int>")
    told = materialised(told, "imi-cells")
    homes = told.withColumn("cell", F.col("cells")[0])
    visits = told.withColumn("cell", F.explode("cells"))
    # a crowded cell is split: members and queries meet block by block
    parts = homes.groupBy("cell").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("m"))
    parts = parts.join(visits.groupBy("cell").agg(F.ceil(F.count("*") / VISITS).cast("int").alias("q")), "cell", "left")
    parts = materialised(parts, "imi-blocks")
    member = homes.join(parts, "cell").withColumn("mb", F.pmod(F.xxhash64("node"), F.col("m"))).withColumn("qb", F.explode(F.expr("sequence(0, q - 1)")))
    query = visits.join(parts, "cell").withColumn("qb", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("q"))).withColumn("mb", F.explode(F.expr("sequence(0, m - 1)")))
    cols = [F.col("cell").cast("long").alias("cell"), F.col("mb").cast("long").alias("mb"), F.col("qb").cast("long").alias("qb"), "node", "mult", "unit", "cells"]

    def verify(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "other": pd.Series(dtype="int64")})
        if not len(q) or not len(x):
            return empty
        a = np.array([np.frombuffer(u) for u in q["q_unit"]])
        b = np.array([np.frombuffer(u) for u in x["unit"]])
        qn, xn = q["q_node"].to_numpy(), x["node"].to_numpy()
        close = a @ b.T >= threshold
        close &= qn[:, None] != xn[None, :]
        i, j = np.nonzero(close)
        if not len(i):
            return empty
        # a pair that is found from one side only counts for both here
        back = np.zeros(len(i), bool)
        home = np.array([c[0] for c in q["q_cells"]])[i]
        for t in range(n_cells):
            back |= np.array([c[t] for c in x["cells"]])[j] == home
        links = np.zeros(len(q), np.int64)
        np.add.at(links, i, x["mult"].to_numpy()[j])
        other = np.zeros(len(x), np.int64)
        np.add.at(other, j[~back], q["q_mult"].to_numpy()[i[~back]])
        left, right = _labels(len(q), len(x), i, j)
        li, rj = np.unique(i), np.unique(j)
        return pd.DataFrame(
            {
                "node": np.concatenate((qn[li], xn[rj])),
                "links": np.concatenate((links[li], other[rj])),
                "other": np.concatenate((qn[left[li]], qn[right[rj]])),
            }
        )

    asked = query.select(*cols).toDF("q_cell", "q_mb", "q_qb", "q_node", "q_mult", "q_unit", "q_cells")
    grouped = asked.groupBy("q_cell", "q_mb", "q_qb").cogroup(member.select(*cols).groupBy("cell", "mb", "qb"))
    return materialised(grouped.applyInPandas(verify, "node long, links long, other long"), "imi-found"), recall


def near_duplicates(df: DataFrame, threshold: float = 0.9, target: float = TARGET, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id``, ``kept``, and
    ``recall``, the share of links found that was measured for vectors of its
    dimension (null for a vector that links with nothing).

    Links are the found pairs of rows with cosine >= ``threshold``.  Null, zero
    and empty vectors, and those that hold a null or a non-finite component,
    link with nothing: their component is their own id.  Vectors of different
    dimensions do not link; those of a dimension with few vectors are compared
    pair by pair, the others go through an index of their own.  Identical
    vectors are linked exactly.  ``component_id`` is the smallest id (nulls
    aside); rows that repeat it are all kept.  Other columns are not read.  An
    empty table gives no row.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = materialised(unit_vectors(df, vec_col, id_col), "imi-rows")
    classes = rows.where("digest IS NOT NULL").groupBy("digest", "dim").agg(F.count("*").alias("mult"), F.min("id").alias("least"), F.first("unit").alias("unit"))
    classes = materialised(classes.withColumn("node", F.monotonically_increasing_id()), "imi-classes")
    sizes = materialised(classes.groupBy("dim").agg(F.count("*").alias("n")), "imi-dims")
    told = classes.select("node", "digest", "dim", "mult", "least", F.lit(0).cast("long").alias("links"))
    few = classes.join(sizes.where((F.col("n") > 1) & (F.col("n") <= FEW)).select("dim"), "dim", "left_semi")
    found = materialised(_all_pairs(few, threshold), "imi-few")
    recall = F.lit(1.0)
    # at most vectors / FEW dimensions
    for d in sorted(r["dim"] for r in sizes.where(F.col("n") > FEW).collect()):
        more, share = _linked(classes, d, threshold, target)
        found, recall = found.union(more), F.when(F.col("dim") == d, share).otherwise(recall)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    comps = connected_components(edges)
    least = comps.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("of_component"))
    wide = comps.join(least, "component").select("node", "of_component")
    told = told.drop("links").join(links, "node", "left").join(wide, "node", "left")
    component = F.coalesce("of_component", "least")
    told = told.select("digest", "dim", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), component.alias("c"))
    out = rows.select("id", "digest", "dim").join(told, ["digest", "dim"], "left")
    comp = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("c"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), comp.alias("component_id"), comp.eqNullSafe(F.col("id")).alias("kept"), F.when(F.col("digest").isNotNull(), recall).alias("recall"))
