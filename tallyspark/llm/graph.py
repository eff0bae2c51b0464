"""Connected components by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import hot_rows, materialised, release

#: edges that a task contracts at once (bounds its memory)
HELD_EDGES = 200_000
#: a node with more edges, and more than a twentieth of a partition's, is a hub
HUB_EDGES = 1_000


def _spanning_stars(edges: list[tuple]) -> dict:
    """Node -> smallest node that these edges reach, for the other nodes."""
    parent: dict = {}

    def root(n):
        while (up := parent.get(n, n)) != n:
            parent[n] = parent.get(up, up)
            n = up
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in parent}


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges (a written table) dealt to tasks in runs of ``HELD_EDGES``,
    every run as spanning stars: the same components in fewer edges and
    shorter paths.  Up to one run of edges, these are the components."""
    n = -(-edges.count() // HELD_EDGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kind = None

        def stars() -> pa.RecordBatch:
            found = _spanning_stars(held)
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), kind), pa.array(found.values(), kind)], names=["a", "b"])

        for batch in batches:
            kind = batch.schema.field(0).type
            held.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            if len(held) >= HELD_EDGES:
                yield stars()
                held.clear()
        if held:
            yield stars()

    out = edges.repartition(max(1, n)).mapInArrow(run, edges.schema)
    return materialised(out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-stars")


def _with_least(edges: DataFrame, least: DataFrame, hub_edges: int) -> DataFrame:
    """``edges`` with ``m`` of ``least`` (a, k, m).  A hub's edges stay where
    they are: there are few hubs, so theirs are broadcast."""
    hubs = least.where(F.col("k") > hub_edges).select("a", "m")
    rest = least.where(F.col("k") <= hub_edges).select("a", "m")
    of_hubs = edges.join(F.broadcast(hubs), "a")
    return of_hubs.union(edges.join(F.broadcast(hubs), "a", "left_anti").join(rest, "a").select(of_hubs.columns))


def _all_stars(edges: DataFrame) -> bool:
    """Whether no node is both a leaf and a centre, or a leaf of two centres."""
    ends = edges.select(
        F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("centre")), F.struct(F.col("b").alias("node"), F.col("b").alias("centre")))).alias("e")
    ).select("e.*")
    # a leaf knows its centre only, a centre itself only
    told = ends.groupBy("node").agg(F.min("centre").alias("lo"), F.max("centre").alias("hi"))
    return told.where("lo <> hi").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, component)``: every node that an edge names,
    with the smallest node it reaches.

    Each round links a node's larger neighbours to the smallest node of its
    neighbourhood, then its smaller ones (large star, small star), until only
    stars are left: a number of rounds logarithmic in the nodes.  Before each
    round every task contracts its share of the edges.  A node's smallest
    neighbour is found by a pre-aggregated group; those of hubs (at most 40 a
    partition) are broadcast back, so a node with very many neighbours is no
    group in one task.  Rounds are written tables in the shared folder.
    Self-loops, repeated edges, either direction and nulls (dropped) are
    allowed; no edge gives no row.
    """
    spread = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    now = materialised(spread, "cc-edges")
    stars = _contracted(now)
    release(now)
    while not _all_stars(stars):
        hub = hot_rows(stars.count(), HUB_EDGES, stars.sparkSession)
        both = stars.select("a", "b").union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.count("*").alias("k"), F.min("b").alias("m")).select("a", "k", F.least("a", "m").alias("m"))
        large = _with_least(both.where("b > a"), least, hub).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialised(large, "cc-large")
        least = large.groupBy("a").agg(F.count("*").alias("k"), F.min("b").alias("m"))
        small = (
            _with_least(large, least, hub)
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        small = materialised(small, "cc-round")
        before, stars = stars, _contracted(small)
        release(before, large, small)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
