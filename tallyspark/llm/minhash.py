"""MinHash near-duplicates with tensored bands.

Two small collections of ``BANDS`` hashes, each over ``ROWS`` MinHash values,
are computed per set; a table key is a pair of one hash from each.  BANDS**2
tables thus cost 2 * BANDS * ROWS MinHash values.  Two sets of Jaccard
similarity s meet in some table with probability (1 - (1 - s**ROWS)**BANDS)**2:
0.99998 at 0.85 with 16 bands of 4 rows, and 0.99995 at 0.8 with 20.  Pairs
that meet are verified on the full shingle sets.

Work is on distinct sets, so copies cost one row each.  A key is kept only if
both its halves are shared by another set.  Inside a table bucket, sets are
compared with one representative.  Where that leaves members in different
components, the members of such buckets form families, and what the
representatives did not cover is compared with its whole family in bounded
blocks.  No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import hot_rows, in_blocks, materialised, release, small_batches, utf8
from tallyspark.llm.graph import connected_components

BANDS = 16
ROWS = 4
SEED = 20240601
#: texts hashed together (bounds the arrays of a task)
BLOCK_BYTES = 2 << 20
#: distinct words whose hashes a task keeps
HELD_WORDS = 500_000
#: pairs of one set that a task gets at least
GROUP_PAIRS = 1_000
#: sets on either side of a block of comparisons, their bytes, and hashes
#: compared at once
BLOCK_SETS = 2048
SIDE_BYTES = 16 << 20
SLICE = 4096


@dataclass(frozen=True)
class Params:
    shingle: int
    #: link when 100 * intersection >= percent * union
    percent: int
    bands: int = BANDS
    rows: int = ROWS

    @property
    def multipliers(self) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        return rng.integers(0, 2**63, 2 * self.bands * self.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Word -> 64-bit hash, forgotten when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` word hashes."""
    h = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        h = _mix(h) + words[i : len(words) - n + 1 + i] * np.uint64(0x9E3779B97F4A7C15)
    return _mix(h)


def shingle_set(text: str | None, n: int, cache: _Words) -> np.ndarray:
    """Sorted distinct shingle hashes.  Words are runs of other characters than
    ASCII white space, A-Z in lower case; a text of fewer than ``n`` words is
    one shingle, one without words the empty set."""
    words = utf8(text).lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((cache[w] for w in words), np.uint64, len(words))
    # the number of words is part of a short sequence's hash
    return np.unique(shingle_hashes(h, n) if len(words) >= n else shingle_hashes(h + np.uint64(len(words)), len(words)))


def _half_keys(sets: list[np.ndarray], p: Params) -> np.ndarray:
    """len(sets) x (2 * bands) hashes of the bands of MinHash values."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = np.empty((2 * p.bands, len(sets)), np.uint64)
    a = p.multipliers
    for band in range(2 * p.bands):
        h = np.full(len(sets), band + 1, np.uint64)
        for r in range(p.rows):
            h = _mix(h) + np.minimum.reduceat(flat * a[band * p.rows + r], starts) * np.uint64(0x9E3779B97F4A7C15)
        keys[band] = _mix(h)
    return keys.T


def sketches(df: DataFrame, p: Params, id_col: str, text_col: str, carry: tuple[Column, ...] = ()) -> DataFrame:
    """(doc_id, n, sig, halves, *carry) per row: set size, 128-bit digest of
    the set, and its 2 * bands half keys; sig and halves are null for an empty
    set."""
    small_batches(df.sparkSession)
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *carry)
    carried = slim.schema.fields[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            at = 0
            for block in in_blocks(rows, lambda r: len(r[1] or ""), BLOCK_BYTES):
                own, at = b.slice(at, len(block)).columns[2:], at + len(block)
                sets = [shingle_set(t, p.shingle, cache) for _, t in block]
                full = [s for s in sets if len(s)]
                halves = iter(_half_keys(full, p).view(np.int64).tolist() if full else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in block], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(halves) if len(s) else None for s in sets], pa.list_(pa.int64())),
                        *own,
                    ],
                    names=["doc_id", "n", "sig", "halves", *(f.name for f in carried)],
                )

    schema = T.StructType.fromDDL("doc_id long, n long, sig binary, halves array<long>")
    return slim.mapInArrow(run, T.StructType([*schema.fields, *carried]))


def _sets(df: DataFrame, wanted: DataFrame, p: Params, id_col: str, text_col: str) -> DataFrame:
    """(sig, shingles) of the wanted classes (doc_id, sig), from the texts of
    one document each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for b in batches:
            sigs, sets = [], []
            for text, sig in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingle_set(text, p.shingle, cache).tobytes()
                if xxhash.xxh3_128_digest(s) == sig:  # else another text under the same id
                    sigs.append(sig)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())], names=["sig", "shingles"])

    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = slim.join(wanted.withColumnRenamed("doc_id", "w"), F.col("doc_id").eqNullSafe(F.col("w"))).select("text", "sig")
    return found.mapInArrow(run, "sig binary, shingles binary").groupBy("sig").agg(F.first("shingles").alias("shingles"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common): sizes of the intersections of the full sets."""

    @F.pandas_udf(T.LongType())
    def common(x, y):
        import pandas as pd

        return pd.Series(
            [len(np.intersect1d(np.frombuffer(i, np.uint64), np.frombuffer(j, np.uint64), assume_unique=True)) for i, j in zip(x, y, strict=True)],
            dtype="int64",
        )

    # the pairs of a set that very many others are compared with are dealt over
    # salts; at most 20 sets a partition, 40 bytes each
    most = hot_rows(pairs.count(), GROUP_PAIRS, pairs.sparkSession)
    hot = pairs.groupBy("a").agg(F.count("*").alias("k")).where(F.col("k") > most)
    hot = F.broadcast(hot.select("a", F.ceil(F.col("k") / most).cast("int").alias("salts")))
    dealt = F.coalesce(F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"), F.lit(0))
    left = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("x")).join(hot, "a", "left")
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    right = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("y"))
    salted = pairs.join(hot, "a", "left").withColumn("salt", dealt).drop("salts")
    return salted.join(left, ["a", "salt"]).join(right, "b").select("a", "b", "na", "nb", common("x", "y").alias("common"))


def _long_enough(m: Column, n: Column, percent: int) -> Column:
    return F.least(m, n) * 100 >= F.greatest(m, n) * percent


def _pairs(rows: DataFrame, p: Params) -> DataFrame:
    """Distinct unordered pairs of (a, na, b, nb) whose lengths allow a link."""
    swap = F.col("a") > F.col("b")
    return (
        rows.where("a <> b")
        .where(_long_enough(F.col("na"), F.col("nb"), p.percent))
        .select(
            F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"),
            F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"),
            F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
            F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"),
        )
        .distinct()
    )


def set_links(docs: DataFrame, classes: DataFrame, p: Params, id_col: str, text_col: str) -> DataFrame | None:
    """Edges (a, b) between classes of equal sets whose components are those
    of all links that the tables find; None where no key is shared."""
    half = classes.select("sig", "n", F.posexplode("halves").alias("band", "h"))
    shared = half.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h")
    live = half.join(shared, "h").groupBy("sig", "n").agg(F.collect_list(F.struct("band", "h")).alias("hs"))
    first = F.filter("hs", lambda x: x["band"] < p.bands)
    second = F.filter("hs", lambda x: x["band"] >= p.bands)
    live = live.where((F.size(first) > 0) & (F.size(second) > 0))
    keyed = (
        live.select("sig", "n", F.explode(first).alias("x"), second.alias("ys"))
        .select("sig", "n", "x", F.explode("ys").alias("y"))
        .select("sig", "n", F.xxhash64("x.h", "y.h").alias("key"))
    )
    keyed = materialised(keyed, "minhash-keys")
    full = keyed.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    buckets = materialised(keyed.join(full, "key"), "minhash-buckets")
    release(keyed)
    if buckets.isEmpty():
        return None
    wanted = classes.join(buckets.select("sig").distinct(), "sig").select("doc_id", "sig")
    sets = materialised(_sets(docs, wanted, p, id_col, text_col), "minhash-sets")

    def linked(d: DataFrame) -> DataFrame:
        return d.where(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * p.percent).select("a", "b")

    # every member against its bucket's representative
    rep = buckets.groupBy("key").agg(F.min(F.struct("sig", "n")).alias("rep"))
    rep = rep.select("key", F.col("rep.sig").alias("a"), F.col("rep.n").alias("na"))
    star = buckets.join(rep, "key").select("key", "a", "na", F.col("sig").alias("b"), F.col("n").alias("nb"))
    links = materialised(linked(_verified(materialised(_pairs(star, p), "minhash-pairs"), sets)), "minhash-links")
    either = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumn("hit", F.lit(True))
    strays = star.where("a <> b").join(either, ["a", "b"], "left").where("hit IS NULL").select("key", F.col("b").alias("sig"))
    strays = materialised(strays, "minhash-strays")
    comps = materialised(connected_components(links).withColumnRenamed("node", "sig"), "minhash-components")
    # open buckets hold a stray, a third member, and more than one component
    told = buckets.join(strays.select("key").distinct(), "key", "left_semi").join(comps, "sig", "left")
    told = told.select("key", "sig", "n", F.coalesce("component", "sig").alias("c"))
    open_ = told.groupBy("key").agg(F.count("*").alias("k"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("sig").alias("least"))
    open_ = materialised(told.join(open_.where("k > 2 AND lo <> hi").select("key", "least"), "key"), "minhash-open")
    if not open_.isEmpty():
        families = connected_components(open_.select(F.col("sig").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "sig")
        members = open_.select("sig", "n", "c").distinct().join(families.withColumnRenamed("component", "family"), "sig")
        asked = strays.join(open_.select("key").distinct(), "key", "left_semi").select("sig").distinct()
        links = links.union(_across(members, asked, sets, p))
    release(buckets, strays)
    return links


def common_sizes(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``xs`` with every one of
    ``ys`` (sorted distinct hashes), in slices of the hashes that both have."""
    hx, hy = np.concatenate(xs), np.concatenate(ys)
    ix, iy = np.repeat(np.arange(len(xs)), [len(x) for x in xs]), np.repeat(np.arange(len(ys)), [len(y) for y in ys])
    both = np.intersect1d(hx, hy)
    out = np.zeros((len(xs), len(ys)), np.float32)
    if not len(both):
        return out
    px, py = np.searchsorted(both, hx), np.searchsorted(both, hy)
    okx, oky = both[np.minimum(px, len(both) - 1)] == hx, both[np.minimum(py, len(both) - 1)] == hy
    ix, px, iy, py = ix[okx], px[okx], iy[oky], py[oky]
    ox, oy = np.argsort(px, kind="stable"), np.argsort(py, kind="stable")
    ix, px, iy, py = ix[ox], px[ox], iy[oy], py[oy]
    for lo in range(0, len(both), SLICE):
        x0, x1 = np.searchsorted(px, (lo, lo + SLICE))
        y0, y1 = np.searchsorted(py, (lo, lo + SLICE))
        a, b = np.zeros((len(xs), SLICE), np.float32), np.zeros((len(ys), SLICE), np.float32)
        a[ix[x0:x1], px[x0:x1] - lo] = 1
        b[iy[y0:y1], py[y0:y1] - lo] = 1
        out += a @ b.T
    return out


def _across(members: DataFrame, asked: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Edges that join components: every asked set against the members
    (sig, n, c, family) of its family, in blocks of both.  A block compares
    full sets in numpy and returns spanning edges, not pairs.  A set is moved
    once per opposite block, so what Spark moves grows with the square of a
    family's size over that of a block."""
    asked = members.join(asked, "sig", "left_semi")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") * 8 / SIDE_BYTES)).cast("int")
    parts = members.groupBy("family").agg(blocks.alias("m"))
    parts = materialised(parts.join(asked.groupBy("family").agg(blocks.alias("q")), "family"), "minhash-blocks")

    def dealt(rows: DataFrame, own: str, other: str, salt: int) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(salt), "sig"), F.col(own)).cast("int")
        return rows.join(parts, "family").withColumn("own", block).withColumn("other", F.explode(F.expr(f"sequence(0, {other} - 1)"))).join(sets, "sig")

    x = dealt(members, "m", "q", 1).select("family", F.col("own").alias("mb"), F.col("other").alias("qb"), "sig", "c", "shingles")
    y = dealt(asked, "q", "m", 2).select(
        F.col("family").alias("qfamily"), F.col("other").alias("qmb"), F.col("own").alias("qqb"), F.col("sig").alias("qsig"), F.col("c").alias("qc"), F.col("shingles").alias("qshingles")
    )

    def compare(m, q):
        import pandas as pd

        none = pd.DataFrame({"a": pd.Series(dtype=object), "b": pd.Series(dtype=object)})
        if not len(m) or not len(q):
            return none
        xs, ys = [np.frombuffer(s, np.uint64) for s in m["shingles"]], [np.frombuffer(s, np.uint64) for s in q["qshingles"]]
        common = common_sizes(xs, ys).astype(np.int64)
        total = np.array([len(s) for s in xs])[:, None] + np.array([len(s) for s in ys])[None, :] - common
        i, j = np.nonzero(common * 100 >= total * p.percent)
        a, b = m["sig"].to_numpy()[i], q["qsig"].to_numpy()[j]
        # one edge for each pair of components that meet here
        ca, cb = m["c"].to_numpy()[i], q["qc"].to_numpy()[j]
        edges = {(min(u, v), max(u, v)): (s, t) for u, v, s, t in zip(ca, cb, a, b, strict=True) if u != v}
        return pd.DataFrame(list(edges.values()), columns=["a", "b"]) if edges else none

    met = x.groupBy("family", "mb", "qb").cogroup(y.groupBy("qfamily", "qmb", "qqb")).applyInPandas(compare, "a binary, b binary")
    return materialised(met, "minhash-across")


def components(df: DataFrame, p: Params, id_col: str = "doc_id", text_col: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """(doc_id, n, sig, component, least, *carry) per row: ``component`` is
    the digest of one set of the component and ``least`` its smallest id,
    nulls aside; all three are null for an empty set."""
    rows = materialised(sketches(df, p, id_col, text_col, carry), "minhash-sketches")
    classes = (
        rows.where("sig IS NOT NULL")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("halves").alias("halves"))
    )
    classes = materialised(classes, "minhash-classes")
    links = set_links(df, classes, p, id_col, text_col)
    ids = classes.select("sig", F.col("doc_id").alias("least"), F.col("sig").alias("component"))
    if links is not None:
        comps = connected_components(links)
        of = ids.drop("component").join(comps.withColumnRenamed("node", "sig"), "sig")
        least = of.groupBy("component").agg(F.min("least").alias("of_component"))
        wide = of.join(least, "component").select("sig", "of_component", F.col("component").alias("joined"))
        ids = ids.join(wide, "sig", "left").select("sig", F.coalesce("of_component", "least").alias("least"), F.coalesce("joined", "component").alias("component"))
    return rows.drop("halves").join(ids, "sig", "left")


def near_duplicates(df: DataFrame, p: Params, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Equal sets are always linked.  A null or empty text, or one without words,
    has the empty set and is linked with nothing: its component is its own id.
    ``component_id`` is the smallest id of the component (nulls aside), and
    ``kept`` says whether it is the row's own id; rows that repeat the smallest
    id are all kept, a row of null id only in a component without other ids
    (null-safe comparison).  Other input columns are not read.  An empty table
    gives no row.
    """
    out = components(df, p, id_col, text_col)
    component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select(
        F.col("doc_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
