"""Removal of repeated 100-byte strings by hashed windows.

This is not the difference-cover suffix sort: no triples of suffixes are
sorted, no names are recursed on, and no neighbours in suffix order are
compared (README).  Windows are grouped by hashes of their bytes instead, at
positions that the content chooses: a window's sampled position is its
smallest hashed 20-gram, so equal windows agree on it wherever they stand.

1. Sampled positions are named by their gram; a gram that occurs once cannot
   lie in a repeated window, and its windows are done.
2. The windows of one sampled position form a run.  Runs are named by the bytes
   they span; of equal runs all but the first are removed whole.
3. Of the distinct runs that share a gram, pieces of 8 windows are named in the
   same way, and where those differ but share their common core, the single
   windows are.  Of equal names, all but the first in text order are removed.

Names are 128-bit hashes of the bytes.  Groups are counted and their first
member found by pre-aggregated groups that are joined back, so a gram, line or
passage in a third of all documents is no group in one task; the gram's rows
meet the list of shared grams salted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import hot_rows, in_blocks, materialised, release, shuffle_partitions, small_batches

WINDOW = 100
GRAM = 20
#: windows of a run start at most this far before its sampled position
REACH = WINDOW - GRAM
PIECE = 8
_MASK = np.uint64((1 << 21) - 1)
#: bytes hashed together (their arrays stay in a core's cache); positions
#: inside a block fit 21 bits
BLOCK = 1 << 16
#: rows of one gram that a join takes to one task at least
HOT = 10_000
#: a longer document is hashed in overlapping parts
PART = 1 << 20


def _mix(h):
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Hash of the ``n`` bytes from each position, by doubling."""
    step = np.uint64(0xD6E8FEB86659FD93)
    h, width = _BYTE[data], 1
    out, done = None, 0
    m = len(data) - n + 1
    while True:
        if n & width:
            part = h[done : done + m]
            out = part.copy() if out is None else out * step + _mix(part)
            done += width
        if done == n:
            return _mix(out)
        h = h[:-width] * step + _mix(h[width:])
        width *= 2


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    m, width = a, 1
    while width * 2 <= w:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[: len(a) - w + 1], m[w - width : w - width + len(a) - w + 1]) if width < w else m


def runs(data: np.ndarray, starts: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Runs of windows with the same sampled position.  ``starts``: offsets of
    the documents in ``data``, with its end.  Returns gram hash, document
    number, sampled position, first and last window (offsets in ``data``)."""
    if len(data) < window:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, z, z
    h = gram_hashes(data, gram)
    key = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
    low = sliding_min(key, window - gram + 1)
    anchor = (low & _MASK).astype(np.int64)
    p = np.arange(len(anchor))
    size = np.diff(starts)
    doc = np.repeat(np.arange(len(size)), size)[: len(p)]
    ok = p + window <= np.repeat(starts[1:], size)[: len(p)]
    p, doc, anchor = p[ok], doc[ok], anchor[ok]
    if not len(p):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, z, z
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
    last = np.concatenate((new[1:], [len(p)])) - 1
    return h[anchor[new]], doc[new], anchor[new], p[new], p[last]


def _parts(rows: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
    """(doc, offset, bytes): long documents in parts that share WINDOW - 1 bytes."""
    for doc, data in rows:
        for at in range(0, max(1, len(data) - WINDOW + 1), PART):
            yield doc, at, data[at : at + PART + WINDOW - 1]


def _pack(x, near, far):
    """Sampled position, and the nearest and farthest window start before it."""
    return (x << 14) | (near << 7) | far


def sampled_runs(docs: DataFrame) -> DataFrame:
    """(h, doc, run) of all runs of ``docs(doc, data)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, t) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if t and len(t) >= WINDOW]
            for block in in_blocks(list(_parts(rows)), lambda r: len(r[2]), BLOCK):
                data = np.frombuffer(b"".join(t for _, _, t in block), np.uint8)
                starts = np.cumsum([0] + [len(t) for _, _, t in block])
                h, doc, x, first, last = runs(data, starts)
                shift = np.array([at for _, at, _ in block], dtype=np.int64)[doc] - starts[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(np.array([d for d, _, _ in block], dtype=np.int64)[doc]),
                        pa.array(_pack(x + shift, x - last, x - first)),
                    ],
                    names=["h", "doc", "run"],
                )

    return docs.mapInArrow(run, "h long, doc long, run long")


def _of_docs(docs: DataFrame, wanted: DataFrame, cols: list[str]) -> DataFrame:
    """(doc, data, found) of the documents that ``wanted`` names, with the list
    of its rows for each (bounded by the document's own length)."""
    found = wanted.groupBy("doc").agg(F.collect_list(F.struct(*cols)).alias("found"))
    return docs.join(found, "doc")


def _named(docs: DataFrame, live: DataFrame) -> DataFrame:
    """(doc, run, c, s1, s2): the name of the bytes that each run spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, data, found in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                pos = [f["run"] for f in found]
                names = b"".join(
                    xxhash.xxh3_128_digest(data[(r >> 14) - (r & 127) : (r >> 14) + WINDOW - ((r >> 7) & 127)] + bytes(((r >> 7) & 127, r & 127)))
                    for r in pos
                )
                two = np.frombuffer(names, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(pos), pa.int64()), pa.array(pos, pa.int64()), pa.array([f["h"] for f in found], pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1])],
                    names=["doc", "run", "c", "s1", "s2"],
                )

    return _of_docs(docs, live, ["h", "run"]).mapInArrow(run, "doc long, run long, c long, s1 long, s2 long")


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, run, bytes): the bytes that each run spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, data, found in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                pos = [f["run"] for f in found]
                spans = [data[(r >> 14) - (r & 127) : (r >> 14) + WINDOW - ((r >> 7) & 127)] for r in pos]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(pos), pa.int64()), pa.array(pos, pa.int64()), pa.array(spans, pa.binary())],
                    names=["doc", "run", "bytes"],
                )

    return _of_docs(docs, wanted, ["run"]).mapInArrow(run, "doc long, run long, bytes binary")


def _split(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``names(doc, run, c, s1, s2)``: the rows whose name occurs earlier
    (doc, run), and the first rows of names that share their core ``c`` with
    another name (doc, run)."""
    # one position has one name per level, so (doc, run) orders the members
    groups = names.groupBy("s1", "s2").agg(F.min(F.struct("doc", "run")).alias("first"), F.first("c").alias("c"), F.count("*").alias("k"))
    groups = materialised(groups.select("s1", "s2", "c", "k", F.col("first.doc").alias("fdoc"), F.col("first.run").alias("frun")), "substr-groups")
    again = names.join(groups.where("k > 1").select("s1", "s2", "fdoc", "frun"), ["s1", "s2"]).where("doc <> fdoc OR run <> frun")
    again = materialised(again.select("doc", "run"), "substr-again")
    cores = groups.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c")
    unsure = materialised(groups.join(cores, "c").select(F.col("fdoc").alias("doc"), F.col("frun").alias("run")), "substr-unsure")
    release(groups, names)
    return again, unsure


def _pieces(ctx: DataFrame, size: int) -> DataFrame:
    """Names of the pieces of ``size`` windows of (doc, run, bytes, near, far):
    near..far is the part of the run that is still open."""
    near, far = "shiftright(run, 7) & 127", "run & 127"
    lo, hi = f"greatest({size} * j, a)", f"least({size} * j + {size - 1}, b)"
    cut = ctx.selectExpr("doc", "run", "bytes", f"cast({far} as int) AS f", "a", "b", f"explode(sequence(a div {size}, b div {size})) AS j0")
    cut = cut.selectExpr("doc", "run", "bytes", "f", "a", "b", "cast(j0 as int) AS j").selectExpr("*", f"cast({lo} as int) AS lo", f"cast({hi} as int) AS hi")
    cut = cut.selectExpr(
        "doc",
        "(shiftright(run, 14) * 16384 + lo * 128 + hi) AS run",
        f"substring(bytes, f - hi + 1, {WINDOW} + hi - lo) AS whole",
        f"substring(bytes, f - {size} * j + 1, {WINDOW + 1 - size}) AS core",
        "j",
        "lo",
        "hi",
    )
    return cut.selectExpr("doc", "run", "xxhash64(core, j) AS c", "xxhash64(whole, lo, hi) AS s1", "xxhash64(7L, lo, hi, whole) AS s2")


def _of_shared(every: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows of grams that occur again.  The few grams of very many rows
    are broadcast, so their rows stay in place."""
    most = hot_rows(every.count(), HOT, every.sparkSession)
    hot = F.broadcast(shared.where(F.col("k") > most).select("h"))
    rest = shared.where(F.col("k") <= most).select("h")
    return every.join(hot, "h", "left_semi").unionByName(every.join(hot, "h", "left_anti").join(rest, "h", "left_semi"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc, start, stop): byte ranges of ``docs(doc, data)`` that are covered
    by 100-byte strings which also start earlier; ranges may overlap."""
    every = materialised(sampled_runs(docs), "substr-runs")
    shared = materialised(every.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "substr-shared")
    # of equal documents only the first is compared; the others go whole
    data = F.col("data")
    same = docs.where(F.octet_length(data) >= WINDOW).groupBy(F.xxhash64(data).alias("x1"), F.xxhash64(F.lit(7), data).alias("x2"), F.octet_length(data).alias("n"))
    firsts = same.agg(F.min("doc").alias("first"), F.count("*").alias("k")).where("k > 1")
    thin = docs.where(F.octet_length(data) >= WINDOW).select("doc", F.xxhash64(data).alias("x1"), F.xxhash64(F.lit(7), data).alias("x2"), F.octet_length(data).alias("n"))
    copies = materialised(thin.join(firsts, ["x1", "x2", "n"]).where("doc <> first").select("doc", "n"), "substr-copies")
    live = materialised(_of_shared(every, shared).join(copies.select("doc"), "doc", "left_anti"), "substr-live")

    release(every, shared)
    names = materialised(_named(docs, live), "substr-names")
    release(live)
    again, unsure = _split(names)
    out = [again]
    contexts = materialised(_contexts(docs, unsure), "substr-contexts")
    release(unsure)
    ctx = contexts.selectExpr("*", "shiftright(run, 7) & 127 AS a", "run & 127 AS b")
    again, unsure = _split(materialised(_pieces(ctx, PIECE), "substr-pieces"))
    out.append(again)
    # the windows of open pieces, from the run that holds them
    open_ = unsure.selectExpr("doc", "shiftright(run, 14) AS x", "shiftright(run, 7) & 127 AS a", "run & 127 AS b")
    wide = ctx.selectExpr("doc", "run", "bytes", "shiftright(run, 14) AS x", "a AS ra", "b AS rb")
    inner = wide.join(open_, ["doc", "x"]).where("a >= ra AND b <= rb").select("doc", "run", "bytes", "a", "b")
    single = _pieces(inner, 1)
    groups = materialised(single.groupBy("s1", "s2").agg(F.min(F.struct("doc", "run")).alias("first"), F.count("*").alias("k")).where("k > 1"), "substr-windows")
    again = single.join(groups, ["s1", "s2"]).where("doc <> first.doc OR run <> first.run").select("doc", "run")
    out.append(again)
    ranges = [
        r.selectExpr("doc", "shiftright(run, 14) - (run & 127) AS start", f"shiftright(run, 14) - (shiftright(run, 7) & 127) + {WINDOW} AS stop") for r in out
    ]
    found = ranges[0].union(ranges[1]).union(ranges[2])
    found = materialised(found.union(copies.selectExpr("doc", "0L AS start", "cast(n as long) AS stop")), "substr-ranges")
    release(contexts, groups, copies, unsure, *out[:2])
    return found


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``spans`` (removed [start, stop) byte ranges), ``kept`` (the bytes left).

    A null text is empty; an empty or short text keeps all it has.  Of strings
    that repeat, the one in the smallest id (first start) stays; null ids come
    first.  Rows that share an id are ordered by a hash of their text, and
    identical rows arbitrarily, so one of them keeps the string.  Other input
    columns are not read.  An empty table gives no row.
    """
    small_batches(df.sparkSession)
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("data"))
    clash = slim.groupBy("id").agg(F.count("*").alias("k")).where("k > 1 OR id IS NULL")
    if clash.isEmpty():
        docs = slim.select("id", F.col("id").alias("doc"), "data")
    else:  # ids that do not name one row each: number the rows in their order
        order = ["id", F.xxhash64("data"), "data"]
        ranged = slim.repartitionByRange(shuffle_partitions(df.sparkSession), *order[:2]).sortWithinPartitions(*order)
        docs = materialised(ranged.withColumn("doc", F.monotonically_increasing_id()), "substr-docs")
    ranges = repeated_windows(docs.select("doc", "data"))
    cut = ranges.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, data, found in zip(*[b.column(k).to_pylist() for k in range(3)], strict=True):
                spans: list[list[int]] = []
                for s, e in sorted((f["start"], f["stop"]) for f in found or ()):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(e, spans[-1][1])
                    else:
                        spans.append([s, e])
                edges = [0, *[x for s in spans for x in s], len(data)]
                kept = b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                out.append((i, len(data), len(data) - len(kept), len(spans), spans, kept))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    whole = docs.join(cut, "doc", "left").select("id", "data", "ranges")
    out = whole.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")
    return out.withColumnRenamed("id", id_col)
