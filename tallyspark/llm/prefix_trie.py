"""The trie of conversation prefixes.

1. ``paths``: conversations in turn order, one row per prefix, with a 128-bit
   digest chained over the turns.  A task streams its sorted rows, so a
   conversation of any length holds a constant state.
2. Prefixes are counted.  Those with more than ``limit`` rows below them are
   the crown of the trie; the subtrees below it have at most ``limit`` rows
   and are dealt over shards.  A first turn that very many conversations share
   is in the crown, and its subtrees are dealt apart.
3. Per shard: the distinct digests get slots of a minimal perfect hash, each
   lookup is verified against the digest in its slot, counts are scattered
   into flat arrays by slot, and subtree totals are added up through the array
   of parent slots, deepest first.  Roots of shards hand their totals to the
   crown, which is one more such table, of bounded size.

Ids of the conversations that end at a node are hashed in ascending order as
a stream: inside a shard at once, for the crown as sorted runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import materialised, release, shuffle_partitions, small_batches

ROOT = bytes(16)
#: rows below a node of a shard, at least and at most; shards a partition
LEAST_ROWS, MOST_ROWS = 2_000, 250_000
SHARDS = 8
#: nodes of the crown (about 100 bytes each); the limit is doubled until it fits
CROWN_NODES = 500_000
#: ids in a run of the crown's ends
RUN_IDS = 4096
OUT_ROWS = 8192
#: turns that another conversation may lend
MOST_LENT = 8

Graft = Callable[[int], tuple[int, int]]


def no_graft(c: int) -> tuple[int, int]:
    return c, 0


# --- paths -----------------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, size): a null role or text is empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(both, 256)), 1, 16)
    slim = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    return slim.where("conv_id IS NOT NULL")


PATHS = "conv_id long, depth long, prefix binary, parent binary, size long, rest long, last boolean, shard long"


class _Walk:
    """Turns in order of (family, conv_id, turn) to prefix rows."""

    def __init__(self, graft: Graft, crown: dict | None, n_shards: int):
        self.graft, self.crown, self.n_shards = graft, crown, n_shards
        self.family = self.conv = None
        self.lent: list[tuple[bytes, int]] = []
        self.out: list[tuple] = []

    def start(self, family: int, conv: int, n_own: int) -> None:
        if family != self.family:
            self.family, self.lent = family, []
        self.conv, self.seen = conv, 0
        base, self.h = self.graft(conv)
        self.own_base = base == conv
        borrowed = [] if self.own_base else self.lent[: self.h]
        self.skip = 0 if self.own_base else self.h
        self.length = len(borrowed) + max(0, n_own - self.skip)
        self.depth, self.at, self.shard = 0, ROOT, None
        self.emit(ROOT, None, 0)
        for digest, size in borrowed:
            self.step(digest, size)

    def turn(self, digest: bytes, size: int) -> None:
        self.seen += 1
        if self.own_base and len(self.lent) < MOST_LENT:
            self.lent.append((digest, size))
        if self.seen > self.skip:
            self.step(digest, size)

    def step(self, digest: bytes, size: int) -> None:
        parent, self.at = self.at, hashlib.sha256(self.at + digest).digest()[:16]
        self.depth += 1
        self.emit(self.at, parent, size)

    def emit(self, prefix: bytes, parent: bytes | None, size: int) -> None:
        last = self.depth == self.length
        if self.crown is not None and self.shard is None:
            if prefix in self.crown:
                if last:
                    self.out.append((self.conv, self.depth, prefix, parent, size, 1, True, None))
                return
            # the first prefix below the crown names the shard
            self.shard = xxhash.xxh3_64_intdigest(prefix) % self.n_shards
        self.out.append((self.conv, self.depth, prefix, parent, size, self.length - self.depth + 1, last, self.shard))


def paths(rows: DataFrame, graft: Graft = no_graft, crown=None, n_shards: int = 1) -> DataFrame:
    """A row per prefix of every conversation.  ``graft(c)`` is (base, h): the
    first h turns of c are those of base, h at most ``MOST_LENT``, base at
    most c, and bases are grafted on nothing.  With a ``crown`` (a broadcast
    dict by prefix), rows of the crown are left out but for last ones, and the
    others carry their shard."""

    def base_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            family = pa.array([graft(c)[0] for c in b.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([family, *b.columns], names=["family", *b.schema.names])

    kind = rows.schema["turn"].dataType.simpleString()
    dealt = rows.mapInArrow(base_of, f"family long, conv_id long, turn {kind}, digest binary, size long").repartition(F.col("family"))
    # how long a conversation is, known before its first turn is walked
    long = dealt.withColumn("n", F.expr("count(*) OVER (PARTITION BY family, conv_id)"))
    ordered = long.sortWithinPartitions("family", "conv_id", F.asc_nulls_first("turn"), "digest").select("family", "conv_id", "n", "digest", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(graft, None if crown is None else crown.value, n_shards)
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("prefix", pa.binary()), ("parent", pa.binary()), ("size", pa.int64()), ("rest", pa.int64()), ("last", pa.bool_()), ("shard", pa.int64())])

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*walk.out, strict=True))
            walk.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for b in batches:
            for family, conv, n, digest, size in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if conv != walk.conv:
                    walk.start(family, conv, n)
                walk.turn(digest, size)
                if len(walk.out) >= OUT_ROWS:
                    yield flushed()
        if walk.out:
            yield flushed()

    return ordered.mapInArrow(run, PATHS)


# --- node tables -----------------------------------------------------------


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    h = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 0xC2B2AE3D27D4EB4F % 2**64))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Slots:
    """A minimal perfect hash of distinct 128-bit digests (n x 2 uint64).

    Level by level the keys left are hashed into a table; those alone in
    their place are done, and their slot is the rank of the place.  The digest
    of every slot is kept, so a lookup of another key is found out.
    """

    GAMMA = 1.5

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, used = keys, 0
        while len(left):
            place = _mixed(left, len(self.levels)) % np.uint64(max(1, int(self.GAMMA * len(left))))
            single = np.bincount(place.astype(np.int64), minlength=max(1, int(self.GAMMA * len(left)))) == 1
            rank = used + np.cumsum(single) - 1
            self.levels.append((single, rank))
            used += int(single.sum())
            left = left[~single[place.astype(np.int64)]]
        self.keys = np.zeros((used, 2), np.uint64)
        self.keys[self._slot(keys)] = keys

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for k, (single, rank) in enumerate(self.levels):
            place = (_mixed(keys[todo], k) % np.uint64(len(single))).astype(np.int64)
            hit = single[place]
            out[todo[hit]] = rank[place[hit]]
            todo = todo[~hit]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots, -1 for keys that are not in the table."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = self._slot(keys)
        return np.where((at >= 0) & (self.keys[at] == keys).all(axis=1), at, -1)


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def _distinct(keys: np.ndarray) -> np.ndarray:
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]).any(axis=1)
    return k[new]


def _accumulate(parent: np.ndarray, depth: np.ndarray, children: np.ndarray, leaves: np.ndarray, saved: np.ndarray) -> None:
    """Adds the totals of the slots to their parents' slots, deepest first.
    ``children`` and ``leaves`` come with what lies outside this table."""
    inside = parent >= 0
    np.add.at(children, parent[inside], 1)
    leaves[children == 0] = 1
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        up = level[parent[level] >= 0]
        np.add.at(leaves, parent[up], leaves[up])
        np.add.at(saved, parent[up], saved[up])


NODES = pa.schema(
    [("prefix", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("handed", pa.bool_())]
)
NODES_SQL = "prefix binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, handed boolean"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _digests(keys: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(keys).tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def _shard_nodes(crown):
    """Rows of a shard to its nodes, and what they hand to the crown
    (``handed`` rows: prefix of the crown's node, children, leaves, saved)."""

    def run(table: pa.Table) -> pa.Table:
        conv, depth, size = (table.column(c).to_numpy() for c in ("conv_id", "depth", "size"))
        prefixes = _keys(table.column("prefix").to_pylist())
        up = table.column("parent").to_pylist()
        slots = Slots(_distinct(prefixes))
        at, n = slots.find(prefixes), len(slots.keys)
        one = np.zeros(n, np.int64)  # a row of each slot
        one[at] = np.arange(len(at))
        n_convs = np.bincount(at, minlength=n).astype(np.int64)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, at, conv)
        above = [up[i] for i in one]
        parent = slots.find(_keys([p or ROOT for p in above]))
        parent[[p is None for p in above]] = -1
        children, leaves = np.zeros(n, np.int64), np.zeros(n, np.int64)
        saved = (n_convs - 1) * size[one]
        _accumulate(parent, depth[one], children, leaves, saved)
        ends = [NO_ENDS] * n
        last = np.flatnonzero(table.column("last").to_numpy(zero_copy_only=False))
        last = last[np.lexsort((conv[last], at[last]))]
        for run_ in np.split(last, np.flatnonzero(np.diff(at[last])) + 1) if len(last) else ():
            ends[at[run_[0]]] = hashlib.sha256(",".join(map(str, conv[run_].tolist())).encode()).hexdigest()
        told = crown.value
        of = [int(least[p]) if p >= 0 else (None if d is None else told[d]) for p, d in zip(parent, above, strict=True)]
        nodes = [_digests(slots.keys), least, depth[one], of, n_convs, children, leaves, saved, ends, np.zeros(n, bool)]
        roots = [i for i in np.flatnonzero(parent < 0) if above[i] is not None]
        zeros = [0] * len(roots)
        handed = [[above[i] for i in roots], zeros, zeros, zeros, zeros, [1] * len(roots), leaves[roots], saved[roots], [""] * len(roots), [True] * len(roots)]
        return pa.Table.from_arrays([pa.chunked_array([pa.array(a, f.type), pa.array(b, f.type)]) for a, b, f in zip(nodes, handed, NODES, strict=True)], schema=NODES)

    return run


def _crown_nodes(table: pa.Table) -> pa.Table:
    """The crown's rows (one per node, with what was handed up) to nodes."""
    keys = _keys(table.column("prefix").to_pylist())
    up = table.column("parent").to_pylist()
    conv, depth, size, n_convs, children, leaves, saved = (table.column(c).to_numpy() for c in ("conv_id", "depth", "size", "n_convs", "h_children", "h_leaves", "h_saved"))
    slots = Slots(keys)
    at = slots.find(keys)
    back = np.argsort(at)  # row of each slot
    above = [up[i] for i in back]
    parent = slots.find(_keys([p or ROOT for p in above]))
    parent[[p is None for p in above]] = -1
    conv, depth, n_convs = conv[back], depth[back], n_convs[back]
    children, leaves, saved = children[back].copy(), leaves[back].copy(), saved[back] + (n_convs - 1) * size[back]
    _accumulate(parent, depth, children, leaves, saved)
    of = [int(conv[p]) if p >= 0 else None for p in parent]
    cols = [_digests(slots.keys), conv, depth, of, n_convs, children, leaves, saved, [NO_ENDS] * len(back), np.zeros(len(back), bool)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, NODES, strict=True)], schema=NODES)


def _streamed_ends(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of (prefix, conv_id): runs of sorted ids first,
    then the runs of a node in order through one hash.  No task holds more
    than a batch of runs."""
    n = shuffle_partitions(ends.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids = None, []

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())], names=["prefix", "first_id", "ids"])

        for b in batches:
            for prefix, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if ids and (prefix != at or len(ids) == RUN_IDS):
                    yield flushed()
                    ids = []
                at = prefix
                ids.append(conv)
        if ids:
            yield flushed()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, h = None, None

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([h.hexdigest()], pa.string())], names=["prefix", "ends_sha256"])

        for b in batches:
            for prefix, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if prefix != at:
                    if h is not None:
                        yield flushed()
                    at, h = prefix, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
        if h is not None:
            yield flushed()

    sorted_ = ends.repartitionByRange(n, "prefix", "conv_id").sortWithinPartitions("prefix", "conv_id")
    joined = sorted_.mapInArrow(runs, "prefix binary, first_id long, ids string")
    return joined.repartition(n, "prefix").sortWithinPartitions("prefix", "first_id").mapInArrow(hashed, "prefix binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, graft: Graft = no_graft, limit: int | None = None) -> DataFrame:
    """One row per node: ``prefix`` (its digest), ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns of a conversation are ordered by turn, nulls first, ties by the
    digest of role and text; repeated rows are turns of their own.  A null
    role or text is empty.  Rows without a conv_id belong to no conversation
    and are left out.  A conversation that ends up without turns is a member
    of the root.  Other columns are not read.  No conversation gives no node.
    ``limit`` sets the rows below a node of a shard (for tests).
    """
    spark = conversations.sparkSession
    small_batches(spark)
    rows = materialised(turns(conversations), "trie-turns")
    counted = paths(rows, graft).groupBy("prefix").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("rest").alias("below"), F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("size").alias("size")
    )
    counted = materialised(counted, "trie-prefixes")
    top = counted.where(F.col("prefix") == F.lit(ROOT)).select("below").first()
    total = int(top["below"]) if top else 0
    if limit is None:
        limit = min(MOST_ROWS, max(LEAST_ROWS, total // (SHARDS * shuffle_partitions(spark))))
    while (heavy := counted.where(F.col("below") > limit)).count() > CROWN_NODES:
        limit *= 2
    crown = spark.sparkContext.broadcast({bytes(r["prefix"]): r["conv_id"] for r in heavy.select("prefix", "conv_id").collect()})
    dealt = materialised(paths(rows, graft, crown, max(1, -(-2 * total // limit))), "trie-paths")
    nodes = dealt.where("shard IS NOT NULL").groupBy("shard").applyInArrow(_shard_nodes(crown), NODES_SQL)
    nodes = materialised(nodes, "trie-nodes")
    handed = nodes.where("handed").groupBy("prefix").agg(F.sum("n_children").alias("h_children"), F.sum("n_leaves").alias("h_leaves"), F.sum("saved_tokens").alias("h_saved"))
    above = heavy.drop("below").join(handed, "prefix", "left").na.fill(0, ["h_children", "h_leaves", "h_saved"])
    above = above.groupBy(F.lit(0).alias("one")).applyInArrow(_crown_nodes, NODES_SQL)
    ends = _streamed_ends(dealt.where("shard IS NULL").select("prefix", "conv_id")).withColumnRenamed("ends_sha256", "streamed")
    above = above.join(ends, "prefix", "left").withColumn("ends_sha256", F.coalesce("streamed", "ends_sha256"))
    out = nodes.where("NOT handed").drop("handed").unionByName(above.drop("handed", "streamed"))
    out = materialised(out, "trie-table")
    release(rows, counted, dealt, nodes)
    return out
