"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item gives its windows of ``WINDOW`` words.  A window that lies
in a document shares all its 3-word shingles with it, so one of them is a
sufficient prefix: the rarest in the documents (order by rarity).  Documents
are probed with these prefix shingles only; a hit fixes where the window must
start (positional bound), it must end inside the document (length bound), and
the words of that stretch are then compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import in_blocks, materialised, small_batches, utf8

WINDOW = 10
SHINGLE = 3
#: windows broadcast at once (about 150 bytes each); more are joined in blocks
BLOCK_WINDOWS = 200_000
#: texts hashed together, and words at once (bounds the arrays of a task)
BLOCK_BYTES = 1 << 20
SLICE_WORDS = 200_000
SEED = 20240607
#: fixed values: ASCII letters in lower case, digits and other scripts are words
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_WORD).split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


_BYTE = np.random.default_rng(SEED).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.default_rng(SEED + 1).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words:
    """The words of a block of texts: bytes, ends, text number, hashes.  The
    hashes only find candidates; words are compared as bytes."""

    def __init__(self, texts: list[bytes]):
        parts = [t.translate(_WORD) for t in texts]
        self.raw = b" ".join([*parts, b""])
        at = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(at) + 2, bool)
        inside[1:-1] = at != 32
        self.starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        self.ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        self.text = np.searchsorted(begins, self.starts, "right") - 1
        #: first word of every text, and the number of words
        self.first = np.searchsorted(self.starts, begins)
        self.hashes = np.zeros(len(self.starts), np.uint64)
        for lo in range(0, len(self.starts), SLICE_WORDS):
            starts, ends = self.starts[lo : lo + SLICE_WORDS], self.ends[lo : lo + SLICE_WORDS]
            size = ends - starts
            offset = np.cumsum(size) - size
            of = np.arange(int(size.sum())) - np.repeat(offset, size)
            own = at[starts[0] : ends[-1]]
            byte = _BYTE[own[inside[1 + starts[0] : 1 + ends[-1]]]]
            self.hashes[lo : lo + SLICE_WORDS] = _mix(np.add.reduceat(byte * _PLACE[of & 63], offset) + size.astype(np.uint64))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of all runs of n words inside one text."""
        m = max(0, len(self.hashes) - n + 1)
        at = np.flatnonzero(self.text[:m] == self.text[len(self.text) - m :])
        out = np.full(len(at), n, np.uint64)
        for i in range(n):
            out = _mix(out) + self.hashes[at + i] * np.uint64(0x9E3779B97F4A7C15)
        return _mix(out), at

    def holds(self, start: int, window: list[bytes]) -> bool:
        """Whether the words from ``start`` on are the window, in one text."""
        text, end = self.text[start], start + len(window)
        return start >= self.first[text] and end <= self.first[text + 1] and self.raw[self.starts[start] : self.ends[end - 1]].split() == window


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, words, key): distinct windows per item, words joined by blanks.
    An item of fewer words, but not none, is one window; a null text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = words(text)
                for x in {b" ".join(w[k : k + window]) for k in range(max(1, len(w) - window + 1))} if w else ():
                    ids.append(i)
                    out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.binary())], names=["item", "words"])

    slim = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text"))
    return slim.mapInArrow(run, "item string, words binary").distinct().withColumn("key", F.xxhash64("words"))


class _Block:
    """A bounded block of windows: their shingles, and after ``order`` the
    prefix shingle of each."""

    def __init__(self, rows: list[tuple[str | None, bytes]], shingle: int):
        self.items: dict[bytes, list[str]] = {}
        for item, w in rows:
            self.items.setdefault(bytes(w), []).extend([] if item is None else [item])
        texts = sorted(self.items)
        self.windows = [w.split(b" ") for w in texts]
        #: a window shorter than a shingle is one shingle itself
        self.size = [min(shingle, len(w)) for w in self.windows]
        self.sizes = sorted(set(self.size))
        self.grams: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
        words = Words(texts)
        for n in self.sizes:
            hashes, at = words.grams(n)
            of = words.text[at]
            for k, own in enumerate(np.split(hashes, np.searchsorted(of, np.arange(1, len(texts))))):
                if self.size[k] == n:
                    self.grams[k] = own
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        self.look_for(np.unique(np.concatenate(self.grams)) if texts else np.zeros(0, np.uint64))

    def look_for(self, hashes: np.ndarray) -> None:
        self.all = hashes
        # most shingles of a text are told apart by these bits alone
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.all >> np.uint64(42)] = True

    def order(self, frequency: np.ndarray) -> None:
        """Choose each window's rarest shingle (the first of equals)."""
        first = [int(np.argmin(frequency[np.searchsorted(self.all, g)])) for g in self.grams]
        for k, at in enumerate(first):
            self.prefix.setdefault(int(self.grams[k][at]), []).append((k, at))
        self.look_for(np.unique(np.fromiter(self.prefix, np.uint64, len(self.prefix))))

    def hits(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in ``all`` and first words, per size, of shingles it has."""
        for n in self.sizes:
            hashes, at = words.grams(n)
            some = np.flatnonzero(self.bits[hashes >> np.uint64(42)])
            place = np.minimum(np.searchsorted(self.all, hashes[some]), len(self.all) - 1)
            good = self.all[place] == hashes[some]
            yield place[good], at[some[good]]


def _frequencies(docs: DataFrame, shared, n: int) -> np.ndarray:
    """Documents that hold each of the block's shingles, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        counts = np.zeros(len(block.all), np.int64)
        for b in batches:
            for part in in_blocks(b.column(0).to_pylist(), lambda t: len(t or ""), BLOCK_BYTES):
                words = Words([utf8(t) for t in part])
                for place, at in block.hits(words):
                    # once per text
                    counts += np.bincount(np.unique(words.text[at] * len(block.all) + place) % len(block.all), minlength=len(block.all))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    sums = docs.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(n, np.int64)
    out[sums["at"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def _probe(docs: DataFrame, shared, id_type: str, with_text: bool) -> DataFrame:
    """(id, n_words, spans, items) with the block's hits added; the text only
    for a caller that reads it again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for b in batches:
            rows = list(zip(*[b.column(i).to_pylist() for i in range(4)], strict=True))
            for part in in_blocks(rows, lambda r: len(r[1] or ""), BLOCK_BYTES):
                words = Words([utf8(r[1]) for r in part])
                found = [([tuple(x) for x in hits], set(items)) for _, _, hits, items in part]
                for place, at in block.hits(words):
                    for g, p in zip(block.all[place].tolist(), at.tolist(), strict=True):
                        text = words.text[p]
                        first = int(words.first[text])
                        for k, inner in block.prefix[g]:
                            win, start = block.windows[k], p - inner
                            if start >= first and words.holds(start, win):
                                found[text][0].append((start - first, start - first + len(win)))
                                found[text][1].update(block.items[b" ".join(win)])
                n_words = np.diff(words.first[: len(part) + 1]).tolist()
                out = [(r[0], n, _merged(spans), sorted(ids), r[1])[: len(names)] for r, n, (spans, ids) in zip(part, n_words, found, strict=True)]
                cols = list(zip(*out, strict=True))
                kinds = [b.schema.field(0).type, pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string()), b.schema.field(1).type]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    names = ["id", "n_words", "spans", "items", "text"][: 5 if with_text else 4]
    schema = f"id {id_type}, n_words long, spans array<array<bigint>>, items array<string>"
    return docs.mapInArrow(run, schema + ", text string" * with_text)


def _merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    with_text: bool = True,
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit``, ``spans`` (hit word
    ranges, merged), ``items`` (sorted ids, as strings, of the items that own
    an occurring window), and the text unless ``with_text`` is false.

    A null or empty text has no words and no hit.  A null item id is hit but
    not listed; repeated items and items that share an id count once.  No item
    gives no hit.  The windows are broadcast in blocks of ``block_windows``,
    each block one pass over all documents; only their number grows with the
    benchmark.  Other columns are not read.  No document gives no row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    windows = materialised(item_windows(items, item_col, item_text_col, window), "decontam-windows")
    # without an item one empty block still counts the words
    n_blocks = max(1, -(-windows.count() // block_windows))
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    state = slim.withColumn("spans", F.expr("cast(array() as array<array<bigint>>)")).withColumn("items", F.expr("cast(array() as array<string>)"))
    for k in range(n_blocks):
        rows = windows.where(F.pmod("key", F.lit(n_blocks)) == k).select("item", "words").collect()
        block = _Block([(r["item"], r["words"]) for r in rows], SHINGLE)
        if rows:
            block.order(_frequencies(slim, spark.sparkContext.broadcast(block), len(block.all)))
        last = k == n_blocks - 1
        state = _probe(state.select("id", "text", "spans", "items"), spark.sparkContext.broadcast(block), id_type, with_text or not last)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    text = ["text"] if with_text else []
    return state.select(F.col("id").alias(id_col), *text, "n_words", hit.alias("n_hit"), "spans", "items")
