"""Toxicity of texts by a weighted lexicon.

Texts are folded (lower case, homoglyphs and digit substitutions to plain
letters, everything between words to one blank).  The lexicon holds word
beginnings, whole words and their weights, and exception phrases inside which
an entry does not count.  One Aho-Corasick automaton finds all of them.  The
sum of the weights, normalised by the length, goes through a logistic curve.

Training reads a bounded sample of labelled texts, equal texts once:

1. document frequencies by label of all word beginnings and whole words;
2. a greedy cover of the toxic texts by the entries that tell them apart;
3. exception phrases: an entry with its neighbour, if mostly in clean texts;
4. the curve, by Newton's method on the binned sums.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import free_names, materialised, release, small_batches

#: labelled texts of either label that training reads (about; by text hash)
SAMPLE_ROWS = 20_000
#: toxic texts that the greedy cover reads, and candidate entries it chooses from
COVER_ROWS = 20_000
CANDIDATES = 50_000
#: an entry is a word beginning of so many characters, or a whole word
STEM = (3, 8)
LONGEST_WORD = 30
#: least log odds of an entry; least share of toxic texts that it adds
MIN_WEIGHT = 2.0
MIN_GAIN = 0.001
#: documents that a phrase needs, and the log odds it stays below, to be an exception
EXCEPTION_DOCS = 3
EXCEPTION_ODDS = -1.0
#: counts that a task holds before it hands them on
HELD = 300_000
#: normalised sums are binned for the curve
BINS = 64
SEED = 20240611

#: fixed values: known insults, candidates whatever their frequency
SEEDS = "idiot idiots moron morons stupid imbecile loser losers scum scumbag trash worthless pathetic disgusting clown vermin retard bastard bitch asshole".split()
#: fixed values: phrases in which an entry is harmless
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "trash talk")
#: fixed values: Cyrillic and Greek letters that look like Latin ones
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅰ": "i", "ⅼ": "l",
}
#: fixed values: digits and signs written for letters
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
_UNSEEN = "­​‌‍⁠﻿"


def _fold_table() -> dict:
    full = {0xFEE0 + c: chr(c) for c in range(0x21, 0x7F)}  # full-width forms
    plain = {**SUBSTITUTES, **LOOKALIKES}
    return {**{k: plain.get(v, v) for k, v in full.items()}, **{ord(k): v for k, v in plain.items()}, **{ord(c): None for c in _UNSEEN}}


FOLD = _fold_table()
_GAP = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Folded words, a blank before and after each; one blank if there is none."""
    words = _GAP.sub(" ", (text or "").lower().translate(FOLD)).strip()
    return f" {words} " if words else " "


def entries_of(folded: str) -> set[str]:
    """Possible entries of a folded text: " stem" and " word "."""
    lo, hi = STEM
    out = set()
    for w in set(folded.split()):
        out.update(" " + w[:k] for k in range(lo, min(hi, len(w)) + 1))
        if len(w) <= LONGEST_WORD:
            out.add(f" {w} ")
    return out


@dataclass
class Model:
    #: entry -> weight, exception phrases (folded, blanks around), curve
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    intercept: float = -6.0
    slope: float = 6.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        auto = ahocorasick.Automaton()
        for phrase in self.exceptions:
            auto.add_word(phrase, (len(phrase), None))
        for entry, w in self.weights.items():
            auto.add_word(entry, (len(entry), w))
        auto.make_automaton()
        return auto


def _hits(auto, folded: str) -> dict[int, float]:
    """Start -> largest weight, outside exception phrases."""
    best: dict[int, float] = {}
    harmless: list[tuple[int, int]] = []
    for end, (n, w) in auto.iter(folded):
        at = end - n + 1
        if w is None:
            harmless.append((at, end))
        elif w > best.get(at, 0.0):
            best[at] = w
    for lo, hi in harmless:
        for at in [x for x in best if lo <= x < hi] if len(best) < hi - lo else range(lo, hi):
            best.pop(at, None)
    return best


def normalised(auto, folded: str) -> float:
    """Sum of the weights over the logarithm of the length in words."""
    hits = _hits(auto, folded) if auto is not None else {}
    return sum(hits.values()) / float(np.log(np.e + folded.count(" ") - 1)) if hits else 0.0


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def _sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> tuple[DataFrame, dict[int, int]]:
    """Distinct texts of about ``rows`` labelled rows per label, folded.  The
    rows are chosen by ids and hashes; only chosen texts are moved."""
    whole = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    known = labels.where("toxic IN (0, 1)").select(F.col(f"`{id_col}`").alias("id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    pairs = materialised(whole.select("id", "h").join(known, "id").distinct(), "toxicity-labelled")
    part = F.pmod(F.xxhash64(F.lit(SEED), "h"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for r in pairs.groupBy("toxic").agg(F.countDistinct("h").alias("n")).collect():
        share = F.when(F.col("toxic") == r["toxic"], F.lit(min(1.0, rows / r["n"]))).otherwise(share)
    # one id of every chosen text and label: about 2 * rows rows of 20 bytes
    chosen = pairs.where(part < share).groupBy("h", "toxic").agg(F.min("id").alias("id"))
    drawn = whole.join(F.broadcast(chosen), ["id", "h"]).groupBy("h", "toxic").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([fold(t) for t in b.column(2).to_pylist()], pa.string())], names=["h", "toxic", "folded"])

    drawn = materialised(drawn.mapInArrow(run, "h long, toxic int, folded string"), "toxicity-sample")
    release(pairs)
    return drawn, {r["toxic"]: r["n"] for r in drawn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


def _counted(sample: DataFrame, keys_of) -> DataFrame:
    """(key, bad, good): documents of either label that hold the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed() -> pa.RecordBatch:
            keys = list(held[0].keys() | held[1].keys())
            cols = [pa.array(keys, pa.string()), pa.array([held[1][k] for k in keys], pa.int64()), pa.array([held[0][k] for k in keys], pa.int64())]
            held[0].clear(), held[1].clear()
            return pa.RecordBatch.from_arrays(cols, names=["key", "bad", "good"])

        for b in batches:
            for label, folded in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held[label].update(keys_of(folded))
                if len(held[0]) + len(held[1]) >= HELD:
                    yield flushed()
        yield flushed()

    counts = sample.select("toxic", "folded").mapInArrow(run, "key string, bad long, good long")
    return counts.groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _odds(bad: Column, good: Column, n_bad: int, n_good: int) -> Column:
    return F.log((bad + 0.5) / (n_bad + 1.0)) - F.log((good + 0.5) / (n_good + 1.0))


def _cover(texts: list[list[int]], entries: list[tuple[str, float]], least: int) -> list[int]:
    """Entries that cover the texts, largest weighted gain first; of equals a
    beginning before a whole word, then the longer one."""
    where: dict[int, list[int]] = {}
    for t, hit in enumerate(texts):
        for e in hit:
            where.setdefault(e, []).append(t)
    rank = lambda e, n: (-n * entries[e][1], entries[e][0].endswith(" "), -len(entries[e][0]), entries[e][0])
    heap = [(*rank(e, len(ts)), len(ts), e) for e, ts in where.items()]
    heapq.heapify(heap)
    covered, chosen = set(), []
    while heap:
        *_, n, e = heapq.heappop(heap)
        left = sum(t not in covered for t in where[e])
        if left < n:  # gains only shrink: put it back at its present gain
            if left:
                heapq.heappush(heap, (*rank(e, left), left, e))
            continue
        if n < least:
            continue
        chosen.append(e)
        covered.update(where[e])
    return chosen


def _curve(x: np.ndarray, bad: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic regression with a light ridge."""
    a, b, ridge = np.log((bad.sum() + 0.5) / (n.sum() - bad.sum() + 0.5)), 0.0, 1e-2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = n * p * (1 - p)
        g = np.array([(bad - n * p).sum() - ridge * 1e-2 * a, ((bad - n * p) * x).sum() - ridge * b])
        h = np.array([[w.sum() + ridge * 1e-2, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + ridge]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of documents (id, text) and labels (id, toxic).  Null ids and
    texts and labels other than 0 and 1 teach nothing; copies of a text count
    once per label; an id of both labels teaches both.  Without a toxic
    or without a clean text there is nothing to tell apart: the model is that
    of the known insults, each of the same weight."""
    seeds = {f" {fold(w).strip()} " for w in SEEDS}
    harmless = [fold(p) for p in EXCEPTIONS]
    small_batches(docs.sparkSession)
    sample, n = _sample(docs, labels, sample_rows, id_col, text_col)
    if not n.get(0) or not n.get(1):
        return Model(dict.fromkeys(sorted(seeds), MIN_WEIGHT * 2), harmless)
    least = max(1, int(MIN_GAIN * n[1]))
    counts = _counted(sample, entries_of).withColumn("w", _odds(F.col("bad"), F.col("good"), n[1], n[0]))
    seeded = F.col("key").isin(*sorted(seeds)) & (F.col("w") > 0)
    # an entry of one text only is a rare word, not a lexicon entry
    usual = (F.col("w") >= MIN_WEIGHT) & (F.col("bad") >= max(2, least))
    found = counts.where(usual | seeded).orderBy(F.desc(F.col("bad") * F.col("w")), "key").limit(CANDIDATES).collect()
    entries = [(r["key"], float(r["w"])) for r in found]
    auto = ahocorasick.Automaton()
    for k, (e, _) in enumerate(entries):
        auto.add_word(e, k)
    chosen: list[int] = []
    if entries:
        auto.make_automaton()
        shared = sample.sparkSession.sparkContext.broadcast(auto)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hits = [sorted({k for _, k in shared.value.iter(t)}) for t in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32()))], names=["hits"])

        toxic = sample.where("toxic = 1").orderBy("h").limit(COVER_ROWS).select("folded")
        chosen = _cover([r["hits"] for r in toxic.mapInArrow(run, "hits array<int>").collect()], entries, max(2, least))
    weights = {entries[e][0]: entries[e][1] for e in chosen}
    # a known insult that no clean text holds stays, though no text here needs it
    weights |= {e: w for e, w in entries if e in seeds and w >= MIN_WEIGHT}
    if not weights:
        base = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
        release(sample)
        return Model({}, [], base, 0.0)
    alone = sample.sparkSession.sparkContext.broadcast(Model(weights, harmless).automaton())

    def phrases(folded: str) -> set[str]:
        out = set()
        for at in _hits(alone.value, folded):
            end = folded.index(" ", at + 1)
            before = folded.rfind(" ", 0, at) if at else -1
            after = folded.find(" ", end + 1)
            if before >= 0:
                out.add(folded[before : end + 1])
            if after >= 0:
                out.add(folded[at : after + 1])
        return {p for p in out if len(p) <= 2 * LONGEST_WORD}

    clean = _counted(sample, phrases).where(F.col("good") >= EXCEPTION_DOCS).where(_odds(F.col("bad"), F.col("good"), n[1], n[0]) <= EXCEPTION_ODDS)
    learned = [r["key"] for r in clean.orderBy(F.desc("good"), "key").limit(CANDIDATES).collect()]
    model = Model(weights, harmless + sorted(set(learned) - set(harmless)))
    told = sample.sparkSession.sparkContext.broadcast(model.automaton())

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [round(normalised(told.value, t) * BINS) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.int64())], names=["toxic", "x"])

    bins = sample.select("toxic", "folded").mapInArrow(sums, "toxic int, x long").groupBy("x").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).toPandas()
    model.intercept, model.slope = _curve(bins["x"].to_numpy(float) / BINS, bins["bad"].to_numpy(float), bins["n"].to_numpy(float))
    release(sample)
    return model


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with ``score``, 0 to 1.  Whole texts are read.  A
    null or empty text has the score of a text without a hit.  Rows are scored
    one by one, so repeated rows and null ids stay as they are; an input
    column called ``score`` gives way.  An empty table gives no row."""
    spark = df.sparkSession
    small_batches(spark)
    rows = free_names(df, "score")
    shared = spark.sparkContext.broadcast(model.automaton())
    a, b = model.intercept, model.slope
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([normalised(shared.value, fold(t)) for t in batch.column(at).to_pylist()], float)
            p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))
