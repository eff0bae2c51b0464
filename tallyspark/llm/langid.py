"""Language identification: multinomial naive Bayes over hashed n-grams.

A text becomes its lower-cased letters, every run of other characters one
blank.  Its character 2-, 3- and 4-grams are hashed into ``DIM`` buckets.
Training sums bucket counts per language with one distributed aggregation; the
log-probability matrix (languages x DIM) is broadcast, and the sparse bucket
counts of a batch of texts (text, bucket, count) are multiplied with it in
numpy.  More than ``BLOCK_LANGS`` languages are scored block by block, a
running best and a running sum per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import in_blocks, materialised, small_batches

DIM = 1 << 15
ORDERS = (2, 3, 4)
#: languages whose part of the matrix is collected and broadcast at once (128 MB)
BLOCK_LANGS = 512
#: languages whose counts a training task holds before it hands them on
HELD_LANGS = 128
#: texts whose bucket counts are one sparse matrix, and entries multiplied at once
BATCH_TEXTS = 4
BATCH_ENTRIES = 1 << 16
#: added to every count
SMOOTHING = 0.1
#: a long text is folded into its bucket counts in pieces of so many characters
PIECE = 1 << 18
UND = "und"


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-cased code point of a letter, 0 for the rest."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for cp in range(0x32400):  # no letters are assigned above
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def letters(text: str) -> np.ndarray:
    """Lower-cased letters, with one 0 around and between runs of them."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = _letters()[cps]
    keep = low > 0
    keep[1:] |= keep[:-1].copy()  # the first of other characters after a letter
    return np.concatenate(([0], low[keep], [0])).astype(np.uint64)


def _hashed(s: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of every order; entry i starts at ``s[i]``."""
    h = s * np.uint64(0x9E3779B97F4A7C15)
    for n in range(2, max(ORDERS) + 1):
        if len(h) < 2:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + s[n - 1 :] * np.uint64(0x94D049BB133111EB)
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(49)).astype(np.int64)


def bucket_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams; None for a text without a letter."""
    found = batch_counts([text])
    return found[0] if found is not None else None


def batch_counts(texts: list[str | None]) -> np.ndarray | None:
    """Texts x DIM counts of the hashed n-grams (a row of zeros for a text
    without a letter); None where no text has one."""
    counts = None
    pieces = ((k, t[at : at + PIECE + max(ORDERS) - 1]) for k, t in enumerate(texts) for at in range(0, len(t or ""), PIECE))
    # a piece takes the next characters along, so no n-gram is lost
    for part in in_blocks(list(pieces), lambda p: len(p[1]), PIECE):
        runs = [letters(p) for _, p in part]
        some = [(k, r) for (k, _), r in zip(part, runs, strict=True) if r.any()]
        if not some:
            continue
        if counts is None:
            counts = np.zeros(len(texts) * DIM, np.int64)
        s = np.concatenate([r for _, r in some])
        of = np.repeat(np.arange(len(some)), [len(r) for _, r in some])
        row = np.array([k for k, _ in some], np.int64)[of] * DIM
        places = []
        for bucket in _hashed(s):
            own = of[: len(bucket)] == of[len(s) - len(bucket) :]  # not over the end of a text
            places.append((row[: len(bucket)] + bucket)[own])
        counts += np.bincount(np.concatenate(places), minlength=len(counts))
    return None if counts is None else counts.reshape(len(texts), DIM)


@dataclass(frozen=True)
class Block:
    langs: list[str]
    #: DIM x languages
    log_prob: np.ndarray
    log_prior: np.ndarray

    def logits(self, counts: np.ndarray) -> np.ndarray:
        """Texts x languages: the sparse counts times the matrix."""
        at = np.flatnonzero(counts.ravel())
        text, bucket = at // DIM, at % DIM
        n = counts.ravel()[at].astype(float)
        out = np.tile(self.log_prior, (len(counts), 1))
        step = max(1, BATCH_ENTRIES * 4 // max(4, len(self.langs)))
        for lo in range(0, len(n), step):
            rows, first = np.unique(text[lo : lo + step], return_index=True)
            out[rows] += np.add.reduceat(n[lo : lo + step, None] * self.log_prob[bucket[lo : lo + step]], first, axis=0)
        return out


@dataclass(frozen=True)
class Model:
    langs: list[str]
    #: documents and n-grams of every language
    docs: np.ndarray
    grams: np.ndarray
    #: (lang, bucket, n), a written table
    sums: DataFrame | None

    def blocks(self) -> Iterator[Block]:
        for lo in range(0, len(self.langs), BLOCK_LANGS):
            langs = self.langs[lo : lo + BLOCK_LANGS]
            rows = self.sums if len(self.langs) <= BLOCK_LANGS else self.sums.where(F.col("lang").between(langs[0], langs[-1]))
            table = rows.where("bucket >= 0").toPandas()
            counts = np.full((DIM, len(langs)), SMOOTHING)
            col = table["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)
            counts[table["bucket"].to_numpy(dtype=np.int64), col] += table["n"].to_numpy(dtype=np.int64)
            total = self.grams[lo : lo + BLOCK_LANGS] + SMOOTHING * DIM
            yield Block(langs, np.log(counts / total), np.log(self.docs[lo : lo + BLOCK_LANGS] / self.docs.sum()))


def held_out(id_col: str = "doc_id") -> Column:
    """The rows kept from training: crc32 of the id's text mod 4 is 2 (a null
    id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from every row with a language and a letter.

    Counts per language and bucket are a written table.  The driver reads the
    names of the languages, and the counts of ``BLOCK_LANGS`` of them at once.
    No usable row gives a model without languages, which answers ``und`` only.
    """
    small_batches(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, counts in sums.items():
                at = np.flatnonzero(counts)
                # bucket -1 carries the number of documents
                cols = [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], docs[lang]))]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "bucket", "n"])
            sums.clear()
            docs.clear()

        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            for lo in range(0, len(rows), BATCH_TEXTS):
                part = rows[lo : lo + BATCH_TEXTS]
                found = batch_counts([t for t, _ in part])
                for (_, lang), counts in zip(part, found if found is not None else (), strict=found is not None):
                    if not counts.any():
                        continue
                    if lang in sums:
                        sums[lang] += counts
                    else:
                        if len(sums) >= HELD_LANGS:
                            yield from flushed()
                        sums[lang] = counts.copy()
                    docs[lang] = docs.get(lang, 0) + 1
        yield from flushed()

    rows = labelled.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    )
    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = materialised(sums, "langid-sums")
    sizes = sums.groupBy("lang").agg(F.sum(F.when(F.col("bucket") < 0, F.col("n"))).alias("docs"), F.sum(F.when(F.col("bucket") >= 0, F.col("n"))).alias("grams"))
    table = sizes.orderBy("lang").toPandas()
    return Model(table["lang"].tolist(), table["docs"].to_numpy(float), table["grams"].to_numpy(float), sums)


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (posterior of the prediction).

    A null text, or one without a letter, is ``und`` with score 0.  Ties go to
    the language first in byte order.  Only the text is read for the
    prediction; the other columns are carried, and input columns with a
    computed name are replaced.  Repeated rows and ids are scored each.  An
    empty table gives no row.  Every block of languages is one pass over the
    texts.
    """
    spark = df.sparkSession
    small_batches(spark)
    kept = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
    out = df.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text_col)
    fields = out.schema.fields
    # best language and its logit so far, and the sum of exp(logit - best)
    state = [T.StructField("lang_pred", T.StringType()), T.StructField("_best", T.DoubleType()), T.StructField("_sum", T.DoubleType())]
    out = out.select("*", F.lit(UND).alias("lang_pred"), F.lit(float("-inf")).alias("_best"), F.lit(0.0).alias("_sum"))

    def step(shared):
        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for b in batches:
                texts, lang, best, total = (c.to_pylist() for c in (b.column(at), *b.columns[len(fields) :]))
                for lo in range(0, len(texts), BATCH_TEXTS):
                    counts = batch_counts(texts[lo : lo + BATCH_TEXTS])
                    if counts is None:
                        continue
                    logits = block.logits(counts)
                    for k in np.flatnonzero(counts.any(axis=1)):
                        row, i = logits[k], lo + k
                        top = int(np.argmax(row))
                        if row[top] > best[i]:
                            total[i] *= np.exp(best[i] - row[top])
                            lang[i], best[i] = block.langs[top], float(row[top])
                        total[i] += float(np.exp(row - best[i]).sum())
                cols = [*b.columns[: len(fields)], pa.array(lang, pa.string()), pa.array(best, pa.float64()), pa.array(total, pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

        return predict

    for block in model.blocks():
        out = out.mapInArrow(step(spark.sparkContext.broadcast(block)), T.StructType([*fields, *state]))
    score = F.when(F.col("_sum") > 0, 1 / F.col("_sum")).otherwise(0.0)
    return out.select(*[F.col(f"`{c}`") for c in kept], "lang_pred", score.alias("score"))
