"""Token counts without token ids.

Byte-level BPE never merges across pre-tokens, so a text's token count is the
sum over its pre-tokens of their piece counts.  Each block of documents becomes
its distinct pre-tokens with postings (document, frequency); pre-tokens are
hashed into buckets, and one shuffle brings all blocks' occurrences of a
pre-token to one task.  There each distinct pre-token is tokenised once, its
count is joined to the postings, and the products are summed per document.

A pre-token that every ``HOT`` th document of a block holds (" the") would
bring its postings of the whole corpus to one task.  Those are dealt by block
as well, so such a pre-token is tokenised once in every bucket.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import shuffle_partitions, small_batches, utf8

#: a block: one row's worth of postings per bucket; document numbers fit 16 bits
BLOCK_BYTES = 32 << 20
BLOCK_DOCS = 60_000
#: buckets per shuffle partition
BUCKETS = 8
#: a pre-token is frequent in a block if one of so many documents holds it
HOT = 8
#: sums held by a reducing task before it passes them on
HELD_DOCS = 4_000_000
#: piece counts held by a reducing task
HELD_PIECES = 1_000_000

_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
#: fixed values: the pre-tokenizer's pattern, spelled out for Latin text
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
#: anything else is split by the tokenizer library itself
_OTHER = re.compile("[^\n\t\r\x20-\x7e¡-ɏ]")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _specials(path: str):
    found = [re.escape(t.content) for t in _tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(sorted(found, key=len, reverse=True))) if found else None


def pre_tokens(text: str, path: str) -> list[str]:
    """Pre-tokens of a text that holds no special string."""
    if not _OTHER.search(text):
        return _LATIN.findall(text)
    return [text[a:b] for _, (a, b) in _tokenizer(path).pre_tokenizer.pre_tokenize_str(text)]


def frequencies(text: str | None, path: str) -> tuple[Counter, int]:
    """Pre-token frequencies of a text, and its number of special strings
    (the library's default reads each as one token and splits there)."""
    if not text:
        return Counter(), 0
    special = _specials(path)
    if special is None or not special.search(text):
        return Counter(pre_tokens(text, path)), 0
    parts = special.split(text)
    counts: Counter = Counter()
    for p in parts:
        if p:
            counts.update(pre_tokens(p, path))
    return counts, len(parts) - 1


def _postings(block: list[tuple[int | None, str | None]], path: str, n_buckets: int, name: int = 0):
    """Rows (bucket, pieces, offsets, postings) of a block, and its row of
    documents.  ``name`` tells blocks apart."""
    names: dict[str, int] = {}
    ids, freqs, sizes, n_bytes, specials = [], [], [], [], []
    for _, text in block:
        counts, special = frequencies(text, path)
        ids.append(np.fromiter((names.setdefault(w, len(names)) for w in counts), np.int64, len(counts)))
        freqs.append(np.fromiter(counts.values(), np.int64, len(counts)))
        sizes.append(len(counts))
        n_bytes.append(len(utf8(text)))
        specials.append(special)
    tok, freq = np.concatenate(ids), np.concatenate(freqs)
    doc = np.repeat(np.arange(len(block)), sizes)
    words = list(names)
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) % n_buckets for w in words), np.int64, len(words))
    hot = np.bincount(tok, minlength=len(words)) * HOT > len(block)
    bucket = np.where(hot, (bucket + xxhash.xxh3_64_intdigest(str(name)) % n_buckets) % n_buckets, bucket)
    # one order: bucket, then pre-token, then document
    by_bucket = np.argsort(bucket, kind="stable")
    place = np.empty(len(words), dtype=np.int64)
    place[by_bucket] = np.arange(len(words))
    order = np.argsort(place[tok], kind="stable")
    tok, doc, freq = place[tok][order], doc[order], freq[order]
    per_word = np.bincount(tok, minlength=len(words))
    ends = np.cumsum(per_word)
    cuts = np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        lo, hi = (ends[a - 1] if a else 0), ends[b - 1]
        yield (
            int(bucket[by_bucket[a]]),
            "\x00".join(words[i].replace("\x01", "\x01\x02").replace("\x00", "\x01\x03") for i in by_bucket[a:b]).encode("utf-8", "surrogatepass"),
            per_word[a:b].astype(np.int32).tobytes(),
            doc[lo:hi].astype(np.uint16).tobytes(),
            freq[lo:hi].astype(np.int32).tobytes(),
        )
    # last, the block's documents: special strings, bytes, ids with a null mask
    nulls = np.array([d is None for d, _ in block])
    ids = np.array([d or 0 for d, _ in block], dtype=np.int64)
    yield (
        -1,
        None,
        np.array(specials, dtype=np.int32).tobytes(),
        np.array(n_bytes, dtype=np.int64).tobytes(),
        ids.tobytes() + nulls.tobytes(),
    )


def _blocks(rows: Iterator[tuple], max_bytes: int) -> Iterator[list]:
    block, size = [], 0
    for r in rows:
        n = len(r[1]) if r[1] else 0
        if block and (size + n > max_bytes or len(block) >= BLOCK_DOCS):
            yield block
            block, size = [], 0
        block.append(r)
        size += n
    if block:
        yield block


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    n_buckets: int | None = None,
) -> DataFrame:
    """One row per input row: the id (long), ``n_bytes`` and ``n_tokens``.

    A null text is empty: 0 bytes, 0 tokens.  Rows are counted one by one, so
    repeated rows and null ids each give their own row.  No text is cut.  Other
    input columns are not read.  An empty table gives no row.
    """
    spark = df.sparkSession
    small_batches(spark)
    partitions = shuffle_partitions(spark)
    n_buckets = n_buckets or BUCKETS * partitions

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for k, block in enumerate(_blocks(rows, block_bytes)):
            name = (part << 24) + k
            out = list(_postings(block, tokenizer_path, n_buckets, name))
            # a block's row of documents goes to some bucket's task, not to one for all
            out[-1] = (xxhash.xxh3_64_intdigest(str(name)) % n_buckets, *out[-1][1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.int32()),
                    pa.array([name] * len(out), pa.int64()),
                    *[pa.array([r[i] for r in out], pa.binary()) for i in (1, 2, 3, 4)],
                ],
                names=["bucket", "block", "words", "sizes", "docs", "freqs"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer_path)
        pieces: dict[bytes, int] = {}
        held: dict[int, np.ndarray] = {}

        def passed_on():
            for block, sums in held.items():
                at = np.flatnonzero(sums)
                if len(at):
                    yield _row(block, at.astype(np.uint16).tobytes(), sums[at].tobytes(), None, None, None)
            held.clear()

        for b in batches:
            for block, words, sizes, docs, freqs in zip(*[b.column(i).to_pylist() for i in range(1, 6)], strict=True):
                if words is None:
                    yield _row(block, None, None, docs, sizes, freqs)
                    continue
                keys = words.split(b"\x00")
                if len(pieces) > HELD_PIECES:
                    pieces.clear()
                new = list(dict.fromkeys(k for k in keys if k not in pieces))
                texts = [k.decode("utf-8", "surrogatepass").replace("\x01\x03", "\x00").replace("\x01\x02", "\x01") for k in new]
                pieces.update(zip(new, (len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)), strict=True))
                each = np.fromiter((pieces[k] for k in keys), np.int64, len(keys))
                each = np.repeat(each, np.frombuffer(sizes, np.int32))
                at = np.frombuffer(docs, np.uint16)
                sums = np.bincount(at, weights=each * np.frombuffer(freqs, np.int32)).astype(np.int64)
                mine = held.get(block)
                if mine is None or len(mine) < len(sums):
                    grown = np.zeros(len(sums), np.int64)
                    if mine is not None:
                        grown[: len(mine)] = mine
                    mine = held[block] = grown
                mine[: len(sums)] += sums
                if sum(map(len, held.values())) > HELD_DOCS:
                    yield from passed_on()
        yield from passed_on()

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["n_bytes"].notna()].iloc[0]
        n = len(own["ids"]) // 9
        ids, nulls = np.frombuffer(own["ids"], np.int64, n), np.frombuffer(own["ids"], np.bool_, n, 8 * n)
        total = np.frombuffer(own["specials"], np.int32).astype(np.int64)
        for at, sums in zip(pdf["at"], pdf["sums"], strict=True):
            if at is not None:
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(sums, np.int64)
        return pd.DataFrame({"id": pd.arrays.IntegerArray(ids.copy(), nulls.copy()), "n_bytes": np.frombuffer(own["n_bytes"], np.int64), "n_tokens": total})

    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    postings = slim.mapInArrow(split, "bucket int, block long, words binary, sizes binary, docs binary, freqs binary")
    sums = postings.repartition(partitions, "bucket").mapInArrow(count, "block long, at binary, sums binary, n_bytes binary, specials binary, ids binary")
    return sums.groupBy("block").applyInPandas(gather, "id long, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


def _row(block, at, sums, n_bytes, specials, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()),
            *[pa.array([x], pa.binary()) for x in (at, sums, n_bytes, specials, ids)],
        ],
        names=["block", "at", "sums", "n_bytes", "specials", "ids"],
    )
