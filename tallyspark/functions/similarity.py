"""Description similarity (G4) and its native pre-filters.

The ratio is Ratcliff/Obershelp as computed by ``difflib.SequenceMatcher``
(``2*M / (len(a)+len(b))``, asymmetric, autojunk for long ``b``).  It is the
only Python in the merge path and runs over whole Arrow batches of candidate
pairs that already passed two exact native bounds: of the lengths, and of the
characters that both texts have.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_THRESHOLD = 0.80


def _ratio(a, b) -> float | None:
    if a is None or b is None:
        return None
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Exact ``SequenceMatcher(None, a, b).ratio()`` per pair."""
    return pd.Series([_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.arrow_udf(T.BooleanType())
def similar_at_least(a: pa.Array, b: pa.Array, t: pa.Array) -> pa.Array:
    """``ratio(a, b) >= t``, a batch at once; without an answer where a text
    is null."""
    return _similar(a, b, t[0].as_py() if len(t) else 0.0)


#: what ``matches_of`` returns per left text that has a match: its place, those
#: of the last match and of one with the greatest label, and the sum of weights
MATCHES = T.ArrayType(T.StructType([T.StructField(c, t) for c, t in (
    ("i", T.IntegerType()), ("last", T.IntegerType()), ("label", T.IntegerType()), ("n", T.LongType()))]))


@F.arrow_udf(MATCHES)
def matches_of(left: pa.Array, right: pa.Array, weights: pa.Array, labels: pa.Array, t: pa.Array) -> pa.Array:
    """Every text of the array ``left`` against every other text of ``right``,
    row by row: which of them reach the ratio ``t``."""
    return _matches(left, right, weights, labels, t[0].as_py() if len(t) else 0.0)


#: difflib leaves out frequent characters of second texts from this length on
AUTOJUNK = 200
# cells of the tables that a step holds
CELLS = 1 << 20
# pairs that are compared at once
PAIRS = 1 << 16
# pairs and bytes of text that are held at once, of a batch of any size
HELD = 1 << 20


def _similar(a: pa.Array, b: pa.Array, least: float) -> pa.Array:
    known = ~(a.is_null().to_numpy(zero_copy_only=False) | b.is_null().to_numpy(zero_copy_only=False))
    every = np.nonzero(known)[0]
    out = np.zeros(len(a), bool)
    out[every] = _reach(_Texts(a), _Texts(b), every, every, least)
    return pa.array(out, pa.bool_(), mask=~known)


def _matches(left: pa.Array, right: pa.Array, weights: pa.Array, labels: pa.Array, least: float) -> pa.Array:
    """``matches_of`` in steps of a few rows: most pairs of a row may match."""
    cost = np.cumsum(_sizes(left) * _sizes(right) + _text_bytes(left) + _text_bytes(right))
    lo, parts = 0, []
    while lo < len(left) or not parts:
        hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + HELD, side="right")))
        parts.append(_matches_of_rows(*(x.slice(lo, hi - lo) for x in (left, right, weights, labels)), least))
        lo = hi
    return pa.concat_arrays(parts)


def _text_bytes(lists: pa.Array) -> np.ndarray:
    """Bytes of the texts of each list."""
    n = pc.binary_length(lists.flatten()).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.diff(np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(_sizes(lists))])])


def _matches_of_rows(left: pa.Array, right: pa.Array, weights: pa.Array, labels: pa.Array, least: float) -> pa.Array:
    a, b = _Texts(left.flatten()), _Texts(right.flatten())
    ends_a, ends_b = np.cumsum(_sizes(left)), np.cumsum(_sizes(right))
    weight = weights.flatten().to_numpy(zero_copy_only=False)
    label = pc.rank(labels.flatten(), null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False)
    same = pc.dictionary_encode(pa.concat_arrays([a.texts, b.texts])).indices.to_numpy()
    same_a, same_b = same[: len(a.texts)], same[len(a.texts) :]
    found, some, held = [], [], 0

    def compare():
        i, j = (np.concatenate(x) for x in zip(*some))
        differ = same_a[i] != same_b[j]
        i, j = i[differ], j[differ]
        for k in range(0, len(i), PAIRS):
            x, y = i[k : k + PAIRS], j[k : k + PAIRS]
            yes = _reach(a, b, x, y, least)
            found.append((x[yes], y[yes]))
        some.clear()

    for row in range(len(left)):
        i, j = _near(a, b, ends_a[row - 1] if row else 0, ends_a[row], ends_b[row - 1] if row else 0, ends_b[row], least)
        if len(i):
            some.append((i, j))
            held += len(i)
        if some and (held >= PAIRS or row + 1 == len(left)):
            compare()
            held = 0
    if some:
        compare()
    # pairs come by row, left text and right text
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    begins = np.nonzero(np.diff(i, prepend=-1))[0]
    texts = i[begins]
    last = np.maximum.reduceat(j, begins) if len(i) else j
    total = np.add.reduceat(weight[j], begins) if len(i) else np.zeros(0, np.int64)
    top = np.maximum.reduceat(label[j].astype(np.int64) * (len(label) + 1) + j, begins) % (len(label) + 1) if len(i) else j
    rows = np.searchsorted(ends_a, texts, side="right")
    first_a, first_b = np.concatenate([[0], ends_a])[rows], np.concatenate([[0], ends_b])[rows]
    values = pa.StructArray.from_arrays(
        [pa.array(v.astype(k), t) for v, k, t in (
            (texts - first_a, np.int32, pa.int32()), (last - first_b, np.int32, pa.int32()),
            (top - first_b, np.int32, pa.int32()), (total, np.int64, pa.int64()))], ["i", "last", "label", "n"])
    at = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(left)))]) if len(left) else np.zeros(1)
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32), pa.int32()), values)


def _sizes(lists: pa.Array) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy()).astype(np.int64)


class _Texts:
    """Texts as numbers of characters, one after the other."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        self.chars, self.first, self.length = _characters(texts)
        self.of = np.repeat(np.arange(len(self.length)), self.length)

    def counts(self, lo: int, hi: int) -> np.ndarray:
        """Characters of some texts by their last seven bits."""
        at, end = self.first[lo], self.first[hi - 1] + self.length[hi - 1]
        kinds = self.chars[at:end].astype(np.int64) & 127
        return np.bincount((self.of[at:end] - lo) * 128 + kinds, minlength=(hi - lo) * 128).reshape(hi - lo, 128)


def _near(a: _Texts, b: _Texts, lo_a: int, hi_a: int, lo_b: int, hi_b: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two ranges of texts that may reach ``least``: matched
    characters are characters of both texts."""
    if hi_a <= lo_a or hi_b <= lo_b:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y = a.counts(lo_a, hi_a), b.counts(lo_b, hi_b)
    kind = np.int16 if max(x.max(), y.max()) * 128 < 1 << 15 else np.int64
    both = np.nonzero((x.max(axis=0) > 0) & (y.max(axis=0) > 0))[0]
    shared = np.zeros((len(x), len(y)), kind)
    for c in both:
        shared += np.minimum(x[:, c, None].astype(kind), y[None, :, c].astype(kind))
    total = a.length[lo_a:hi_a, None] + b.length[None, lo_b:hi_b]
    i, j = np.nonzero(_ratio_of(shared, total) >= least)
    return i + lo_a, j + lo_b


def _ratio_of(matched: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total > 0, 2.0 * matched / np.maximum(total, 1), 1.0)


def _reach(a: _Texts, b: _Texts, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Whether the ratio of the texts ``a[i]`` and ``b[j]`` is at least
    ``least``: difflib's matching with numpy over all pairs at once: the longest
    common run of every part (the earliest in ``a``, then in ``b``), then what
    lies left and right of it.  A pair is left as soon as its matched
    characters reach ``least`` or those that remain cannot."""
    n = len(i)
    chars_a, chars_b, len_a, len_b = a.chars, b.chars, a.length[i], b.length[j]
    if chars_a.dtype != chars_b.dtype:
        chars_a, chars_b = chars_a.astype(np.uint32), chars_b.astype(np.uint32)
    total = len_a + len_b
    short = np.maximum(len_a, len_b) < AUTOJUNK
    pair = np.nonzero(short)[0]
    lo_a, hi_a, lo_b, hi_b = np.zeros_like(pair), len_a[pair], np.zeros_like(pair), len_b[pair]
    matched = np.zeros(n, np.int64)
    while len(pair):
        room = np.minimum(hi_a - lo_a, hi_b - lo_b)
        most = matched + np.bincount(pair, room, n).astype(np.int64)
        undecided = (_ratio_of(most, total) >= least) & (_ratio_of(matched, total) < least)
        keep = np.nonzero((room > 0) & undecided[pair])[0]
        # the widest first, so that the parts of a step are of like width
        width = np.maximum(hi_a - lo_a, hi_b - lo_b)[keep]
        order = np.argsort(-width, kind="stable")
        keep, width = keep[order], width[order]
        pair, lo_a, hi_a, lo_b, hi_b = pair[keep], lo_a[keep], hi_a[keep], lo_b[keep], hi_b[keep]
        size, at_a, at_b = np.zeros_like(pair), np.zeros_like(pair), np.zeros_like(pair)
        k = 0
        while k < len(pair):
            some = slice(k, k + max(16, CELLS // int(width[k]) ** 2))
            x = _windows(chars_a, a.first[i[pair[some]]] + lo_a[some], hi_a[some] - lo_a[some], 0)
            y = _windows(chars_b, b.first[j[pair[some]]] + lo_b[some], hi_b[some] - lo_b[some], 1)
            size[some], at_a[some], at_b[some] = _longest_run(x, y)
            k = some.stop
        matched += np.bincount(pair, size, n).astype(np.int64)
        at_a, at_b = lo_a + at_a, lo_b + at_b
        on = size > 0
        pair, lo_a, hi_a, lo_b, hi_b = (
            np.concatenate([left[on], right[on]]) for left, right in (
                (pair, pair), (lo_a, at_a + size), (at_a, hi_a), (lo_b, at_b + size), (at_b, hi_b)))
    out = (_ratio_of(matched, total) >= least) & short
    matcher = SequenceMatcher(None)
    for k in np.nonzero(~short)[0]:
        matcher.set_seqs(a.texts[int(i[k])].as_py(), b.texts[int(j[k])].as_py())
        # real_quick_ratio and quick_ratio are upper bounds of ratio(): cheap exits
        out[k] = matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least and matcher.ratio() >= least
    return out


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of all texts as numbers, where each text begins, and
    its length."""
    t = texts.fill_null("").cast(pa.large_string())
    if not len(t):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.frombuffer(t.buffers()[1], np.int64)[t.offset : t.offset + len(t) + 1]
    raw = np.frombuffer(t.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    if len(raw) and raw.max() >= 128:
        begins = (raw & 0xC0) != 0x80  # bytes that begin a character
        at = np.concatenate([[0], np.cumsum(begins)])[at]
        raw = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return raw, at[:-1], np.diff(at)


def _windows(chars: np.ndarray, first: np.ndarray, length: np.ndarray, side: int) -> np.ndarray:
    """Parts of texts as columns, filled up with a number that no text and no
    other ``side`` has."""
    k = np.arange(length.max())[:, None]
    return np.where(k < length, chars[np.minimum(first + k, len(chars) - 1)], chars.dtype.type(np.iinfo(chars.dtype).max - side))


def _longest_run(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length and places of the longest common run of each column's two texts."""
    n = a.shape[1]
    kind = np.int8 if min(len(a), len(b)) < 127 else np.int16
    runs = np.zeros((len(a), len(b) + 1, n), kind)  # of the runs that end at a character of each
    before = np.zeros((len(b) + 1, n), kind)
    size, end = np.zeros(n, kind), np.zeros(n, np.int64)
    for i in range(len(a)):
        now = runs[i]
        np.add(before[:-1], 1, out=now[1:])
        now[1:] *= b == a[i]
        most = now.max(axis=0)
        end[most > size] = i
        np.maximum(size, most, out=size)
        before = now
    size = size.astype(np.int64)
    return size, end + 1 - size, runs[end, :, np.arange(n)].argmax(axis=1) - size


def length_bound(len_a: Column, len_b: Column, threshold: float) -> Column:
    """``2*min/(la+lb) >= t`` is a necessary condition for ``ratio >= t``
    (matched characters never exceed the shorter text)."""
    # the quotient, as the ratio itself is computed: a product rounds apart from it
    total = len_a + len_b
    return F.when(total > 0, F.least(len_a, len_b) * F.lit(2.0) / F.greatest(total, F.lit(1)) >= F.lit(float(threshold))).otherwise(F.lit(True))


def length_band(length: Column, threshold: float) -> Column:
    """Geometric length bucket with ratio ``(2-t)/t``: two texts that pass
    the length bound lie in the same or in adjacent buckets."""
    if threshold <= 0:
        return F.lit(0)
    r = (2.0 - threshold) / threshold
    if r <= 1.0:  # t == 1: only equal lengths
        return length.cast("long")
    # the nudge keeps exact powers of r from landing one band low through
    # rounding, so partners are never more than one band apart
    ratio = F.log(F.greatest(length, F.lit(1)).cast("double")) / F.lit(math.log(r))
    return F.floor(ratio + F.lit(1e-9)).cast("long")


#: fixed values: groups of characters that are counted, besides all others
GROUPS = ("01234", "56789", "AEIOU", "BCDFGHJ", "KLMNPQ", "RSTVWXYZ", " ", "abcdefghijklm", "nopqrstuvwxyz")


def character_groups(text: Column) -> Column:
    """How many characters of each group a text has, all others last."""
    counts = [F.length(text) - F.length(F.translate(text, g, "")) for g in GROUPS]
    return F.array(*counts, F.length(F.translate(text, "".join(GROUPS), "")))


def shared_bound(groups_a: Column, groups_b: Column, len_a: Column, len_b: Column, threshold: float) -> Column:
    """Matched characters are characters of both texts: a necessary condition
    for ``ratio >= t`` by ``character_groups``, in plain arithmetic."""
    shared = sum((F.least(F.get(groups_a, F.lit(g)), F.get(groups_b, F.lit(g))) for g in range(len(GROUPS) + 1)), F.lit(0))
    total = len_a + len_b
    return (total <= 0) | (shared * F.lit(2.0) / F.greatest(total, F.lit(1)) >= F.lit(float(threshold)))
