"""Similar texts at size."""

import random
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import functions as F

from tallyspark.functions import similarity as S
from tallyspark.operators.merge import similar_matches


def _texts(rng, alphabet, most):
    a = [rng.choice(alphabet) for _ in range(rng.randint(0, most))]
    b = list(a) if rng.random() < 0.6 else [rng.choice(alphabet) for _ in range(rng.randint(0, most))]
    for _ in range(rng.randint(0, 4)):
        b.insert(rng.randint(0, len(b)), rng.choice(alphabet))
        b.pop(rng.randrange(len(b)))
    return "".join(a), "".join(b)


def test_batches_of_pairs_equal_difflib():
    """the ratio of a whole batch, with texts on both sides of difflib's limit."""
    rng = random.Random(5)
    for alphabet, most in (("ab", 20), ("PAY REF0123456789", 30), ("aé€\U0001f600\x00b", 15), ("abcdefghij ", 230)):
        pairs = [_texts(rng, alphabet, most) for _ in range(150)] + [(None, "x"), ("x", None), ("", "")]
        a, b = zip(*pairs)
        for least in (0.0, 0.5, 0.8, 1.0):
            got = S._similar(pa.array(a, pa.string()), pa.array(b, pa.string()), least).to_pylist()
            assert got == [None if x is None or y is None else SequenceMatcher(None, x, y).ratio() >= least for x, y in pairs]


def test_blocks_of_many_texts_are_compared_in_arrays(spark, monkeypatch):
    """a block of more texts than an array holds: the last match, the
    greatest file and the rows of all matches, without a row for each pair."""
    monkeypatch.setattr("tallyspark.operators.merge.CHUNK", 7)
    rng = random.Random(3)
    left = [("A", f"PAY REF {k}") for k in rng.sample(range(400), 30)] + [("B", "ONE"), ("C", "é x")]
    right = [("A", f"PAY REF {k}{x}", n, n % 3 + 1, f"f{n % 4}" if n % 5 else None) for n, (k, x) in enumerate(
        (rng.randrange(400), rng.choice(["", " X", " a long way off"])) for _ in range(40))]
    right = list({r[1]: r for r in right}.values()) + [("B", "ONE", 1, 1, "f"), ("C", "é y", 1, 2, "f"), ("C", "é x", 2, 2, "f")]
    keys = "timestamp_ntz'2024-01-05' AS date", "1D AS amount", "account_name"
    lft = spark.createDataFrame(left, "account_name string, l_desc string").selectExpr(*keys, "l_desc")
    rgt = spark.createDataFrame(right, "account_name string, n_desc string, n_last long, n_cnt long, n_file string").selectExpr(
        *keys, "n_desc", "n_last", "n_cnt", "n_file")
    got = similar_matches(lft, rgt, 0.6).groupBy("account_name", "l_desc").agg(
        F.max_by("new_desc", "n_last"), F.sum("n_cnt"), F.max("n_file"), F.max_by("last_file", "n_last"))
    expected = []
    for account, text in left:
        near = sorted((r for r in right if r[0] == account and r[1] != text and SequenceMatcher(None, text, r[1]).ratio() >= 0.6), key=lambda r: r[2])
        if near:
            expected.append((account, text, near[-1][1], sum(r[3] for r in near), max((r[4] for r in near if r[4]), default=None), near[-1][4]))
    assert sorted(map(tuple, got.collect())) == sorted(expected) and len(expected) > 20
