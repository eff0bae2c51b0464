"""Operator tests on hand-made edge rows (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import clean as C
from tallyspark.functions.identity import amount_text, row_id
from tests.model import py_id


def _col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_numeric_clean(spark):
    vals = ["L 1,234.50", "$-5", "", "  ", "-", "1.2.3", "1.", ".5", "1.234,56", None]
    df = _col(spark, vals, "string")
    got = [r[0] for r in df.select(C.round_half_even_2(C.to_number(C.numeric_text("x"), digits_only=True))).collect()]
    assert got == [1234.5, -5.0, None, None, None, None, 1.0, 0.5, 1.23, None]
    got2 = [r[0] for r in df.select(C.round_half_even_2(C.to_number(C.blank_to_null(C.keep_numeric_chars("x"))))).collect()]
    assert got2 == got


def test_round_half_even(spark):
    got = [r[0] for r in _col(spark, [0.285, 2.675, 0.125, -0.125], "double").select(C.round_half_even_2("x")).collect()]
    assert got == [0.28, 2.68, 0.12, -0.12]


def test_collapse_whitespace(spark):
    vals = ["a b", "a b", "a\tb", "a\x1cb", "a\x85b", "  a   b  "]
    got = [r[0] for r in _col(spark, vals, "string").select(C.collapse_ws("x")).collect()]
    assert got == [" ".join(v.split()) for v in vals]


def test_blank_rows(spark):
    vals = [None, "", "   ", " ", "x"]
    got = [r[0] for r in _col(spark, vals, "string").select(C.is_blank("x")).collect()]
    assert got == [True, True, True, True, False]


def test_lenient_dates(spark):
    vals = ["05/01/2024", "5/1/2024", "31/02/2024", "bad", "05/01/2024 x"]
    got = [r[0] for r in _col(spark, vals, "string").select(C.parse_date("x")).collect()]
    d = dt.datetime(2024, 1, 5)
    assert got == [d, d, None, None, None]


def test_strict_dates_raise(spark):
    df = _col(spark, ["bad"], "string")
    with pytest.raises(Exception):
        df.select(C.parse_date("x", strict=True)).collect()


def test_timestamp_to_day(spark):
    got = _col(spark, ["2024-03-05 13:14:15"], "string").select(C.parse_timestamp_day("x")).first()[0]
    assert got == dt.datetime(2024, 3, 5)


def test_amount_text(spark):
    vals = [1.0, 12.5, 0.01, 1e7, -0.0, 0.0, None, 123456.78, 0.1 + 0.2, 1.5e-5]
    got = [r[0] for r in _col(spark, vals, "double").select(amount_text("x")).collect()]
    assert got == ["nan" if v is None else repr(v) for v in vals]


def test_row_id_fixture(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), "X", -5.0, "A")],
                               "date timestamp_ntz, description string, amount double, account_name string")
    got = df.select(row_id()).first()[0]
    assert got == "bc8d647b22a39c87e3f81c59da9433b1ab1bdeb8eea8806cf9cfe2b241bb44aa"
    frac = dt.datetime(2024, 1, 5, 1, 2, 3, 4500)
    df2 = spark.createDataFrame([(frac, None, None, "A")],
                                "date timestamp_ntz, description string, amount double, account_name string")
    assert df2.select(row_id()).first()[0] == py_id(frac, None, None, "A")


def test_na_tokens(spark):
    vals = ["NA", "N/A", "null", "x", "", "None"]
    got = [r[0] for r in _col(spark, vals, "string").select(C.na_tokens_to_null("x")).collect()]
    assert got == [None, None, None, "x", None, None]


def test_shared_characters_bound_the_ratio(spark):
    """No pair that reaches the threshold is lost to the native bound."""
    import random
    from difflib import SequenceMatcher

    from tallyspark.functions.similarity import character_groups, shared_bound

    rng = random.Random(2)
    texts = ["".join(rng.choice("ABCdé1 \U0001f600") for _ in range(rng.randint(0, 25))) for _ in range(60)]
    texts += [t[:-2] + "zz" for t in texts[:30]]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    la, lb = F.length("a"), F.length("b")
    bound = shared_bound(character_groups(F.col("a")), character_groups(F.col("b")), la, lb, 0.8)
    rows = df.select("a", "b", bound.alias("may")).collect()
    assert all(r["may"] for r in rows if SequenceMatcher(None, r["a"], r["b"]).ratio() >= 0.8)
    assert sum(not r["may"] for r in rows) > len(rows) / 2


def test_patterns_by_literal_equal_the_cross_test(spark):
    """5,000 patterns against texts, and each against each."""
    import random
    import re

    from tallyspark.operators.identify import match_accounts, required_literal

    for pattern, literal in (("BAC.*911", "BAC"), ("AB|CD", None), ("(?i)ABC", None), ("A\\.B\\d+", "A.B"), ("ABC?D", "AB"), ("[|]X", "|X"), ("[AB]XYZ+", "XYZ"),
                             ("(AB)+CDE", "CDE"), ("X{2}AB", "AB"), ("^ABC$", "ABC"), ("\\QA*B\\E", None), ("A", None), ("", None), ("ABCD*", "ABC")):
        assert required_literal(pattern) == literal, pattern
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ABCDE01") for _ in range(n))
    shapes = [lambda: word(4), lambda: word(2) + "[0-9]" + word(3), lambda: word(3) + ".*" + word(2), lambda: word(2) + "|" + word(4), lambda: "[AB]{3}", lambda: word(3) + "?" + word(2), lambda: "(" + word(2) + ")+" + word(2)]
    patterns = [rng.choice(shapes)() for _ in range(5000)]
    texts = [(f"f{k}", word(rng.randint(0, 30))) for k in range(40)]
    accounts = spark.createDataFrame([(f"a{k}", p) for k, p in enumerate(patterns)], "account_name string, id_pattern string")
    found = match_accounts(spark.createDataFrame(texts, "file string, text string"), accounts)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    got = sorted((r["file"], r["account_name"]) for r in found.collect())
    assert got == sorted((f, f"a{k}") for f, t in texts for k, p in enumerate(patterns) if re.search(p, t.upper()))
