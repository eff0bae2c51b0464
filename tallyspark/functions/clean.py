"""Cleaning primitives (text -> typed values), all native Spark expressions.

The statement files arrive as text cells; these functions reproduce the
cleaning steps of the ledger tool exactly, including its whitespace notion
(Python ``str.split``), its number coercion and numpy's half-to-even
rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the behaviour being reproduced)
# ---------------------------------------------------------------------------
# Python's str.split()/str.strip() whitespace = Java's Unicode \s plus the
# four information separators U+001C..U+001F.
# Listed explicitly (a plain character class is much faster than (?U)\s).
WS_CLASS = (
    r"[\t\n\x0b\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
# the same characters as a plain string, for btrim
WS_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WS_RUN = WS_CLASS + "+"
WS_ONLY = "^" + WS_CLASS + "*$"
# Characters kept by the numeric cleaner: digits, dot and minus.
NUMERIC_JUNK = r"[^0-9.\-]"
# Text that a plain float parser accepts after cleaning.
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Cell texts that the CSV reader of the ledger tool turns into missing values
# (pandas' default na_values).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Day-first date text of the bank exports (``%d/%m/%Y``; one-digit day and
# month are accepted, as strptime does).
DAY_FIRST = "d/M/yyyy"
# Timestamp text of the Revolut export (``%Y-%m-%d %H:%M:%S``).
ISO_SECONDS = "yyyy-M-d H:m:s"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def na_tokens_to_null(col: Column | str) -> Column:
    """Cell texts the CSV reader treats as missing become NULL."""
    c = _c(col)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def is_blank(col: Column | str) -> Column:
    """NULL, empty or whitespace-only text (D1 / D3 predicate)."""
    c = _c(col)
    return c.isNull() | (F.btrim(c, F.lit(WS_CHARS)) == "")


def collapse_ws(col: Column | str) -> Column:
    """Whitespace runs -> one blank, then strip (``" ".join(s.split())``)."""
    return F.trim(F.regexp_replace(_c(col), WS_RUN, " "))


def strip_ws(col: Column | str) -> Column:
    """Leading and trailing whitespace removed (Python ``str.strip``).
    Equals :func:`collapse_ws` for text without inner whitespace, such as a
    valid day-first date."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def keep_numeric_chars(col: Column | str) -> Column:
    """Delete every character that is not a digit, a dot or a minus."""
    return F.regexp_replace(_c(col), NUMERIC_JUNK, "")


def blank_to_null(col: Column | str) -> Column:
    """D3: whitespace-only text -> NULL."""
    c = _c(col)
    return F.when(F.btrim(c, F.lit(WS_CHARS)) == "", F.lit(None).cast("string")).otherwise(c)


def to_number(col: Column | str, digits_only: bool = False) -> Column:
    """``to_numeric(errors='coerce')`` on trimmed text; junk -> NULL.

    ``digits_only``: the text went through :func:`keep_numeric_chars`, so
    only digits, dots and minus signs are left and a plain ``try_cast``
    accepts exactly what the reference accepts."""
    if digits_only:
        return _c(col).try_cast("double")
    c = F.trim(_c(col))
    return F.when(c.rlike(NUMBER_TEXT), c.cast("double"))


def numeric_text(col: Column | str) -> Column:
    """D2 + D3: keep digits, dots and minus; empty -> NULL."""
    return F.nullif(keep_numeric_chars(col), F.lit(""))


def round_half_even_2(col: Column | str) -> Column:
    """Numpy ``round(2)``: scale by 100, round half to even, unscale."""
    return F.rint(_c(col) * F.lit(100.0)) / F.lit(100.0)


def negate(col: Column | str) -> Column:
    """``x * -1.0`` (0 becomes -0.0, as in the reference)."""
    return _c(col) * F.lit(-1.0)


def parse_date(col: Column | str, fmt: str = DAY_FIRST, strict: bool = False,
               stripped: bool = False) -> Column:
    """Parse day-first text to ``timestamp_ntz``.

    Empty text is missing in both modes.  ``strict`` raises on malformed
    text (ANSI ``to_timestamp``); lenient gives NULL.  ``stripped``: the
    text has no leading/trailing whitespace, so blank means empty.
    """
    c = _c(col)
    parsed = F.to_timestamp(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt))
    blank = (c.isNull() | (c == "")) if stripped else is_blank(c)
    return F.when(blank, F.lit(None)).otherwise(parsed).cast("timestamp_ntz")


def parse_timestamp_day(col: Column | str, fmt: str = ISO_SECONDS, strict: bool = True) -> Column:
    """Parse a timestamp and cut it to midnight."""
    ts = parse_date(col, fmt, strict).cast("timestamp")
    return F.date_trunc("DAY", ts).cast("timestamp_ntz")
