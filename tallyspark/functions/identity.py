"""Content-addressed row identity (F1).

The id is SHA-256 over the Python text of four values, concatenated with no
delimiter: ``str(date) + str(description) + str(amount) + str(account)``.
Byte-exact reproduction matters because ids of existing ledgers must stay
stable. Everything is a native expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Python texts of missing values.
NULL_TEXT = "nan"
NULL_DATE_TEXT = "NaT"
HASH_COLUMNS = ("date", "description", "amount", "account_name")


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def date_text(col: Column | str) -> Column:
    """``str(pandas.Timestamp)``: ``yyyy-MM-dd HH:mm:ss`` plus ``.ffffff``
    when the value has a fraction; ``NaT`` when missing."""
    c = _c(col)
    base = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    micros = F.pmod(F.unix_micros(c.cast("timestamp")), F.lit(1_000_000))
    txt = F.when(micros == 0, base).otherwise(
        F.concat(base, F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.when(c.isNull(), F.lit(NULL_DATE_TEXT)).otherwise(txt)


def amount_text(col: Column | str) -> Column:
    """Python ``repr`` of a double.

    * cent values (the normal case) go through ``decimal(38,2)``, which is
      exact and independent of the JVM's double printing;
    * other values in [1e-4, 1e16) are printed in plain notation from the
      JVM's shortest digits, trailing zeros removed;
    * values outside that range use Python's exponent form ``1.5e-05``.
      (Java 17 may print one extra digit for some values >= 1e16.)
    """
    x = _c(col)
    ax = F.abs(x)
    java = x.cast("string")
    dec = x.cast("decimal(38,2)").cast("string")  # always two decimals
    cents = F.when(dec.endswith("0"), dec.substr(F.lit(1), F.length(dec) - 1)).otherwise(dec)
    stripped = F.regexp_replace(java.cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.concat(stripped, F.when(stripped.endswith("."), F.lit("0")).otherwise(F.lit("")))
    sci_pat = r"^(-?[0-9.]+)E(-?[0-9]+)$"
    expo = F.regexp_extract(java, sci_pat, 2).cast("int")
    sci = F.concat(
        F.regexp_replace(F.regexp_extract(java, sci_pat, 1), r"\.0$", ""),
        F.lit("e"),
        F.when(expo < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(expo).cast("string"), 2, "0"),
    )
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(NULL_TEXT))
        .when(x == 0, F.when(java.startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
        .when(ax == F.lit(float("inf")), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((ax < 1e13) & (F.rint(x * 100.0) / 100.0 == x), cents)
        .when((ax >= 1e-4) & (ax < 1e16), plain)
        .otherwise(sci)
    )


def text_or_nan(col: Column | str) -> Column:
    return F.coalesce(_c(col).cast("string"), F.lit(NULL_TEXT))


def row_id(
    date: Column | str = "date",
    description: Column | str = "description",
    amount: Column | str = "amount",
    account_name: Column | str = "account_name",
) -> Column:
    """SHA-256 hex over date, description, amount, account (no delimiter)."""
    return F.sha2(
        F.concat(date_text(date), text_or_nan(description), amount_text(amount), text_or_nan(account_name)),
        256,
    )


def id_of_texts(date: Column | str, description: Column | str, amount_txt: Column | str, account_name: Column | str) -> Column:
    """``row_id`` of an amount that is already its Python text.  Grouping
    makes -0.0 and 0.0 equal, whose texts, and so ids, differ."""
    return F.sha2(F.concat(date_text(date), text_or_nan(description), _c(amount_txt), text_or_nan(account_name)), 256)
