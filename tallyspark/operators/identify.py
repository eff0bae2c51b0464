"""Statement identification (B1-B9): which account does a file belong to.

The fingerprint of a file is its first characters, upper-cased, blanks
removed (B1).  Which account patterns match it (B2) is not tried pattern by
pattern: every text that matches a pattern contains the pattern's required
literal (its longest run of plain characters).  One look over the text finds
the literals that it contains, an equi-join brings their patterns, and only
those are tried.  The few patterns without a literal are tried on every text,
each compiled once.  Files matching exactly one account are kept (B4); the
others are rejects with a reason.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.common import checkpointed, sized_broadcast
from tallyspark.sources.grid import file_text, row_texts

DEFAULT_NUM_CHARS = 400
# a literal is found by so many of its first characters
KEY_CHARS = 4
# up to so many literals are looked for one by one, without Python
FEW_LITERALS = 128


def required_literal(pattern: str | None) -> str | None:
    """Characters that every match of a pattern contains, in a row; None
    where that is not plain to see (alternatives, flags, fewer than two)."""
    runs, run = [], ""
    k, n = 0, len(pattern or "")

    def ended():
        nonlocal run
        runs.append(run)
        run = ""

    while k < n:
        c = pattern[k]
        if c == "|" or pattern.startswith("(?", k) and not pattern.startswith("(?:", k):
            return None
        if c == "\\":
            nxt = pattern[k + 1 : k + 2]
            if nxt.isalnum():  # a class, a boundary, a quotation
                if nxt in "QEpPxuckN0123456789":
                    return None
                ended()
            else:
                run += nxt
            k += 2
        elif c == "[":
            close = pattern.find("]", k + 2)
            inner = pattern[k + 1 : close]
            if close < 0 or "[" in inner or "&&" in inner or "\\" in inner:
                return None
            if len(inner) == 1:
                run += inner  # a class of one character
            else:
                ended()
            k = close + 1
        elif c == "(":
            ended()
            depth, k = 1, k + 1
            while k < n and depth:  # what a group needs is left out
                if pattern[k] in "\\[":
                    return None
                depth += (pattern[k] == "(") - (pattern[k] == ")")
                k += 1
        elif c in "*?{":
            run = run[:-1]  # the last character may be missing
            ended()
            k = pattern.find("}", k) + 1 if c == "{" else k + 1
            if k == 0:
                return None
        elif c in "+.^$)":
            ended()
            k += 1
        else:
            run += c
            k += 1
    ended()
    best = max(runs, key=len)
    return best if len(best) > 1 else None


# what may match a line break or depend on where the text begins or ends
_LINES = re.compile(r"[\n\r^$]|\(\?|\\[^dwbB.\[\](){}*+?|/-]")


def within_a_line(pattern: str | None) -> bool:
    """Whether a pattern matches a text just where it matches one of its
    lines: nothing in it can match a line break, an end or a beginning."""
    return pattern is not None and not _LINES.search(pattern)


@F.pandas_udf(T.BooleanType())
def _within_a_line(patterns: pd.Series) -> pd.Series:
    return patterns.map(within_a_line)


@F.pandas_udf(T.StringType())
def _literal_of(patterns: pd.Series) -> pd.Series:
    return patterns.map(required_literal)


def _literals_in(literals: list[str]):
    """A function of a text column: the literals that each text contains."""
    if len(literals) <= FEW_LITERALS:
        return lambda text: F.array_compact(F.array(*[F.when(F.contains(text, F.lit(x)), F.lit(x)) for x in literals]))
    by_start: dict[str, list[str]] = {}
    for x in literals:
        by_start.setdefault(x[:KEY_CHARS], []).append(x)
    sizes = sorted({len(k) for k in by_start})

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def found(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            hits = set()
            for k in sizes if t else ():
                for at in range(len(t) - k + 1):
                    for x in by_start.get(t[at : at + k], ()):
                        if t.startswith(x, at):
                            hits.add(x)
            out.append(sorted(hits))
        return pd.Series(out, dtype=object)

    return found


def fingerprint(text: Column, num_chars: int = DEFAULT_NUM_CHARS, normalize: bool = True) -> Column:
    """B1: first ``num_chars`` characters, then blanks removed, upper case.
    ``normalize=False`` keeps the raw text (B3)."""
    if not normalize:
        return text
    return F.upper(F.replace(F.substring(text, 1, num_chars), F.lit(" "), F.lit("")))


def match_accounts(texts: DataFrame, accounts: DataFrame, num_chars: int = DEFAULT_NUM_CHARS,
                   normalize: bool = True) -> DataFrame:
    """B2: (file, account attributes) for every pattern found in a file's
    fingerprint.  ``texts``: (file, text)."""
    fp = texts.select("file", fingerprint(F.col("text"), num_chars, normalize).alias("fp"))
    known = checkpointed(accounts.withColumn("literal", _literal_of("id_pattern")))  # configuration
    literals = [r[0] for r in known.where("literal IS NOT NULL").select("literal").distinct().collect()]
    plain = [r[0] for r in known.where("literal IS NULL").select("id_pattern").where("id_pattern IS NOT NULL").distinct().collect()]
    out = None
    if literals:
        hits = fp.withColumn("literal", F.explode(_literals_in(literals)(F.col("fp"))))
        out = hits.join(sized_broadcast(known), "literal").where(F.regexp_like("fp", "id_pattern"))
        out = out.select("file", *accounts.columns)
    if plain or out is None:
        tried = F.array(*[F.when(F.col("fp").rlike(p), F.lit(p)) for p in plain]) if plain else F.array().cast("array<string>")
        hits = fp.select("file", F.explode(F.array_compact(tried)).alias("id_pattern"))
        more = hits.join(sized_broadcast(known.where("literal IS NULL")), "id_pattern").select("file", *accounts.columns)
        out = more if out is None else out.unionByName(more)
    return out


def split_unique(matches: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with exactly one matching account, and rejects
    (file, reason) for files with none or several."""
    per_file = matches.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.min_by(F.struct("account_name", "currency", "bank", "account_type"), "account_name").alias("a"),
    )
    unique = per_file.where(F.col("n_matches") == 1).select(
        "file", "a.account_name", "a.currency", "a.bank", "a.account_type")
    several = per_file.where(F.col("n_matches") > 1).select("file", F.lit("more than one account matched").alias("reason"))
    none = files.select("file").join(per_file.select("file"), on="file", how="left_anti") \
        .select("file", F.lit("no account matched").alias("reason"))
    return unique, several.unionByName(none)


def identify(grid: DataFrame, accounts: DataFrame, num_chars: int = DEFAULT_NUM_CHARS,
             normalize: bool = True) -> tuple[DataFrame, DataFrame]:
    """B1-B5 over GRID rows: (routed files, rejects).  ``normalize=False``
    matches the patterns on the whole raw text of a file (B3): row by row, so
    a file may be of any size.  Only for patterns that may match a line break,
    the file's beginning or its end, the file is one text in one task."""
    if normalize:
        texts = file_text(grid, num_chars)
        return split_unique(match_accounts(texts, accounts, num_chars), texts)
    known = checkpointed(accounts.withColumn("within", _within_a_line("id_pattern")))
    lines = row_texts(grid).select("file", F.col("line").alias("text"))
    matches = match_accounts(lines, known.where("within").drop("within"), normalize=False)
    across = known.where("NOT within").drop("within")
    if not across.isEmpty():
        matches = matches.unionByName(match_accounts(file_text(grid, None), across, normalize=False))
    return split_unique(matches.distinct(), grid.select("file").distinct())


def account_from_filename(filename: Column) -> Column:
    """Text before the first '.', then before the first '(', trimmed."""
    base = F.substring_index(filename, ".", 1)
    return F.trim(F.substring_index(base, "(", 1))


def unknown_accounts(names: DataFrame, accounts: DataFrame, col: str = "account_name") -> DataFrame:
    """Names that are not configured accounts (left anti join)."""
    return names.join(accounts.select(F.col("account_name").alias(col)), on=col, how="left_anti")
