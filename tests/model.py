"""A plain-Python model of the sequential statement fold, used as the
brute-force check for the Spark merge on small fixtures."""

from __future__ import annotations

import hashlib
from difflib import SequenceMatcher


def py_amount(x):
    return "nan" if x is None or x != x else repr(float(x))


def py_date(d):
    if d is None:
        return "NaT"
    s = d.strftime("%Y-%m-%d %H:%M:%S")
    if d.microsecond:
        s += ".%06d" % d.microsecond
    return s


def py_id(date, desc, amount, acct):
    t = py_date(date) + ("nan" if desc is None else desc) + py_amount(amount) + ("nan" if acct is None else acct)
    return hashlib.sha256(t.encode()).hexdigest()


def _key_eq(a, b):
    # pandas ``==``: missing values never equal
    return a is not None and b is not None and a == b and a == a


def fold(ledger: list[dict], statements: list[list[dict]], threshold: float = 0.8, mode: str = "reference"):
    """ledger rows and statements: dicts with date, description, amount,
    account_name.  Returns (final ledger rows, merged pair count)."""
    led = [dict(r, id=py_id(r["date"], r["description"], r["amount"], r["account_name"])) for r in ledger]
    merged = 0
    for stmt in statements:
        rows = [dict(r, id=py_id(r["date"], r["description"], r["amount"], r["account_name"])) for r in stmt]
        before = [r["description"] for r in led]
        after = list(before)
        for n in rows:
            if n["description"] is None:
                continue
            for i, l in enumerate(led):
                if mode == "protect_exact":
                    # either text has an exact partner in the same block: skip
                    same_block = lambda a, b: all(_key_eq(a[k], b[k]) for k in ("date", "amount", "account_name"))
                    if any(same_block(o, n) and before[j] == n["description"] for j, o in enumerate(led)):
                        continue
                    if any(same_block(r, l) and r["description"] == before[i] for r in rows):
                        continue
                if not (_key_eq(l["date"], n["date"]) and _key_eq(l["amount"], n["amount"])
                        and _key_eq(l["account_name"], n["account_name"])):
                    continue
                if before[i] is None or before[i] == n["description"]:
                    continue
                if SequenceMatcher(None, before[i], n["description"]).ratio() >= threshold:
                    after[i] = n["description"]
                    merged += 1
        for i, l in enumerate(led):
            if after[i] != before[i]:
                l["description"] = after[i]
                l["id"] = py_id(l["date"], l["description"], l["amount"], l["account_name"])
        present = {l["id"] for l in led}
        led.extend([r for r in rows if r["id"] not in present])
    return led, merged
