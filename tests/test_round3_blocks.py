"""Which blocks of a merge need a comparison."""

import datetime as dt

from tallyspark.operators import merge as M

D = dt.datetime(2024, 1, 5)
ROWS = "date timestamp_ntz, amount double, account_name string, description string"


def test_blocks_of_one_text_are_not_compared(spark, monkeypatch):
    """blocks with one text never reach the comparison, however many
    statements hold it; the ledger's texts and nulls count as they should."""
    touched = spark.createDataFrame([(D, 1.0, "one", "T"), (D, 1.0, "ledger", "U"), (D, 1.0, "null", None), (D, None, "key", "T"), (D, 1.0, "alone", "A"), (D, 1.0, "alone", "B")], ROWS)
    stmts = spark.createDataFrame(
        [(D, 1.0, a, t, s) for a, t, s in (
            ("one", "T", 0), ("one", "T", 1), ("ledger", "T", 0), ("null", "T", 0), ("null", "T", 1), ("single", "T", 2), ("single", "U", 2), ("two", "T", 0), ("two", "U", 1))]
        + [(D, None, "key", "U", 1)], ROWS + ", stmt_seq long")
    blocks = {r["account_name"]: r["contested"] for r in M.mixed_blocks(touched, stmts).collect()}
    assert blocks == {"ledger": False, "single": False, "two": True, "alone": False}

    compared = []
    pairs = M.similar_matches
    monkeypatch.setattr(M, "similar_matches", lambda left, right, t: compared.extend(r["account_name"] for r in right.collect()) or pairs(left, right, t))
    ledger = touched.where("account_name IN ('one', 'ledger')")
    res = M.merge_batch(ledger, stmts.where("account_name IN ('one', 'ledger')").selectExpr("*", "concat('f', stmt_seq) AS file", "1L AS row_no"))
    assert compared == ["ledger"]
    assert sorted((r["account_name"], r["description"]) for r in res.ledger.collect()) == [("ledger", "T"), ("ledger", "U"), ("one", "T")]
