import datetime as dt
import random

from pyspark.sql import functions as F

from tallyspark.functions.identity import row_id
from tallyspark.operators.merge import merge_batch, merge_statement
from tests.model import fold, py_id

D = dt.datetime
SCHEMA_L = "date timestamp_ntz, account_name string, description string, amount double"
SCHEMA_S = "file string, stmt_seq long, row_no long, date timestamp_ntz, account_name string, description string, amount double"


def _ledger(spark, rows):
    return spark.createDataFrame([(r["date"], r["account_name"], r["description"], r["amount"]) for r in rows], SCHEMA_L)


def _stmts(spark, stmts):
    out = []
    for k, st in enumerate(stmts):
        for i, r in enumerate(st):
            out.append((f"f{k}", k, i, r["date"], r["account_name"], r["description"], r["amount"]))
    return spark.createDataFrame(out, SCHEMA_S)


def _row(d, desc, amt, acct="A"):
    return {"date": d, "description": desc, "amount": amt, "account_name": acct}


def test_row_id_fixture(spark):
    df = spark.createDataFrame([(D(2024, 1, 5), "A", "X", -5.0)], SCHEMA_L)
    got = df.select(row_id()).first()[0]
    assert got == "bc8d647b22a39c87e3f81c59da9433b1ab1bdeb8eea8806cf9cfe2b241bb44aa"
    assert got == py_id(D(2024, 1, 5), "X", -5.0, "A")


def test_fuzzy_update_and_append(spark):
    d = D(2024, 1, 5)
    ledger = [_row(d, "ATM W 001", -20.0), _row(d, "COFFEE", -3.5)]
    stmt = [_row(d, "ATM W 002", -20.0), _row(d, "COFFEE", -3.5), _row(d, "NEW", -1.0), _row(d, "NEW", -1.0)]
    res = merge_statement(_ledger(spark, ledger), _stmts(spark, [stmt]))
    got = sorted((r.description, r.id) for r in res.ledger.collect())
    exp, merged = fold(ledger, [stmt])
    assert got == sorted((r["description"], r["id"]) for r in exp)
    m = res.metrics.collect()[0]
    assert (m.parsed, m.merged, m.added) == (4, merged, 2)


def test_q2_collapse(spark):
    d = D(2024, 1, 5)
    ledger = [_row(d, "PAYMENT 001", 1.0), _row(d, "PAYMENT 002", 1.0)]
    stmt = [_row(d, "PAYMENT 001", 1.0), _row(d, "PAYMENT 002", 1.0), _row(d, "PAYMENT 003", 1.0)]
    res = merge_statement(_ledger(spark, ledger), _stmts(spark, [stmt]))
    got = sorted(r.description for r in res.ledger.collect())
    exp, _ = fold(ledger, [stmt])
    assert got == sorted(r["description"] for r in exp)
    assert got == sorted(["PAYMENT 003", "PAYMENT 003", "PAYMENT 001", "PAYMENT 002"])


def _random_case(rng, n_led, n_stmts, n_rows):
    days = [D(2024, 1, d) for d in (1, 2)]
    amts = [1.0, 2.0, None, -0.0, 0.0]
    words = ["ATM W 001", "ATM W 002", "ATM W 003", "SHOP", "SHOP X", None, "PAYROLL JAN", "PAYROLL FEB"]
    mk = lambda: _row(rng.choice(days + [None]), rng.choice(words), rng.choice(amts), rng.choice(["A", "B"]))
    return [mk() for _ in range(n_led)], [[mk() for _ in range(n_rows)] for _ in range(n_stmts)]


def test_batch_fold_equals_sequential(spark):
    rng = random.Random(7)
    for trial in range(4):
        ledger, stmts = _random_case(rng, 25, 3, 20)
        res = merge_batch(_ledger(spark, ledger), _stmts(spark, stmts))
        got = sorted(r.id for r in res.ledger.collect())
        exp, merged = fold(ledger, stmts)
        assert got == sorted(r["id"] for r in exp), trial
        assert res.metrics.agg(F.sum("merged")).first()[0] == merged, trial


def test_twelve_statements_equal_sequential(spark):
    """Blocks with up to twelve statements, others with two or one, among
    them a statement that re-describes rows an earlier one added; statement
    numbers are sparse and their text order is not their order."""
    rng = random.Random(23)
    ledger, stmts = _random_case(rng, 15, 12, 8)
    d = D(2024, 1, 1)
    for k in range(12):
        stmts[k].append(_row(d, f"CARD PAYMENT {k:03d}", 1.0))
        if k % 5 == 0:
            stmts[k].append(_row(d, "RENT JANUARY" + "!" * (k // 5), 2.0))
    rows = []
    for k, st in enumerate(stmts):
        rows += [(f"f{k}", 7 * k + 2, i, r["date"], r["account_name"], r["description"], r["amount"]) for i, r in enumerate(st)]
    res = merge_batch(_ledger(spark, ledger), spark.createDataFrame(rows, SCHEMA_S).repartition(4))
    exp, merged = fold(ledger, stmts)
    assert sorted((r.id, str(r.description)) for r in res.ledger.collect()) == sorted((r["id"], str(r["description"])) for r in exp)
    assert res.metrics.agg(F.sum("merged")).first()[0] == merged
    assert res.metrics.agg(F.sum("added")).first()[0] == len(exp) - len(ledger)


def test_hot_block_fold(spark):
    """One block holds every row (a hot key)."""
    d = D(2024, 2, 1)
    ledger = [_row(d, f"TRANSFER REF {i:04d}", 9.99) for i in range(0, 120, 2)]
    s1 = [_row(d, f"TRANSFER REF {i:04d}", 9.99) for i in range(0, 90)]
    s2 = [_row(d, f"TRANSFER REF {i:04d} OK", 9.99) for i in range(60, 140)]
    res = merge_batch(_ledger(spark, ledger), _stmts(spark, [s1, s2]))
    got = sorted(r.id for r in res.ledger.collect())
    exp, merged = fold(ledger, [s1, s2])
    assert got == sorted(r["id"] for r in exp)
    assert res.metrics.agg(F.sum("merged")).first()[0] == merged


def test_q2_protect_exact(spark):
    d = D(2024, 1, 5)
    ledger = [_row(d, "PAYMENT 001", 1.0), _row(d, "PAYMENT 002", 1.0)]
    stmt = [_row(d, "PAYMENT 001", 1.0), _row(d, "PAYMENT 002", 1.0), _row(d, "PAYMENT 003", 1.0)]
    res = merge_statement(_ledger(spark, ledger), _stmts(spark, [stmt]), mode="protect_exact")
    assert sorted(r.description for r in res.ledger.collect()) == ["PAYMENT 001", "PAYMENT 002", "PAYMENT 003"]


def test_protect_exact_matches_model(spark):
    rng = random.Random(11)
    ledger, stmts = _random_case(rng, 25, 3, 20)
    res = merge_batch(_ledger(spark, ledger), _stmts(spark, stmts), mode="protect_exact")
    exp, _ = fold(ledger, stmts, mode="protect_exact")
    assert sorted(r.id for r in res.ledger.collect()) == sorted(r["id"] for r in exp)


def test_partitioned_ledger_reads_the_statements_months(spark, tmp_path):
    from tallyspark.operators.merge import normalise_ledger
    from tallyspark.sources.ledger import read_ledger, write_ledger

    rows = [_row(D(2024, m, d), f"PAYMENT {m:02d}{d:02d}", float(d)) for m in range(1, 7) for d in range(1, 6)] + [_row(None, "NO DATE", 1.0)]
    stmt = [_row(D(2024, 3, 2), "PAYMENT 0302!", 2.0), _row(D(2024, 5, 9), "NEW", -1.0), _row(None, "NO DATE", 1.0), _row(D(2024, 3, 3), "PAYMENT 0303", 3.0)]
    whole = normalise_ledger(_ledger(spark, rows))
    write_ledger(whole, str(tmp_path / "l"), partition_by_month=True)
    ledger = read_ledger(spark, str(tmp_path / "l"))
    months = ledger.where(F.coalesce("ym", F.lit("none")).isin("2024-03", "none"))
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [coalesce(ym" in plan
    got = merge_batch(ledger, _stmts(spark, [stmt])).ledger
    exp, _ = fold(rows, [stmt])
    assert sorted(r.id for r in got.collect()) == sorted(r["id"] for r in exp) and "ym" not in got.columns
