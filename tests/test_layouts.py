"""Layout interpreter, header rules, identification and routing."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark.operators import layouts as LY
from tallyspark.operators.identify import account_from_filename, match_accounts, split_unique
from tallyspark.sources.accounts import screen_patterns

GRID = "file string, row_no long, cells array<string>"


def _grid(spark, files):
    rows = []
    for f, lines in files.items():
        for i, cells in enumerate(lines):
            rows.append((f, i, cells))
    return spark.createDataFrame(rows, GRID)


def _routed(spark, files, account="ACC", currency="USD"):
    return spark.createDataFrame([(f, account, currency) for f in files], "file string, account_name string, currency string")


def test_bac_card_dual_currency(spark):
    hdr = ["Account Name", "Fecha", "Concepto", "Monto lempiras", "Monto dólares"]
    g = _grid(spark, {"a.csv": [hdr,
                                ["X", "05/01/2024", "HNL only", "L 10.00", None],
                                ["X", "05/01/2024", "USD only", None, "$5.50"],
                                ["X", "05/01/2024", "zero hnl", "0.00", "$7"],
                                ["X", "05/01/2024", "none", None, None],
                                [" ", "05/01/2024", "blank first", "1", None]]})
    rows, rej = LY.normalise(g, _routed(spark, ["a.csv"]), LY.BAC_CARD)
    got = {r.description: (r.currency, r.amount, r.tran_type) for r in rows.collect()}
    assert got["HNL only"] == ("HNL", -10.0, "Expense")
    assert got["USD only"] == ("USD", -5.5, "Expense")
    cur, amt, _ = got["zero hnl"]
    assert cur == "HNL" and amt == 0.0 and str(amt) == "-0.0"
    assert got["none"][0] == "USD" and got["none"][1] is None
    assert "blank first" not in got
    assert rej.count() == 0


def test_debit_credit(spark):
    hdr = ["Account Name", "Fecha", "Referencia", "Descripción", "Débitos", "Créditos", "Balance"]
    g = _grid(spark, {"s.csv": [hdr,
                                ["X", "1/2/2024", "1", "debit", "12.50", None, "0"],
                                ["X", "1/2/2024", "2", "credit", None, "3.00", "0"],
                                ["X", "1/2/2024", "3", "zero debit", "0.00", "4.00", "0"],
                                ["X", "1/2/2024", "4", "nothing", None, None, "0"]]})
    rows, _ = LY.normalise(g, _routed(spark, ["s.csv"]), LY.BAC_SAVINGS)
    got = {r.description: (r.amount, r.tran_type) for r in rows.collect()}
    assert got == {"debit": (-12.5, "Expense"), "credit": (3.0, "Income"), "zero debit": (4.0, "Income"),
                   "nothing": (None, "Income")}


def test_keyword_header_depths(spark):
    hdr = ["Fecha", "Descripción", "N° Cheque", "Débito", "Crédito", "Balance"]
    data = ["05/01/2024", "x", None, "1.00", None, "9"]
    files = {
        "h0.csv": [hdr, data],
        "h2.csv": [["BANCO"], ["Cuenta"], hdr, data],
        "h5.csv": [["B"]] * 5 + [hdr, data],
        "none.csv": [["B"], data],
    }
    rows, rej = LY.normalise(_grid(spark, files), _routed(spark, list(files)), LY.FICOHSA_SAVINGS)
    assert sorted(r.file for r in rows.collect()) == ["h0.csv", "h2.csv", "h5.csv"]
    assert [(r.file, r.reason) for r in rej.collect()] == [("none.csv", "header_not_found")]


def test_missing_column_rejected(spark):
    g = _grid(spark, {"m.csv": [["Fecha", "Concepto"], ["05/01/2024", "x"]]})
    rows, rej = LY.normalise(g, _routed(spark, ["m.csv"]), LY.BAC_CARD)
    assert rows.count() == 0
    assert rej.first().reason.startswith("missing_columns")


def test_revolut_blank_check_on_first_kept_column(spark):
    hdr = ["Type", "Product", "Started Date", "Completed Date", "Description", "Amount", "Fee", "Currency",
           "State", "Balance"]
    g = _grid(spark, {"r.csv": [hdr,
                                ["CARD", "Current", "2024-01-05 10:11:12", "", "Coffee", "-3.5", "0", "EUR", "COMPLETED", ""],
                                ["CARD", "Current", "  ", "", "dropped", "-1", "0", "EUR", "COMPLETED", ""]]})
    rows, _ = LY.normalise(g, _routed(spark, ["r.csv"]), LY.REVOLUT_SAVINGS)
    r = rows.collect()
    assert len(r) == 1 and r[0].date == dt.datetime(2024, 1, 5) and r[0].amount == -3.5


def test_routing(spark):
    df = spark.createDataFrame([("BAC", "savings"), ("REVOLUT", "credit_card"), ("FICOHSA", "credit_card"),
                                ("HSBC", "savings")], "bank string, t string")
    got = [r[0] for r in df.select(LY.route(F.col("bank"), F.col("t"))).collect()]
    assert got == ["bac_savings", "reject: Revolut card statements cannot be read yet",
                   "reject: account type not supported", "reject: unknown bank: HSBC"]


def test_identify_unique(spark):
    acc = spark.createDataFrame(
        [("A1", "USD", "BAC", "savings", "ACC111"), ("A2", "USD", "BAC", "savings", "ACC222"),
         ("A3", "USD", "BAC", "savings", "ACC2")],
        "account_name string, currency string, bank string, account_type string, id_pattern string")
    texts = spark.createDataFrame([("f0", "nothing"), ("f1", "cuenta acc 111"), ("f2", "acc 222")], "file string, text string")
    unique, rej = split_unique(match_accounts(texts, acc), texts)
    assert [(r.file, r.account_name) for r in unique.collect()] == [("f1", "A1")]
    assert sorted((r.file, r.reason) for r in rej.collect()) == [
        ("f0", "no account matched"), ("f2", "more than one account matched")]


def test_bad_pattern_screened(spark):
    acc = spark.createDataFrame([("A", None, None, None, "("), ("B", None, None, None, "OK")],
                                "account_name string, currency string, bank string, account_type string, id_pattern string")
    valid, bad = screen_patterns(acc)
    assert bad == ["A"] and valid.count() == 1


def test_account_from_filename(spark):
    df = spark.createDataFrame([("BAC USD 911 (2).csv",), ("plain.csv",)], "f string")
    assert [r[0] for r in df.select(account_from_filename(F.col("f"))).collect()] == ["BAC USD 911", "plain"]


def test_santander_header_by_row_or_keyword(spark):
    hdr = ["FECHA OPERACIÓN", "FECHA VALOR", "CONCEPTO", "IMPORTE EUR", "SALDO"]
    data = ["05/01/2024", "05/01/2024", "Compra", "-12.50", "100"]
    fixed = {"f.csv": [["Cuenta"]] * 7 + [hdr, data]}
    shifted = {"s.csv": [["Cuenta"]] * 5 + [hdr, data]}  # two preamble lines fewer
    r1, _ = LY.normalise(_grid(spark, fixed), _routed(spark, ["f.csv"]), LY.SANTANDER_SAVINGS)
    assert [(r.amount, r.tran_type) for r in r1.collect()] == [(-12.5, "Expense")]
    r2, j2 = LY.normalise(_grid(spark, shifted), _routed(spark, ["s.csv"]), LY.SANTANDER_SAVINGS)
    assert r2.count() == 0 and j2.count() == 1  # row 7 is data here: missing columns
    r3, _ = LY.normalise(_grid(spark, shifted), _routed(spark, ["s.csv"]), LY.SANTANDER_SAVINGS_BY_KEYWORD)
    assert [(r.amount, r.tran_type) for r in r3.collect()] == [(-12.5, "Expense")]


def test_strict_dates_reject_mode(spark):
    hdr = ["Account Name", "Fecha", "Referencia", "Descripción", "Débitos", "Créditos", "Balance"]
    g = _grid(spark, {"b.csv": [hdr,
                                ["X", "05/01/2024", "1", "ok", "1.00", None, "0"],
                                ["X", "31/02/2024", "2", "bad", "1.00", None, "0"],
                                ["X", "", "3", "blank date", "1.00", None, "0"]]})
    rows, rej = LY.normalise(g, _routed(spark, ["b.csv"]), LY.BAC_SAVINGS, on_error="reject")
    assert [r.description for r in rows.collect()] == ["ok"]
    assert [(r.file, r.reason) for r in rej.collect()] == [("b.csv", "bad_date_rows: 1")]
