"""Scans and sinks: statement grid, ledger CSV, accounts, HTML tables."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyspark.sources.accounts import read_accounts
from tallyspark.sources.grid import grid_scan
from tallyspark.sources.html import NO_ACCOUNT, NO_TABLE, extract_tables, page_rows, table_rejects
from tallyspark.sources.ledger import FileReadError, read_ledger_csv, write_ledger_csv, write_ledger_export
from tallyspark.schema import LEDGER


def test_grid_scan_encodings_and_rows(spark, tmp_path):
    d = str(tmp_path)
    with open(os.path.join(d, "utf8.csv"), "w", encoding="utf-8") as f:
        f.write("Fecha,Descripción\n05/01/2024,\"café, con\nleche\"\n\n06/01/2024,NA\n")
    with open(os.path.join(d, "bom.csv"), "w", encoding="utf-8-sig") as f:
        f.write("Account Name,Fecha\nX,05/01/2024\n")
    with open(os.path.join(d, "cp.csv"), "wb") as f:
        f.write("Fecha,Descripción\n05/01/2024,Café €\n".encode("cp1252"))
    with open(os.path.join(d, "skip.txt"), "w") as f:
        f.write("not a statement\n")
    g = grid_scan(spark, d)
    rows = {(os.path.basename(r.file), r.row_no): [c for c in r.cells if c is not None] for r in g.collect()}
    assert rows[("utf8.csv", 0)] == ["Fecha", "Descripción"]
    assert rows[("utf8.csv", 1)] == ["05/01/2024", "café, con\nleche"]
    assert rows[("utf8.csv", 2)] == ["06/01/2024"]  # blank line skipped, NA -> NULL
    assert rows[("bom.csv", 0)] == ["Account Name", "Fecha"]
    assert rows[("cp.csv", 1)] == ["05/01/2024", "Café €"]
    assert not any(f == "skip.txt" for f, _ in rows)


def test_ledger_csv_round_trip(spark, tmp_path):
    d = str(tmp_path)
    rows = [(dt.datetime(2024, 1, 5), "A", "Expense", None, "t", 'say "hi", ok\nnext', " n ", "USD", -0.0, "x"),
            (dt.datetime(2024, 1, 6, 12, 30), "A", "Income", "c", None, "plain", None, "USD", 1e7, "y")]
    df = spark.createDataFrame(rows, LEDGER)
    write_ledger_csv(df, f"{d}/out")
    part = [p for p in os.listdir(f"{d}/out") if p.endswith(".csv")]
    raw = open(os.path.join(d, "out", part[0]), "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfdate,account_name")
    back = read_ledger_csv(spark, f"{d}/out", missing_ok=False).orderBy("date").collect()
    assert back[0].description == 'say "hi", ok\nnext' and str(back[0].amount) == "-0.0"
    assert back[0].notes == " n " and back[0].category is None
    assert back[1].date == dt.datetime(2024, 1, 6, 12, 30) and back[1].amount == 1e7


def test_missing_ledger_is_empty(spark):
    absent = "/tmp/does-not-exist-ledger.csv"
    assert read_ledger_csv(spark, absent, missing_ok=True).count() == 0
    with pytest.raises(FileReadError):
        read_ledger_csv(spark, absent)


def test_read_accounts(spark, tmp_path):
    d = str(tmp_path)
    cfg = {"BAC USD 911": {"currency": "USD", "bank": "BAC", "type": "savings", "id_pattern": "BACUSD911"},
           "X": {"currency": "EUR", "bank": "REVOLUT", "type": "savings", "id_pattern": "REV"}}
    with open(os.path.join(d, "accounts.json"), "w") as f:
        json.dump(cfg, f, indent=2)
    acc = {r.account_name: (r.bank, r.account_type, r.id_pattern) for r in read_accounts(spark, f"{d}/accounts.json").collect()}
    assert acc == {"BAC USD 911": ("BAC", "savings", "BACUSD911"), "X": ("REVOLUT", "savings", "REV")}


def test_html_visible_table(spark):
    html = ('<div id="debitAccountNameDiv"><span>\n\tMY ACCOUNT\t</span></div>'
            '<table id="creditCardRecentMovementsTable" style="display:none"><tr><td>hidden</td></tr></table>'
            '<table id="transactionTable"><tr><th>Fecha</th><th>Monto</th></tr>'
            '<tr><td>\n\t05/01/2024\n</td><td>1,00 &amp; <b>x</b></td></tr></table>')
    pages = spark.createDataFrame([(1, "u", html), (2, "u", "<p>no table</p>")], "page_id long, url string, html string")
    got = [(r.page_id, r.row_no, r.cells) for r in extract_tables(pages).orderBy("row_no").collect()]
    assert got == [(1, 0, ["Account Name", "Fecha", "Monto"]), (1, 1, ["MY ACCOUNT", "05/01/2024", "1,00 & x"])]


def test_row_numbers_across_splits(spark, tmp_path):
    """One file read as many splits: row numbers stay the file's line order
    (per-split numbering shifted by earlier splits' counts, no file window)."""
    d = str(tmp_path)
    with open(os.path.join(d, "big.csv"), "w") as f:
        for i in range(3000):
            f.write(f"{i},row {i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        g = grid_scan(spark, d)
        rows = g.select("row_no", F.element_at("cells", 1).cast("long").alias("v")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 3000
    assert all(r.row_no == r.v for r in rows)


def test_ordered_export_is_one_file_in_parts(spark, tmp_path):
    d0 = dt.datetime(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=i % 5) if i % 11 else None, "A", "Expense", None, None, f"row {i:03d}" + (",\n" if i % 7 == 0 else ""), None, "USD", float(i), f"id{i}") for i in range(200)]
    df = spark.createDataFrame(rows, LEDGER).repartition(7)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # small parts are not put together
    try:
        write_ledger_export(df, str(tmp_path / "out"))
    finally:
        spark.conf.set(coalesce, "true")
    parts = sorted(p for p in os.listdir(tmp_path / "out") if p.startswith("part-"))
    whole = b"".join((tmp_path / "out" / p).read_bytes() for p in parts).decode()
    assert len(parts) > 1 and whole.count("\ufeff") == 1 and whole.startswith("\ufeffdate,account_name,")
    import csv
    got = list(csv.reader(whole.lstrip("\ufeff").splitlines(keepends=True)))[1:]
    days = [r[0] for r in got]
    assert len(got) == 200 and days == sorted(days, reverse=True)
    assert sorted(r[9] for r in got) == sorted(r[9] for r in rows)
    again = tmp_path / "again"
    write_ledger_export(df.repartition(3), str(again))
    assert whole == b"".join((again / p).read_bytes() for p in sorted(os.listdir(again)) if p.startswith("part-")).decode()


def test_html_tables_of_all_shapes(spark):
    name = '<h2 class="x bel-typography-h2 bel-typography">A &amp; B</h2>'
    nested = name + ('<div style="color:red; DISPLAY : none"><table id="creditCardStateTRX"><tr><td>hidden by what is around it</td></tr></table></div>'
                     '<table id=transactionTable><tfoot><tr><td>last<td>&eacute;&#233;&#xE9;&nbsp;&copy;</tfoot>'
                     '<thead><tr><th>first<th>&lt;b&gt;</thead>'
                     '<tr><td>1</td><td>a<table id="transactionTable1"><tr><td>in</td><td>ner</td></tr></table>b</td></tr><tr></tr></table>')
    pages = spark.createDataFrame([
        (1, nested), (2, '<div id="debitAccountNameDiv"><b>no span</b></div>' + name + '<table id="transactionTable"><tr><td>x</td></tr></table>'),
        (3, name + "<p>no table</p>"), (4, None), (5, ""), (6, name + '<table id="transactionTable" style="display:none"><tr><td>x</td></tr></table>'),
        (7, '<table id="transactionTable1"><tr><td>x</td></tr></table>')], "page_id long, html string")
    rows = {(r.page_id, r.row_no): r.cells for r in extract_tables(pages).collect()}
    assert rows == {
        (1, 0): ["Account Name", "first", "<b>"], (1, 1): ["A &amp; B", "1", "ainnerb"], (1, 2): ["A &amp; B"], (1, 3): ["A &amp; B", "last", "\u00e9\u00e9\u00e9\u00a0\u00a9"]}
    assert {r.page_id: r.reason for r in table_rejects(pages).collect()} == {2: NO_ACCOUNT, 3: NO_TABLE, 4: NO_TABLE, 5: NO_TABLE, 6: NO_TABLE, 7: NO_ACCOUNT}


def test_hostile_account_pages_take_time_in_proportion():
    import time

    for part in ("<tr>", "<b>", "<table id=transactionTable><tr><td>", "</td>", "<a b='", "<!", "&amp", "<td><tr>"):
        began = time.process_time()
        page_rows("<table>" + part * 20_000)
        assert time.process_time() - began < 10, part
