"""Edges that a first user meets: names, encodings, storage, wide files."""

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.similarity import length_bound
from tallyspark.operators.identify import identify
from tallyspark.sources.accounts import accounts_from_dict, pattern_is_valid, read_accounts
from tallyspark.sources.grid import grid_scan
from tallyspark.sources.ledger import FileReadError, read_ledger


def test_unreachable_ledger_raises(spark, tmp_path):
    with pytest.raises(FileReadError):
        read_ledger(spark, "nosuchscheme://bucket/ledger", missing_ok=True)
    with pytest.raises(FileReadError):
        read_ledger(spark, str(tmp_path / "absent"))
    assert read_ledger(spark, str(tmp_path / "absent"), missing_ok=True).isEmpty()


def test_names_with_blanks_and_replacement_characters(spark, tmp_path):
    (tmp_path / "BAC USD 911 (2).csv").write_bytes("Fecha,Descripción\n1,café\n".encode("cp1252"))
    (tmp_path / "a [1].csv").write_bytes("Fecha,Descripción \ufffd\n".encode())
    rows = grid_scan(spark, str(tmp_path)).collect()
    by = {os.path.basename(r["file"]): [] for r in rows}
    for r in sorted(rows, key=lambda r: r["row_no"]):
        by[os.path.basename(r["file"])].append([c for c in r["cells"] if c is not None])
    assert by["BAC USD 911 (2).csv"] == [["Fecha", "Descripción"], ["1", "café"]]
    assert by["a [1].csv"] == [["Fecha", "Descripción \ufffd"]]


def test_wide_files_keep_all_cells(spark, tmp_path):
    (tmp_path / "w.csv").write_text(",".join(f"x{i}" for i in range(60)) + "\n1\n")
    # a row of 62 cells, a line break inside one of them
    (tmp_path / "q.csv").write_text(",".join(f'"y{i}\n"' if i == 3 else f"y{i}" for i in range(62)) + "\n")
    rows = {(os.path.basename(r["file"]), r["row_no"]): r["cells"] for r in grid_scan(spark, str(tmp_path)).collect()}
    assert rows["w.csv", 0] == [f"x{i}" for i in range(60)] and rows["w.csv", 1] == ["1"]
    assert rows["q.csv", 0] == [f"y{i}\n" if i == 3 else f"y{i}" for i in range(62)]


def _random_csv(rng, rows):
    """Cells with commas, quotes and line breaks, quotes inside plain cells,
    blank lines, and all three newlines."""
    out = []
    for _ in range(rows):
        cells = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            if kind < 0.3:
                inner = "".join(rng.choice(["a", ",", '""', "\n", "\r\n", "é", " "]) for _ in range(rng.randint(0, 12)))
                cells.append(f'"{inner}"' + rng.choice(["", "", "tail"]))
            else:
                cells.append(rng.choice(["", "x", 'five"inch', "word word", "ñ", "12"]))
        out.append(",".join(cells) + rng.choice(["\n", "\r\n", "\n\n"]))
    return "".join(out)


def test_quoted_newlines_across_splits(spark, tmp_path):
    """Files cut into splits of a few bytes against a plain CSV reader."""
    import csv
    import random

    rng = random.Random(4)
    want = {}
    for k in range(12):
        text = _random_csv(rng, 12)
        enc = "utf-8" if k % 2 else "cp1252"
        (tmp_path / f"{k:02d}.csv").write_bytes(text.encode(enc))
        rows = [r for r in csv.reader(text.splitlines(keepends=True)) if r and not (len(r) == 1 and not r[0].strip())]
        want[f"{k:02d}.csv"] = [[c or None for c in r] for r in rows]
    (tmp_path / "mac.csv").write_bytes(b'a,b\r1,"x\ry"\r')
    want["mac.csv"] = [["a", "b"], ["1", "x\ry"]]
    settings = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = grid_scan(spark, str(tmp_path)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {}
    for r in sorted(found, key=lambda r: (r["file"], r["row_no"])):
        rows = got.setdefault(os.path.basename(r["file"]), [])
        assert r["row_no"] == len(rows)
        rows.append(r["cells"])
    blank = lambda rows: [r for r in rows if any(c is not None and c.strip() for c in r) or len(r) > 1]
    assert set(got) == set(want)
    for name in want:
        assert blank(got[name]) == blank(want[name]), name


def test_files_without_rows_are_rejected_with_a_reason(spark, tmp_path):
    from tallyspark.sources import grid as G

    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_text("\n  \n\t\n")
    (tmp_path / "notes.txt").write_text("hello")
    (tmp_path / "book.xlsx").write_bytes(b"PK")
    (tmp_path / "UPPER.CSV").write_text("a\n")
    (tmp_path / "garbage.csv").write_bytes(b"a,\x81\x8d\n\xff\xfe\n")
    (tmp_path / "open.csv").write_text('a,"b\nc,d\n')
    (tmp_path / "marked.csv").write_bytes(b"\xef\xbb\xbfa\n")
    grid, rejects = G.scan_folder(spark, str(tmp_path))
    assert {os.path.basename(r["file"]) for r in grid.collect()} == {"good.csv", "marked.csv"}
    assert {os.path.basename(r["file"]): r["reason"] for r in rejects.collect()} == {
        "empty.csv": G.EMPTY, "blank.csv": G.EMPTY, "notes.txt": G.NOT_A_FORMAT, "book.xlsx": G.NOT_A_FORMAT,
        "UPPER.CSV": G.NOT_A_FORMAT, "garbage.csv": G.UNDECODABLE, "open.csv": G.OPEN_QUOTE,
    }


def test_fingerprint_reads_past_short_rows(spark, tmp_path):
    short = "".join(f"{i % 10}\n" for i in range(60))
    (tmp_path / "late.csv").write_text(short + "BAC USD 911,x\n")
    (tmp_path / "later.csv").write_text(short * 20 + "BAC USD 911,x\n")
    accounts = accounts_from_dict(spark, {"BAC USD 911": {"currency": "USD", "bank": "BAC", "type": "savings", "id_pattern": "BAC ?USD ?911"}})
    grid = grid_scan(spark, str(tmp_path))
    names = lambda routed: sorted(os.path.basename(r["file"]) for r in routed.collect())
    routed, rejects = identify(grid, accounts)
    assert names(routed) == ["late.csv"] and names(rejects) == ["later.csv"]
    assert names(identify(grid, accounts, num_chars=100)[0]) == []
    assert names(identify(grid, accounts, num_chars=5000)[0]) == ["late.csv", "later.csv"]
    assert names(identify(grid, accounts, normalize=False)[0]) == ["late.csv", "later.csv"]


def test_length_bound_at_the_threshold(spark):
    row = spark.range(1).select(length_bound(F.lit(55), F.lit(145), 0.55).alias("b"), length_bound(F.lit(0), F.lit(0), 0.8).alias("z")).first()
    assert row["b"] and row["z"]


def test_patterns_are_judged_by_their_engine(spark):
    assert pattern_is_valid("BAC.*911") and not pattern_is_valid("(?P<n>AB)") and not pattern_is_valid("(")


def test_broken_accounts_file_raises(spark, tmp_path):
    (tmp_path / "accounts.json").write_text("{not json")
    with pytest.raises(ValueError):
        read_accounts(spark, str(tmp_path / "accounts.json"))


def test_folders_without_files(spark, tmp_path):
    from tallyspark.sources.grid import scan_folder

    (tmp_path / "none").mkdir()
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.txt").write_text("a")
    grid, rejects = scan_folder(spark, str(tmp_path / "none"))
    assert grid.isEmpty() and rejects.isEmpty()
    grid, rejects = scan_folder(spark, str(tmp_path / "other"))
    assert grid.isEmpty() and rejects.count() == 1


def test_all_layouts_take_two_passes_over_the_grid(spark):
    """However many layouts occur: one pass for the headers, one for the rows."""
    from tallyspark.operators.common import stored
    from tallyspark.operators.layouts import LAYOUTS, normalise_all

    files = [(f"f{k}.csv", lay) for k, lay in enumerate(LAYOUTS)]
    rows = [(f, n, cells) for f, lay in files for n, cells in ((lay.header.row, list(dict.fromkeys([lay.header.keyword] if lay.header.keyword else []) | dict.fromkeys(lay.required()))), (20, ["1"] * 12))]
    grid = stored(spark.createDataFrame(rows, "file string, row_no long, cells array<string>"), "test-grid")
    routed = spark.createDataFrame([(f, "A", "USD", lay.bank, lay.account_type) for f, lay in files], "file string, account_name string, currency string, bank string, account_type string")
    out, _ = normalise_all(grid, routed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1, plan


def test_raw_match_row_by_row_equals_the_whole_text(spark):
    import re

    from tallyspark.operators.identify import within_a_line

    for pattern, within in (("BAC \\d+", True), ("a.c", True), ("x\\sy", False), ("^BAC", False), ("end$", False), ("[^,]x", False), ("(?s)a.b", False), ("a\\.b", True), ("a\nb", False)):
        assert within_a_line(pattern) == within, pattern
    files = {"a.csv": [["BAC 12", "x"], ["y", "end"]], "b.csv": [["x"], ["y"]], "c.csv": [["q", "BAC 7"], ["z"]], "d.csv": [["nothing"]]}
    patterns = {"digits": "BAC \\d+", "cross": "x\\sy", "start": "^BAC", "last": "z$"}
    grid = spark.createDataFrame([(f, k, c) for f, rows in files.items() for k, c in enumerate(rows)], "file string, row_no long, cells array<string>")
    accounts = spark.createDataFrame([(n, "USD", "BAC", "savings", p) for n, p in patterns.items()], "account_name string, currency string, bank string, account_type string, id_pattern string")
    routed, rejects = identify(grid, accounts, normalize=False)
    hits = {f: [n for n, p in patterns.items() if re.search(p, "\n".join(" ".join(c) for c in rows))] for f, rows in files.items()}
    assert {r["file"]: r["account_name"] for r in routed.collect()} == {f: h[0] for f, h in hits.items() if len(h) == 1}
    assert {r["file"] for r in rejects.collect()} == {f for f, h in hits.items() if len(h) != 1}
