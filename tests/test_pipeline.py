"""End to end: folder -> ledger, replay, stream = batch, contested fold."""

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.merge import merge_batch
from tallyspark.plans import fixtures as FX
from tallyspark.plans import consume as CN
from tallyspark.plans.pipeline import consume_log, run_batch
from tallyspark.sources.accounts import accounts_from_dict
from tallyspark.sources.ledger import empty_ledger
from tallyspark.streaming.ingest import latest_version, rejects_path, start_ingest
from tests.conftest import SF001
from tests.model import fold

ACCOUNTS = {"BAC USD 911": {"currency": "USD", "bank": "BAC", "type": "savings", "id_pattern": "BACUSD911"},
            "BAC ECONOMIA": {"currency": "USD/HNL", "bank": "BAC", "type": "credit_card", "id_pattern": "BACECONOMIA"}}
SAV_HDR = "Account Name,Fecha,Referencia,Descripción,Débitos,Créditos,Balance"


def _write(d, name, lines):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_folder_to_ledger_and_replay(spark, tmp_path):
    d = str(tmp_path / "in")
    os.makedirs(d)
    _write(d, "a.csv", [SAV_HDR, "BAC USD 911,05/01/2024,1,ATM W 001,20.00,,0", "BAC USD 911,06/01/2024,2,SALARY,,100.00,0"])
    _write(d, "b.csv", [SAV_HDR, "BAC USD 911,05/01/2024,1,ATM W 002,20.00,,0", "BAC USD 911,07/01/2024,3,RENT,50.00,,0"])
    _write(d, "c.csv", ["Account Name,Fecha,Concepto,Monto lempiras,Monto dólares",
                        "BAC ECONOMIA,05/01/2024,SHOP,L 10.00,"])
    _write(d, "unknown.csv", ["nobody,here", "1,2"])
    acc = accounts_from_dict(spark, ACCOUNTS)
    res = run_batch(spark, d, empty_ledger(spark), acc)
    led = sorted((r.description, r.amount, r.currency) for r in res.merge.ledger.collect())
    # b.csv re-describes a.csv's ATM row (same day, amount, account; similar text)
    assert led == [("ATM W 002", -20.0, "USD"), ("RENT", -50.0, "USD"), ("SALARY", 100.0, "USD"),
                   ("SHOP", -10.0, "HNL")]
    assert [(os.path.basename(r.file), r.reason) for r in res.rejects.collect()] == [("unknown.csv", "no account matched")]
    # replaying the same statements adds nothing
    again = run_batch(spark, d, res.merge.ledger, acc)
    assert again.merge.ledger.count() == 4
    assert sum(r.added for r in again.merge.metrics.collect()) == 0
    with pytest.raises(ValueError):
        run_batch(spark, d, empty_ledger(spark), acc, out_path="/tmp/no-such-folder/ledger")
    out = str(tmp_path / "ledger")
    run_batch(spark, d, empty_ledger(spark), acc, out_path=out, delete_inputs=True)
    assert spark.read.parquet(out).count() == 4
    assert sorted(os.listdir(d)) == ["unknown.csv"]


def test_stream_equals_batch(spark, tmp_path):
    d = str(tmp_path)
    drop = os.path.join(d, "drop")
    os.makedirs(drop)
    _write(drop, "s1.csv", [SAV_HDR, "BAC USD 911,05/01/2024,1,ATM W 001,20.00,,0", "BAC USD 911,06/01/2024,2,SALARY,,100.00,0"])
    _write(drop, "s2.csv", [SAV_HDR, "BAC USD 911,05/01/2024,1,ATM W 002,20.00,,0", "BAC USD 911,06/01/2024,2,SALARY,,100.00,0"])
    acc = accounts_from_dict(spark, ACCOUNTS)
    batch = run_batch(spark, drop, empty_ledger(spark), acc).merge.ledger
    # files that arrive together are folded in path order, as in the batch job
    q = start_ingest(spark, drop, f"{d}/ledger", acc, checkpoint=f"{d}/ckpt")
    q.awaitTermination()
    stream = latest_version(spark, f"{d}/ledger", q)
    key = lambda df: sorted((r.id, r.description) for r in df.collect())
    assert key(stream) == key(batch)


def test_stream_reads_files_as_the_batch_does(spark, tmp_path):
    """Cells past the 48th, cp1252 and rejects."""
    drop = tmp_path / "drop"
    drop.mkdir()
    pad = "," * 50
    wide = SAV_HDR.replace("Account Name,", "Account Name" + pad + ",")
    _write(drop, "wide.csv", [wide, f"BAC USD 911{pad},05/01/2024,1,WIDE ROW,20.00,,0"])
    (drop / "old [1].csv").write_bytes((SAV_HDR + "\nBAC USD 911,06/01/2024,2,CAFÉ,30.00,,0\nBAC USD 911,99/99/2024,2,BAD DATE,30.00,,0\n").encode("cp1252"))
    _write(drop, "unknown.csv", ["nobody,here", "1,2"])
    acc = accounts_from_dict(spark, ACCOUNTS)
    batch = run_batch(spark, str(drop), empty_ledger(spark), acc, on_error="reject")
    root = str(tmp_path / "ledger")
    q = start_ingest(spark, str(drop), root, acc, max_files_per_trigger=1)
    q.awaitTermination()
    rows = lambda df: sorted((r.id, r.description) for r in df.collect())
    assert [d for _, d in rows(batch.merge.ledger)] and {d for _, d in rows(batch.merge.ledger)} == {"WIDE ROW", "CAFÉ"}
    assert rows(latest_version(spark, root, q)) == rows(batch.merge.ledger)
    told = [r for v in (1, 2, 3) for r in spark.read.parquet(rejects_path(root, v)).collect()]
    names = lambda found: sorted((os.path.basename(r.file), r.reason) for r in found)
    assert names(told) == names(batch.rejects.collect()) and len(told) == 2


def test_contested_batch_equals_sequential_model(spark):
    led, st = FX.contested_inputs(spark, SF001)
    res = merge_batch(led, st)
    got = sorted(r.id for r in res.ledger.collect())
    lrows = [r.asDict() for r in led.collect()]
    srows = [r.asDict() for r in st.orderBy("stmt_seq", "row_no").collect()]
    stmts = [[r for r in srows if r["stmt_seq"] == j] for j in sorted({r["stmt_seq"] for r in srows})]
    exp, merged = fold(lrows, stmts)
    assert got == sorted(r["id"] for r in exp)
    assert res.metrics.agg(F.sum("merged")).first()[0] == merged


def test_deletion_survives_a_crash_after_every_step(spark, tmp_path, monkeypatch):
    """Killed after the intent, after the ledger, and amid the deletions: the
    next run finishes what was committed and drops what was not."""
    class Killed(Exception):
        pass

    def files():
        return sorted(p.name for p in (tmp_path / "in").glob("*.csv"))

    def start():
        (tmp_path / "in").mkdir(exist_ok=True)
        for n in ("a.csv", "b.csv"):
            (tmp_path / "in" / n).write_text(n)

    def die(*_):
        raise Killed

    mark, log = tmp_path / "ledger" / "_SUCCESS", str(tmp_path / "_consume")
    names = [f"file:{tmp_path}/in/a.csv", f"file:{tmp_path}/in/b.csv"]

    def commit():
        mark.parent.mkdir(exist_ok=True)
        mark.write_text("")

    start()
    with pytest.raises(Killed):  # the ledger was never written
        CN.consume(spark, log, names, str(mark), die)
    assert CN.recover(spark, log) == [] and files() == ["a.csv", "b.csv"] and not list((tmp_path / "_consume").glob("*.json"))
    with monkeypatch.context() as m, pytest.raises(Killed):  # the ledger is there, no input is gone
        m.setattr(CN, "finish", die)
        CN.consume(spark, log, names, str(mark), commit)
    assert files() == ["a.csv", "b.csv"]
    assert sorted(CN.recover(spark, log)) == names and files() == []
    mark.unlink()
    start()
    once = CN.delete_path
    done = []

    def one_only(s, p):
        if done:
            raise Killed
        done.append(p)
        return once(s, p)

    with monkeypatch.context() as m, pytest.raises(Killed):  # one of two inputs is gone
        m.setattr(CN, "delete_path", one_only)
        CN.consume(spark, log, names, str(mark), commit)
    assert files() == ["b.csv"]
    (tmp_path / "in" / "b.csv").write_text("a newer statement of the same name")
    assert CN.recover(spark, log) == [] and files() == ["b.csv"]  # not the file that was read
    (tmp_path / "in" / "a.csv").write_text("x")
    # any storage that Hadoop knows, here by another scheme
    assert CN.consume(spark, log, [f"file://{tmp_path}/in/a.csv"], str(mark), commit) and files() == ["b.csv"]


def test_versions_write_only_touched_months(spark, tmp_path):
    import datetime as dt

    from tallyspark.sources import versions as V

    root = str(tmp_path / "ledger")
    day = lambda m, d: dt.datetime(2024, m, d)
    first = [(day(m, d), "A", f"PAYMENT {m:02d}{d:02d}", float(d)) for m in (1, 2, 3) for d in range(1, 10)] + [(None, "A", "no date", 1.0)]
    schema = "date timestamp_ntz, account_name string, description string, amount double"
    from tallyspark.operators.merge import normalise_ledger
    V.write_version(spark, root, 0, normalise_ledger(spark.createDataFrame(first, schema)))
    stmt = [("f", 0, 0, day(2, 3), "A", "PAYMENT 0203!", 3.0), ("f", 0, 1, day(2, 20), "A", "NEW", -5.0), ("f", 0, 2, day(3, 4), "A", "PAYMENT 0304", 4.0)]
    stmts = spark.createDataFrame(stmt, "file string, stmt_seq long, row_no long, " + schema)
    version, res = V.merge_into(spark, root, 1, stmts)
    # March was read, and nothing in it changed
    assert [n for n in os.listdir(f"{root}/data/v=000000001") if n.startswith("ym=")] == ["ym=2024-02"]
    assert {m: e["v"] for m, e in version.months.items()} == {"2024-01": 0, "2024-02": 1, "2024-03": 0, "none": 0}
    whole = merge_batch(normalise_ledger(spark.createDataFrame(first, schema)), stmts).ledger
    key = lambda df: sorted((r.id, r.description) for r in df.collect())
    assert key(version.read(spark)) == key(whole)
    assert all("/v=000000001/ym=2024-02/" in f for f in version.read(spark, ["2024-02"]).inputFiles())
    # a replay leaves one version, with the files it has
    before = sorted(os.listdir(f"{root}/data/v=000000001/ym=2024-02"))
    again, none = V.merge_into(spark, root, 1, stmts)
    assert none is None and again == version and sorted(os.listdir(f"{root}/data/v=000000001/ym=2024-02")) == before
    # an unchanged ledger hashes no row, a tampered month is found
    rows, bad = V.verified_ledger(spark, version)
    assert bad == [] and "sha2" not in rows._jdf.queryExecution().toString()
    month = f"{root}/data/v=000000000/ym=2024-01"
    spoiled = spark.read.parquet(month).withColumn("id", F.when(F.col("amount") == 3.0, F.lit("forged")).otherwise(F.col("id"))).collect()
    for n in os.listdir(month):
        os.remove(f"{month}/{n}")
    from tallyspark.schema import LEDGER
    spark.createDataFrame(spoiled, LEDGER).coalesce(1).write.mode("append").parquet(month)
    rows, bad = V.verified_ledger(spark, version)
    assert bad == ["2024-01"] and key(rows) == key(whole)
    assert [p for p in V.vacuum(spark, root, keep=1)] == [f"{root}/data/v=000000000/ym=2024-02"]
    assert key(V.open_version(spark, root).read(spark)) != [] and V.versions(spark, root) == [1]
