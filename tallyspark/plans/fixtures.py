"""Statement and ledger inputs rendered by Spark from the driver tables.

The reference ships no sample statements, so the registry turns the
TPC-H-like tables into what banks export: text cells (``dd/MM/yyyy`` dates,
``1,234.50`` amounts, currency prefixes, padding), header rows, preambles.
Everything is derived with DataFrame operations from whole tables, so the
work grows with the data.  The oracles compute the expected values directly
from the source columns and never parse this text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.identity import row_id
from tallyspark.operators.common import stored
from tallyspark.schema import LEDGER_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def s(col) -> F.Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def grid_rows(file: F.Column, row_no: F.Column, cells: list) -> list:
    return [file.alias("file"), row_no.cast("long").alias("row_no"), F.array(*cells).alias("cells")]


def header_rows(files: DataFrame, header: list[str], row_no: int = 0) -> DataFrame:
    return files.select(
        "file", F.lit(row_no).cast("long").alias("row_no"),
        F.array(*[F.lit(h) for h in header]).alias("cells"),
    )


def preamble_rows(files: DataFrame, depth: F.Column, first_cell: str) -> DataFrame:
    """``depth`` preamble rows per file (row 0 .. depth-1), via explode."""
    return files.select("file", F.explode(F.sequence(F.lit(0), depth - 1)).alias("row_no")).where(
        F.col("row_no") >= 0
    ).select(
        "file", F.col("row_no").cast("long"),
        F.array(F.lit(first_cell), F.concat(F.lit("ref "), F.col("file"))).alias("cells"),
    )


def materialise(grid: DataFrame, kept: bool = True) -> DataFrame:
    """Rendered statement rows are kept in the shared folder, as the folder
    scan does, so the normaliser reads them instead of re-rendering them per
    use.  Not ``kept``: the caller keeps them with others, once."""
    return stored(grid, "grid", "zstd") if kept else grid


def grouped_amount(col) -> F.Column:
    """``1,234.50`` (cent values)."""
    return F.format_number(F.col(col) if isinstance(col, str) else col, 2)


def dmy(col) -> F.Column:
    return F.date_format(col, "dd/MM/yyyy")


# ---------------------------------------------------------------------------
# bank statement grids
# ---------------------------------------------------------------------------

BAC_CARD_HEADER = ["Account Name", "Fecha", "Concepto", "Monto lempiras", "Monto dólares"]
BAC_SAVINGS_HEADER = ["Account Name", "Fecha", "Referencia", "Descripción", "Débitos", "Créditos", "Balance"]
SANTANDER_HEADER = ["FECHA OPERACIÓN", "FECHA VALOR", "CONCEPTO", "IMPORTE EUR", "SALDO"]
FICOHSA_HEADER = ["Fecha", "Descripción", "N° Cheque", "Débito", "Crédito", "Balance"]
REVOLUT_HEADER = ["Type", "Product", "Started Date", "Completed Date", "Description", "Amount", "Fee",
                  "Currency", "State", "Balance"]


def bac_card_grid(spark, sf_dir, kept: bool = True) -> tuple[DataFrame, DataFrame]:
    """lineitem -> BAC card statements (20 files); ``l_linestatus`` picks
    the currency column; every 50th row has a blank first cell."""
    li = table(spark, sf_dir, "lineitem")
    file = F.concat(F.lit("bac_cc_"), s(F.col("l_orderkey") % 20))
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 50
    is_o = F.col("l_linestatus") == "O"
    data = li.select(*grid_rows(
        file, F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        [
            F.when(k == 0, F.lit("  ")).otherwise(F.lit("BAC ECONOMIA")),
            dmy("l_shipdate"),
            F.concat(F.lit("  PART "), s("l_partkey"), F.lit("\t SUPP  "), s("l_suppkey"), F.lit(" ")),
            F.when(is_o, F.concat(F.lit("L "), grouped_amount("l_extendedprice"))),
            F.when(~is_o, F.concat(F.lit("$"), grouped_amount("l_extendedprice"))).otherwise(F.lit("")),
        ],
    ))
    files = data.select("file").distinct()
    grid = header_rows(files, BAC_CARD_HEADER).unionByName(data)
    routed = files.select("file", F.lit("BAC ECONOMIA").alias("account_name"), F.lit("USD/HNL").alias("currency"))
    return materialise(grid, kept), routed


def bac_savings_grid(spark, sf_dir, account: str = "BAC USD 911", by: str = "c_nationkey",
                     prefix: str = "bac_sv_", kept: bool = True) -> tuple[DataFrame, DataFrame]:
    """customer -> BAC savings statements; the sign of ``c_acctbal`` picks
    the debit or the credit column."""
    c = table(spark, sf_dir, "customer")
    neg = F.col("c_acctbal") < 0
    data = c.select(*grid_rows(
        F.concat(F.lit(prefix), s(by)), F.col("c_custkey") + 1,
        [
            F.lit(account),
            dmy(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))),
            s("c_custkey"),
            F.concat(F.col("c_name"), F.lit("  "), F.col("c_mktsegment")),
            F.when(neg, grouped_amount(-F.col("c_acctbal"))).otherwise(F.lit("")),
            F.when(~neg, F.concat(F.lit("+"), grouped_amount("c_acctbal"))).otherwise(F.lit("")),
            grouped_amount(F.abs(F.col("c_acctbal"))),
        ],
    ))
    files = data.select("file").distinct()
    grid = header_rows(files, BAC_SAVINGS_HEADER).unionByName(data)
    routed = files.select("file", F.lit(account).alias("account_name"), F.lit("USD").alias("currency"))
    return materialise(grid, kept), routed


def santander_grid(spark, sf_dir, prefix: str, account: str, kept: bool = True) -> tuple[DataFrame, DataFrame]:
    """orders -> Santander statements: 7 preamble rows, header on row 7,
    signed amounts; every 23rd date is unreadable."""
    o = table(spark, sf_dir, "orders")
    amt = F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    date_txt = F.when(F.col("o_orderkey") % 23 == 0, F.lit("n/a")).otherwise(dmy("o_orderdate"))
    data = o.select(*grid_rows(
        F.concat(F.lit(prefix), s(F.col("o_custkey") % 10)), F.col("o_orderkey") + 8,
        [date_txt, date_txt, F.concat(F.col("o_orderpriority"), F.lit(" "), s("o_orderkey")),
         F.format_string("%.2f", amt), F.lit("")],
    ))
    files = data.select("file").distinct()
    grid = (
        preamble_rows(files, F.lit(7), "Cuenta")
        .unionByName(header_rows(files, SANTANDER_HEADER, 7))
        .unionByName(data)
    )
    routed = files.select("file", F.lit(account).alias("account_name"), F.lit("EUR").alias("currency"))
    return materialise(grid, kept), routed


def ficohsa_grid(spark, sf_dir, kept: bool = True) -> tuple[DataFrame, DataFrame]:
    """customer -> Ficohsa statements per nation: a preamble of
    ``nation % 5`` rows before the ``Fecha`` header; nations with
    ``nation % 7 = 6`` have no header row at all (rejected)."""
    c = table(spark, sf_dir, "customer")
    neg = F.col("c_acctbal") < 0
    data = c.select(
        *grid_rows(
            F.concat(F.lit("fic_"), s("c_nationkey")), F.col("c_custkey") + 10,
            [
                dmy(F.date_add(F.lit("2023-06-01").cast("date"), (F.col("c_custkey") % 200).cast("int"))),
                F.concat(F.lit(" "), F.col("c_name"), F.lit("  "), F.col("c_mktsegment")),
                F.lit(""),
                F.when(neg, F.concat(F.lit("L"), grouped_amount(-F.col("c_acctbal")))).otherwise(F.lit("")),
                F.when(~neg, F.concat(F.lit("L"), grouped_amount("c_acctbal"))).otherwise(F.lit("")),
                grouped_amount(F.abs(F.col("c_acctbal"))),
            ],
        ),
        F.col("c_nationkey"),
    )
    files = data.select("file", "c_nationkey").distinct()
    depth = (F.col("c_nationkey") % 5).cast("int")
    pre = preamble_rows(files.where(depth > 0), depth, "BANCO FICOHSA")
    hdr = files.where(F.col("c_nationkey") % 7 != 6).select(
        "file", depth.cast("long").alias("row_no"), F.array(*[F.lit(h) for h in FICOHSA_HEADER]).alias("cells"))
    grid = pre.unionByName(hdr).unionByName(data.drop("c_nationkey"))
    routed = files.select("file", F.lit("FICOHSA AHORRO").alias("account_name"), F.lit("HNL").alias("currency"))
    return materialise(grid, kept), routed


def revolut_grid(spark, sf_dir, kept: bool = True) -> tuple[DataFrame, DataFrame]:
    """events -> Revolut statements (8 files); ``error`` events are debits."""
    e = table(spark, sf_dir, "events")
    amt = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    data = e.select(*grid_rows(
        F.concat(F.lit("rev_"), s(F.col("user_id") % 8)), F.col("event_id") + 1,
        [F.col("event_type"), F.lit("Current"), ts, ts, F.concat(F.col("event_type"), F.lit("  "), F.col("props")),
         s(amt), F.lit("0.00"), F.lit("EUR"), F.lit("COMPLETED"), F.lit("")],
    ))
    files = data.select("file").distinct()
    grid = header_rows(files, REVOLUT_HEADER).unionByName(data)
    routed = files.select("file", F.lit("REVOLUT EUR").alias("account_name"), F.lit("EUR").alias("currency"))
    return materialise(grid, kept), routed


# ---------------------------------------------------------------------------
# ledger / statement fixtures for the merge (q20-q28)
# ---------------------------------------------------------------------------

def _orders_base(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date"),
        F.col("o_totalprice").alias("amount"),
        F.concat(F.lit("C"), s("o_custkey")).alias("account_name"),
        F.col("o_orderpriority").alias("priority"),
        F.concat(F.lit("ORDER "), F.col("o_orderpriority"), F.lit(" "), F.col("o_orderstatus"), F.lit(" "),
                 s("o_orderkey")).alias("base"),
    )


def ledger_from(df: DataFrame) -> DataFrame:
    """Canonical rows -> ledger rows (10 columns) with ids."""
    cols = {
        "tran_type": F.lit("Expense"), "category": F.col("priority"), "tag": F.lit(None).cast("string"),
        "notes": F.lit(None).cast("string"), "currency": F.lit("USD"), "id": F.lit(None).cast("string"),
    }
    out = df.select(*[(F.col(c) if c not in cols else cols[c]).alias(c) for c in LEDGER_COLUMNS])
    return out.withColumn("id", row_id())


def merge_ledger(spark, sf_dir) -> DataFrame:
    """Ledger: orders with ``key % 4 <> 3``."""
    b = _orders_base(spark, sf_dir)
    return ledger_from(b.where(F.col("k") % 4 != 3).withColumnRenamed("base", "description"))


def merge_statement_rows(spark, sf_dir) -> DataFrame:
    """Statement: orders with odd key; same text when ``key % 5 > 1``,
    `` SETTLED`` appended when ``% 5 = 0`` (similar), reversed when
    ``% 5 = 1`` (dissimilar)."""
    b = _orders_base(spark, sf_dir).where(F.col("k") % 2 == 1)
    m = F.col("k") % 5
    desc = F.when(m == 0, F.concat(F.col("base"), F.lit(" SETTLED"))).when(m == 1, F.reverse("base")).otherwise(F.col("base"))
    return b.select(
        F.lit("stmt_orders").alias("file"), F.lit(0).cast("long").alias("stmt_seq"), F.col("k").alias("row_no"),
        "date", "account_name", F.lit("Expense").alias("tran_type"), desc.alias("description"),
        F.lit("USD").alias("currency"), "amount",
    ).withColumn("id", row_id())


def first_wins_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Ledger ``key % 4 = 0``; three statements, statement ``j`` holds the
    orders with ``key % 3 <> j`` (every order is in two statements) and
    marks its rows with ``tran_type = 'S<j>'``."""
    b = _orders_base(spark, sf_dir)
    led = ledger_from(b.where(F.col("k") % 4 == 0).withColumnRenamed("base", "description"))
    st = b.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j")).where(F.col("k") % 3 != F.col("j"))
    st = st.select(
        F.concat(F.lit("stmt_"), s("j")).alias("file"), F.col("j").cast("long").alias("stmt_seq"),
        F.col("k").alias("row_no"), "date", "account_name", F.concat(F.lit("S"), s("j")).alias("tran_type"),
        F.col("base").alias("description"), F.lit("USD").alias("currency"), "amount",
    ).withColumn("id", row_id())
    return led, st


def contested_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Coarse blocks (month, price / 1e5, customer % 50) so that blocks hold
    several orders; two statements with near-copies of each other's texts."""
    o = table(spark, sf_dir, "orders")
    b = o.select(
        F.col("o_orderkey").alias("k"),
        F.date_trunc("MONTH", F.col("o_orderdate").cast("timestamp")).cast("timestamp_ntz").alias("date"),
        F.floor(F.col("o_totalprice") / 1e5).cast("double").alias("amount"),
        F.concat(F.lit("C"), s(F.col("o_custkey") % 50)).alias("account_name"),
        F.col("o_orderpriority").alias("priority"),
        F.concat(F.lit("PAY REF "), s(F.col("o_orderkey") % 1000)).alias("base"),
    )
    led = ledger_from(b.where(F.col("k") % 3 == 0).withColumnRenamed("base", "description"))
    st = b.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("j")).where((F.col("k") + F.col("j")) % 3 != 0)
    desc = F.when(F.col("j") == 1, F.concat(F.col("base"), F.lit(" X"))).otherwise(F.col("base"))
    st = st.select(
        F.concat(F.lit("stmt_"), s("j")).alias("file"), F.col("j").cast("long").alias("stmt_seq"),
        F.col("k").alias("row_no"), "date", "account_name", F.lit("Expense").alias("tran_type"),
        desc.alias("description"), F.lit("USD").alias("currency"), "amount",
    ).withColumn("id", row_id())
    return led, st
