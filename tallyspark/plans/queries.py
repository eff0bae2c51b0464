"""Query registry: one entry per operator of the inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the driver tables.  ``ORACLES`` holds, for the same name, an independent
DuckDB SQL statement over the same tables that computes the expected
result directly from the source columns.  Column names match.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions import clean as C
from tallyspark.functions.identity import row_id
from tallyspark.functions.similarity import DEFAULT_THRESHOLD, similarity_ratio, similar_at_least
from tallyspark.operators import layouts as LY
from tallyspark.operators.common import checkpointed, sized_broadcast, stored
from tallyspark.operators.identify import account_from_filename, match_accounts, split_unique, unknown_accounts
from tallyspark.operators.merge import (
    _ledger_texts, _new_texts, apply_updates, candidate_pairs, fuzzy_updates, merge_batch,
    merge_statement, new_rows, normalise_ledger, prepare_statements, touched_ledger,
)
from tallyspark.plans import fixtures as FX
from tallyspark.schema import LEDGER_COLUMNS, enforce_schema
from tallyspark.session import ensure_session_defaults, scratch_path
from tallyspark.sources.accounts import read_accounts, screen_patterns
from tallyspark.sources.csv_text import csv_line, csv_line_from_array
from tallyspark.sources.html import extract_tables
from tallyspark.sources.ledger import clean_ledger_text, read_ledger_csv, write_ledger_csv, write_ledger_export
from tallyspark.sources.versions import merge_into, verified_ledger, write_version

T = FX.table
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session_defaults(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run

    return deco


# ---------------------------------------------------------------------------
# SQL fragments for the oracles (DuckDB)
# ---------------------------------------------------------------------------

def _dt(x: str) -> str:
    """Python text of a timestamp."""
    return (f"(case when {x} is null then 'NaT' when strftime({x}, '%f') = '000000' "
            f"then strftime({x}, '%Y-%m-%d %H:%M:%S') else strftime({x}, '%Y-%m-%d %H:%M:%S.%f') end)")


def _id(date: str, desc: str, amt: str, acct: str) -> str:
    return (f"sha256({_dt(date)} || coalesce({desc}, 'nan') || coalesce(cast({amt} as varchar), 'nan') "
            f"|| coalesce({acct}, 'nan'))")


def _r2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


WS_RE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def _ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS_RE}', ' ', 'g'))"


# ---------------------------------------------------------------------------
# D: cleaning functions
# ---------------------------------------------------------------------------

@register("q01_drop_blank_rows", """
select c_custkey, c_name as name from customer where c_custkey % 7 not in (0, 1, 2, 3)
""")
def q01(spark, sf):
    """Rows whose check column is NULL, empty or whitespace are dropped."""
    c = T(spark, sf, "customer")
    k = F.col("c_custkey") % 7
    cell = (F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lit(""))
            .when(k == 2, F.lit("   ")).when(k == 3, F.lit(" \t ")).otherwise(F.col("c_name")))
    return c.select("c_custkey", cell.alias("name")).where(~C.is_blank("name"))


@register("q02_strip_chars_numeric", f"""
select l_orderkey, l_linenumber,
  case (l_orderkey + l_linenumber) % 5 when 0 then null
       when 1 then {_r2('-l_extendedprice')} else {_r2('l_extendedprice')} end as amount
from lineitem
""")
def q02(spark, sf):
    """Currency text -> number, blanks -> NULL, half-even."""
    li = T(spark, sf, "lineitem")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 5
    p = FX.grouped_amount("l_extendedprice")
    txt = (F.when(k == 0, F.lit("  ")).when(k == 1, F.concat(F.lit("$-"), p))
           .when(k == 2, F.concat(F.lit("L "), p, F.lit(" HNL"))).otherwise(F.concat(F.lit(" "), p)))
    amt = C.round_half_even_2(C.to_number(C.blank_to_null(C.keep_numeric_chars(txt))))
    return li.select("l_orderkey", "l_linenumber", amt.alias("amount"))


@register("q03_collapse_whitespace", f"""
select doc_id, {_ws('text')} as text from documents
""")
def q03(spark, sf):
    """D4 over whole documents: whitespace runs -> one blank, stripped."""
    d = T(spark, sf, "documents")
    return d.select("doc_id", C.collapse_ws("text").alias("text"))


@register("q04_lenient_dates", """
select o_orderkey, o_orderdate as date from orders where o_orderkey % 11 not in (0, 2, 3)
""")
def q04(spark, sf):
    """Day-first dates, malformed -> NULL -> row dropped."""
    o = T(spark, sf, "orders")
    k = F.col("o_orderkey") % 11
    d = F.col("o_orderdate")
    txt = (F.when(k == 0, F.concat(F.lit("31/02/"), F.date_format(d, "yyyy")))
           .when(k == 1, F.date_format(d, "d/M/yyyy"))
           .when(k == 2, F.concat(FX.dmy(d), F.lit(" x")))
           .when(k == 3, F.lit("bad")).otherwise(FX.dmy(d)))
    out = o.select("o_orderkey", C.parse_date(txt).alias("date"))
    return out.where(F.col("date").isNotNull())


@register("q05_strict_dates", """
select o_orderkey, o_orderdate as date from orders where o_orderkey % 13 <> 0
""")
def q05(spark, sf):
    """Strict day-first parse (malformed text raises; empty is missing)."""
    o = T(spark, sf, "orders")
    txt = F.when(F.col("o_orderkey") % 13 == 0, F.lit("")).otherwise(FX.dmy("o_orderdate"))
    out = o.select("o_orderkey", C.parse_date(txt, strict=True).alias("date"))
    return out.where(F.col("date").isNotNull())


@register("q06_timestamp_to_day", """
select event_id, cast(date_trunc('day', ts) as timestamp) as day from events
""")
def q06(spark, sf):
    """``yyyy-MM-dd HH:mm:ss`` text -> midnight of that day."""
    e = T(spark, sf, "events")
    txt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.select("event_id", C.parse_timestamp_day(txt).alias("day"))


# ---------------------------------------------------------------------------
# F: identity, G1: schema
# ---------------------------------------------------------------------------

_Q07_DESC = ("case when o_orderkey % 19 = 0 then null else 'ORDER ' || o_orderpriority || ' ' || o_orderstatus "
             "|| ' ' || o_orderkey end")
_Q07_AMT = "case when o_orderkey % 17 = 0 then null when o_orderstatus = 'F' then -o_totalprice else o_totalprice end"


@register("q07_row_id", f"""
select o_orderkey, {_id('o_orderdate', 'd', 'a', 'c_name')} as id
from (select o.o_orderkey, o.o_orderdate, c.c_name, {_Q07_DESC} as d, {_Q07_AMT} as a
      from orders o join customer c on o.o_custkey = c.c_custkey)
""")
def q07(spark, sf):
    """SHA-256 of date, description, amount, account (Python texts)."""
    o = T(spark, sf, "orders")
    c = T(spark, sf, "customer")
    k = F.col("o_orderkey")
    desc = F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("ORDER "), "o_orderpriority", F.lit(" "), "o_orderstatus", F.lit(" "), FX.s(k)))
    amt = (F.when(k % 17 == 0, F.lit(None).cast("double"))
           .when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select("o_orderkey", row_id(F.col("o_orderdate").cast("timestamp_ntz"), desc, amt, F.col("c_name")).alias("id"))


@register("q07b_row_id_fraction", f"""
select event_id, {_id('ts', 'event_type', "case when event_type = 'error' then -value else value end",
                      "'user_' || user_id")} as id
from events
""")
def q07b(spark, sf):
    """F1 with sub-second timestamps (``.ffffff`` in the date text)."""
    e = T(spark, sf, "events")
    amt = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
    acct = F.concat(F.lit("user_"), FX.s("user_id"))
    return e.select("event_id", row_id(F.col("ts").cast("timestamp_ntz"), F.col("event_type"), amt, acct).alias("id"))


@register("q08_schema_enforce", f"""
select o_orderdate as date, 'C' || o_custkey as account_name,
  case when o_orderstatus = 'F' then 'Expense' else 'Income' end as tran_type,
  o_orderpriority as category,
  case when o_orderkey % 3 = 0 then null else 'T' || (o_orderkey % 10) end as tag,
  'ORDER ' || o_orderkey as description, cast(null as varchar) as notes, 'USD' as currency,
  case when o_orderkey % 29 = 0 then null else o_totalprice end as amount,
  {_id('o_orderdate', "'ORDER ' || o_orderkey", 'case when o_orderkey % 29 = 0 then null else o_totalprice end',
       "'C' || o_custkey")} as id
from orders
""")
def q08(spark, sf):
    """G1 + G2: a text ledger -> typed ledger (missing tokens -> NULL) + id."""
    o = T(spark, sf, "orders")
    k = F.col("o_orderkey")
    txt = o.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("C"), FX.s("o_custkey")).alias("account_name"),
        F.when(F.col("o_orderstatus") == "F", "Expense").otherwise("Income").alias("tran_type"),
        F.col("o_orderpriority").alias("category"),
        F.when(k % 3 == 0, F.lit("NA")).otherwise(F.concat(F.lit("T"), FX.s(k % 10))).alias("tag"),
        F.concat(F.lit("ORDER "), FX.s(k)).alias("description"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("  ")).alias("notes"),
        F.lit("USD").alias("currency"),
        F.when(k % 29 == 0, F.lit("")).otherwise(FX.s("o_totalprice")).alias("amount"),
        F.lit("stale").alias("id"),
    )
    led = enforce_schema(clean_ledger_text(txt))
    return led.withColumn("id", row_id())


# ---------------------------------------------------------------------------
# N: layouts
# ---------------------------------------------------------------------------

_CANON = "file, row_no, date, account_name, tran_type, description, currency, amount, id"


@register("q10_card_dual_currency", f"""
with r as (
  select 'bac_cc_' || (l_orderkey % 20) as file, l_orderkey * 8 + l_linenumber as row_no,
         l_shipdate as date, 'BAC ECONOMIA' as account_name, 'Expense' as tran_type,
         'PART ' || l_partkey || ' SUPP ' || l_suppkey as description,
         case when l_linestatus = 'O' then 'HNL' else 'USD' end as currency,
         -{_r2('l_extendedprice')} as amount
  from lineitem where (l_orderkey + l_linenumber) % 50 <> 0)
select {_CANON.replace(', id', '')}, {_id('date', 'description', 'amount', 'account_name')} as id from r
""")
def q10(spark, sf):
    """BAC card, two currency columns, strict dates, negated amounts."""
    grid, routed = FX.bac_card_grid(spark, sf)
    rows, _ = LY.normalise(grid, routed, LY.BAC_CARD)
    return rows


_BAL = f"case when c_acctbal < 0 then -{_r2('-c_acctbal')} else {_r2('c_acctbal')} end"


@register("q11_bac_savings", f"""
with r as (
  select 'bac_sv_' || c_nationkey as file, c_custkey + 1 as row_no,
         cast(date '2024-01-01' + cast(c_custkey % 365 as integer) as timestamp) as date,
         'BAC USD 911' as account_name, c_name || ' ' || c_mktsegment as description,
         'USD' as currency, {_BAL} as amount
  from customer)
select file, row_no, date, account_name,
       case when amount < 0 then 'Expense' else 'Income' end as tran_type,
       description, currency, amount, {_id('date', 'description', 'amount', 'account_name')} as id
from r
""")
def q11(spark, sf):
    """BAC savings, debit/credit columns."""
    grid, routed = FX.bac_savings_grid(spark, sf)
    rows, _ = LY.normalise(grid, routed, LY.BAC_SAVINGS)
    return rows


def _santander_sql(prefix: str, account: str, positive: str) -> str:
    amt = "case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end"
    return f"""
with r as (
  select '{prefix}' || (o_custkey % 10) as file, o_orderkey + 8 as row_no, o_orderdate as date,
         '{account}' as account_name, o_orderpriority || ' ' || o_orderkey as description,
         'EUR' as currency, {_r2(amt)} as amount
  from orders where o_orderkey % 23 <> 0)
select file, row_no, date, account_name,
       case when amount < 0 then 'Expense' else '{positive}' end as tran_type,
       description, currency, amount, {_id('date', 'description', 'amount', 'account_name')} as id
from r
"""


@register("q12_santander_savings", _santander_sql("san_sv_", "SANTANDER AHORRO", "Income"))
def q12(spark, sf):
    """Header on physical row 7, lenient dates, signed amounts."""
    grid, routed = FX.santander_grid(spark, sf, "san_sv_", "SANTANDER AHORRO")
    rows, _ = LY.normalise(grid, routed, LY.SANTANDER_SAVINGS)
    return rows


def _santander_card(spark, sf, kept=True):
    grid, routed = FX.santander_grid(spark, sf, "san_cc_", "SANTANDER TARJETA", kept)
    grid = grid.withColumn("cells", F.slice("cells", 1, 4)).withColumn(
        "cells", F.when(F.col("row_no") == 7, F.array(*[F.lit(h) for h in ("FECHA OPERACIÓN", "FECHA VALOR", "CONCEPTO", "IMPORTE EUR")])).otherwise(F.col("cells")))
    return grid, routed


@register("q13_santander_card", _santander_sql("san_cc_", "SANTANDER TARJETA", "Transfer"))
def q13(spark, sf):
    """As N4, but card credits are transfers."""
    grid, routed = _santander_card(spark, sf)
    rows, _ = LY.normalise(grid, routed, LY.SANTANDER_CARD)
    return rows


@register("q14_ficohsa_savings", f"""
with r as (
  select 'fic_' || c_nationkey as file, c_custkey + 10 as row_no,
         cast(date '2023-06-01' + cast(c_custkey % 200 as integer) as timestamp) as date,
         'FICOHSA AHORRO' as account_name, c_name || ' ' || c_mktsegment as description,
         'HNL' as currency, {_BAL} as amount
  from customer where c_nationkey % 7 <> 6)
select file, row_no, date, account_name,
       case when amount < 0 then 'Expense' else 'Income' end as tran_type,
       description, currency, amount, {_id('date', 'description', 'amount', 'account_name')} as id
from r
""")
def q14(spark, sf):
    """N5 + C2: header found by keyword after a preamble of varying depth;
    files without the header are rejected."""
    grid, routed = FX.ficohsa_grid(spark, sf)
    rows, _ = LY.normalise(grid, routed, LY.FICOHSA_SAVINGS)
    return rows


@register("q15_revolut_savings", f"""
with r as (
  select 'rev_' || (user_id % 8) as file, event_id + 1 as row_no,
         cast(date_trunc('day', ts) as timestamp) as date, 'REVOLUT EUR' as account_name,
         {_ws("event_type || '  ' || props")} as description, 'EUR' as currency,
         {_r2("case when event_type = 'error' then -value else value end")} as amount
  from events)
select file, row_no, date, account_name,
       case when amount < 0 then 'Expense' else 'Income' end as tran_type,
       description, currency, amount, {_id('date', 'description', 'amount', 'account_name')} as id
from r
""")
def q15(spark, sf):
    """Revolut savings, timestamp cut to the day, no character strip."""
    grid, routed = FX.revolut_grid(spark, sf)
    rows, _ = LY.normalise(grid, routed, LY.REVOLUT_SAVINGS)
    return rows


# ---------------------------------------------------------------------------
# C: header handling; B: identification and routing
# ---------------------------------------------------------------------------

@register("q16_promote_header", """
select 'nat_' || n_regionkey as file, cast(n_regionkey as bigint) as hdr_row,
       n_name as name, cast(n_nationkey as bigint) as key
from nation
""")
def q16(spark, sf):
    """Header row by keyword below a preamble, columns by header text."""
    n = T(spark, sf, "nation")
    data = n.select(*FX.grid_rows(F.concat(F.lit("nat_"), FX.s("n_regionkey")), F.col("n_nationkey") + 10,
                                  [FX.s("n_nationkey"), F.col("n_name"), FX.s("n_regionkey")]), "n_regionkey")
    files = data.select("file", "n_regionkey").distinct()
    depth = F.col("n_regionkey").cast("int")
    pre = FX.preamble_rows(files.where(depth > 0), depth, "INFO")
    hdr = files.select("file", depth.cast("long").alias("row_no"),
                       F.array(F.lit("Key"), F.lit("Nation"), F.lit("Region")).alias("cells"))
    grid = pre.unionByName(hdr).unionByName(data.drop("n_regionkey"))
    lay = LY.StatementLayout(name="nation", bank="-", account_type="-",
                             header=LY.HeaderRule("keyword", keyword="Key"),
                             columns={"name": "Nation", "key": "Key"})
    pos = LY.header_positions(LY.find_headers(grid, lay.header), [lay])
    rows = grid.join(pos, on="file").where(F.col("row_no") > F.col("hdr_row"))
    return rows.select("file", "hdr_row", LY.cell_at("name").alias("name"), LY.cell_at("key").cast("long").alias("key"))


#: patterns for raw texts: (account, pattern, bank, type, currency)
RAW_PATTERNS = [
    ("RAW OF", "the [a-z]+ of", "BAC", "savings", "USD"),
    ("RAW DIE", "[Dd]ie e[a-z]+ ", "FICOHSA", "savings", "HNL"),
    ("RAW LOS", "de los ", "SANTANDER", "savings", "EUR"),
    ("RAW MAIL", "mail[0-9]", "REVOLUT", "savings", "EUR"),
]

ACCOUNT_PATTERNS = [
    ("ACC THE", "THE", "BAC", "savings", "USD"),
    ("ACC AUX", "AUX", "FICOHSA", "savings", "HNL"),
    ("ACC UND", "UND", "SANTANDER", "savings", "EUR"),
    ("ACC DER", "DER[A-Z]", "REVOLUT", "savings", "EUR"),
    ("ACC NUM", "[0-9]{2}", "BAC", "credit_card", "HNL"),
    ("ACC PIPE", "[|]", "SANTANDER", "credit_card", "EUR"),
]


def _accounts_values_sql() -> str:
    return ", ".join(f"('{a}', '{p}')" for a, p, *_ in ACCOUNT_PATTERNS)


@register("q17_identify_account", f"""
with fp as (select doc_id, upper(replace(substr(text, 1, 400), ' ', '')) as fp from documents),
acc(account_name, id_pattern) as (values {_accounts_values_sql()}),
m as (select doc_id, account_name from fp join acc on regexp_matches(fp, id_pattern))
select doc_id as file, min(account_name) as account_name from m group by doc_id having count(*) = 1
""")
def q17(spark, sf):
    """Fingerprint x patterns (broadcast), exactly one match kept."""
    d = T(spark, sf, "documents")
    acc = spark.createDataFrame(
        [(a, cur, b, t, p) for a, p, b, t, cur in ACCOUNT_PATTERNS],
        "account_name string, currency string, bank string, account_type string, id_pattern string")
    texts = d.select(F.col("doc_id").alias("file"), "text")
    matches = match_accounts(texts, acc)
    unique, _ = split_unique(matches, texts)
    return unique.select("file", "account_name")


_SEG_BANK = [("AUTOMOBILE", "BAC"), ("BUILDING", "SANTANDER"), ("FURNITURE", "REVOLUT"),
             ("MACHINERY", "FICOHSA"), ("HOUSEHOLD", "HSBC")]


@register("q18_route_and_reject", """
with f as (
  select c_custkey,
         case c_mktsegment when 'AUTOMOBILE' then 'BAC' when 'BUILDING' then 'SANTANDER'
              when 'FURNITURE' then 'REVOLUT' when 'MACHINERY' then 'FICOHSA' else 'HSBC' end as bank,
         case when c_custkey % 2 = 0 then 'savings' else 'credit_card' end as account_type
  from customer)
select c_custkey, bank, account_type,
  case when bank = 'BAC' and account_type = 'credit_card' then 'bac_credit_card'
       when bank = 'BAC' and account_type = 'savings' then 'bac_savings'
       when bank = 'SANTANDER' and account_type = 'credit_card' then 'santander_credit_card'
       when bank = 'SANTANDER' and account_type = 'savings' then 'santander_savings'
       when bank = 'FICOHSA' and account_type = 'savings' then 'ficohsa_savings'
       when bank = 'REVOLUT' and account_type = 'savings' then 'revolut_savings'
       when bank = 'REVOLUT' and account_type = 'credit_card'
            then 'reject: Revolut card statements cannot be read yet'
       when bank in ('BAC', 'SANTANDER', 'REVOLUT', 'FICOHSA') then 'reject: account type not supported'
       else 'reject: unknown bank: ' || bank end as route
from f
""")
def q18(spark, sf):
    """Bank and account type -> layout, or the reject reason."""
    c = T(spark, sf, "customer")
    bank = F.lit("HSBC")
    for seg, b in reversed(_SEG_BANK):
        bank = F.when(F.col("c_mktsegment") == seg, F.lit(b)).otherwise(bank)
    f = c.select("c_custkey", bank.alias("bank"),
                 F.when(F.col("c_custkey") % 2 == 0, "savings").otherwise("credit_card").alias("account_type"))
    return f.withColumn("route", LY.route(F.col("bank"), F.col("account_type")))


@register("q19_account_from_filename", """
with f as (select page_id, regexp_extract(url, 'https?://([^/]+)', 1) || ' (' || (page_id % 3) || ').csv' as filename
           from pages)
select page_id, filename, trim(split_part(split_part(filename, '.', 1), '(', 1)) as account_name from f
""")
def q19(spark, sf):
    """Account name from a download file name."""
    p = T(spark, sf, "pages")
    fn = F.concat(F.regexp_extract("url", r"https?://([^/]+)", 1), F.lit(" ("), FX.s(F.col("page_id") % 3), F.lit(").csv"))
    f = p.select("page_id", fn.alias("filename"))
    return f.withColumn("account_name", account_from_filename(F.col("filename")))


# ---------------------------------------------------------------------------
# G: merge
# ---------------------------------------------------------------------------

_MERGE_CTE = f"""
o as (
  select o_orderkey as k, o_orderdate as date, o_totalprice as amount, 'C' || o_custkey as account_name,
         o_orderpriority as priority,
         'ORDER ' || o_orderpriority || ' ' || o_orderstatus || ' ' || o_orderkey as base
  from orders),
l as (
  select date, account_name, 'Expense' as tran_type, priority as category, cast(null as varchar) as tag,
         base as description, cast(null as varchar) as notes, 'USD' as currency, amount,
         {_id('date', 'base', 'amount', 'account_name')} as id
  from o where k % 4 <> 3),
s0 as (
  select k as row_no, date, account_name, amount,
         case when k % 5 = 0 then base || ' SETTLED' when k % 5 = 1 then reverse(base) else base end as description
  from o where k % 2 = 1),
s as (select *, {_id('date', 'description', 'amount', 'account_name')} as id from s0),
cand as (
  select l.id as l_id, l.description as l_desc, s.description as n_desc, s.row_no
  from l join s on l.date = s.date and l.amount = s.amount and l.account_name = s.account_name
  where l.description <> s.description
    and 2.0 * least(length(l.description), length(s.description))
        >= {DEFAULT_THRESHOLD} * (length(l.description) + length(s.description)))"""

def _ratio_cte(cand: str = "cand", x: str = "") -> str:
    """Ratcliff/Obershelp (difflib) of the distinct texts of ``cand`` as a
    recursive CTE over pairs p(pk, a, b); ``x`` tells several of them apart."""
    return f"""
p{x} as (select row_number() over () as pk, a, b from (select distinct l_desc as a, n_desc as b from {cand})),
w{x}(pk, a, b, m) as (
  select pk, a, b, 0 from p{x}
  union all
  select pk, unnest([a[1:i-1], a[i+l:]]), unnest([b[1:j-1], b[j+l:]]), unnest([l, 0])
  from (select pk, a, b, s.i as i, s.l as l, instr(b, a[s.i:s.i+s.l-1]) as j
        from (select pk, a, b, (list_sort(flatten(list_transform(range(1, length(a) + 1), lambda i:
                list_transform(
                  list_filter(range(1, least(length(a) - i + 1, length(b)) + 1),
                              lambda l: contains(b, a[i:i+l-1])),
                  lambda l: {{'nl': -l, 'i': i, 'l': l}}))))[1]) as s
              from w{x} where length(a) > 0 and length(b) > 0)
        where s is not null)),
ratio{x} as (
  select p{x}.a, p{x}.b, case when length(p{x}.a) + length(p{x}.b) = 0 then 1.0
         else 2.0::double * sum(w{x}.m)::double / (length(p{x}.a) + length(p{x}.b))::double end as ratio
  from w{x} join p{x} using (pk) group by p{x}.pk, p{x}.a, p{x}.b)"""


_RATIO_CTE = _ratio_cte()

_UPD_CTE = f"""
upd as (
  select c.l_id as old_id, arg_max(c.n_desc, c.row_no) as new_description, count(*) as merged
  from cand c join ratio r on r.a = c.l_desc and r.b = c.n_desc
  where r.ratio >= {DEFAULT_THRESHOLD} group by c.l_id),
l2 as (
  select l.date, l.account_name, l.tran_type, l.category, l.tag,
         coalesce(u.new_description, l.description) as description, l.notes, l.currency, l.amount,
         case when u.old_id is null then l.id
              else {_id('l.date', 'u.new_description', 'l.amount', 'l.account_name')} end as id
  from l left join upd u on l.id = u.old_id),
added as (select * from s where not exists (select 1 from l2 where l2.id = s.id))"""


def _merge_inputs(spark, sf):
    led = FX.merge_ledger(spark, sf)
    st = FX.merge_statement_rows(spark, sf)
    return normalise_ledger(led), prepare_statements(st)


@register("q20_match_candidates", f"""
with {_MERGE_CTE}
select distinct l_id, l_desc, n_desc from cand
""")
def q20(spark, sf):
    """G3 + P1: same (date, amount, account), different text, length bound."""
    led, st = _merge_inputs(spark, sf)
    pairs = candidate_pairs(_ledger_texts(led), _new_texts(st), "l_desc", "n_desc", DEFAULT_THRESHOLD)
    return pairs.select("l_id", "l_desc", "n_desc")


@register("q21_similarity", f"""
with recursive {_MERGE_CTE.strip()}, {_RATIO_CTE.strip()}
select a as l_desc, b as n_desc, ratio from ratio
""")
def q21(spark, sf):
    """Difflib ratio of every candidate pair (Arrow UDF)."""
    led, st = _merge_inputs(spark, sf)
    pairs = candidate_pairs(_ledger_texts(led), _new_texts(st), "l_desc", "n_desc", DEFAULT_THRESHOLD)
    pairs = pairs.select("l_desc", "n_desc").distinct()
    return pairs.select("l_desc", "n_desc", similarity_ratio("l_desc", "n_desc").alias("ratio"))


@register("q22_fuzzy_update", f"""
with recursive {_MERGE_CTE.strip()}, {_RATIO_CTE.strip()}, {_UPD_CTE.strip()}
select old_id, new_description, merged from upd
""")
def q22(spark, sf):
    """Threshold, last matching new row wins, matched pair count."""
    led, st = _merge_inputs(spark, sf)
    upd = fuzzy_updates(touched_ledger(led, st), st, DEFAULT_THRESHOLD)
    return upd.select(F.col("l_id").alias("old_id"), F.col("new_desc").alias("new_description"),
                      F.col("merged").cast("long").alias("merged"))


@register("q23_new_rows", f"""
with recursive {_MERGE_CTE.strip()}, {_RATIO_CTE.strip()}, {_UPD_CTE.strip()}
select row_no, id, description from added
""")
def q23(spark, sf):
    """Statement rows whose id is not in the re-described ledger."""
    led, st = _merge_inputs(spark, sf)
    updates = checkpointed(fuzzy_updates(touched_ledger(led, st), st, DEFAULT_THRESHOLD))  # counted, then joined
    led2 = apply_updates(led, updates)
    return new_rows(led2, st).select("row_no", "id", "description")


@register("q24_append", f"""
with {_MERGE_CTE.strip()}
select * from l
union all
select date, account_name, 'Expense' as tran_type, cast(null as varchar) as category, cast(null as varchar) as tag,
       description, cast(null as varchar) as notes, 'USD' as currency, amount, id
from s where not exists (select 1 from l where l.id = s.id)
""")
def q24(spark, sf):
    """G7 G9 C5 without re-description: ledger plus the new rows."""
    led, st = _merge_inputs(spark, sf)
    add = new_rows(led, st)
    add = add.select(*[F.col(c) if c in add.columns else F.lit(None).cast("string").alias(c) for c in LEDGER_COLUMNS])
    return led.unionByName(add)


_LEDGER_OUT_SQL = f"""
with recursive {_MERGE_CTE.strip()}, {_RATIO_CTE.strip()}, {_UPD_CTE.strip()}
select * from l2
union all
select date, account_name, 'Expense' as tran_type, cast(null as varchar) as category, cast(null as varchar) as tag,
       description, cast(null as varchar) as notes, 'USD' as currency, amount, id
from added
"""


@register("q25_merge_statement", _LEDGER_OUT_SQL)
def q25(spark, sf):
    """The flagship: ledger after merging one statement."""
    led, st = _merge_inputs(spark, sf)
    return merge_statement(led, st).ledger


@register("q26_merge_batch_first_wins", f"""
with o as (
  select o_orderkey as k, o_orderdate as date, o_totalprice as amount, 'C' || o_custkey as account_name,
         o_orderpriority as priority,
         'ORDER ' || o_orderpriority || ' ' || o_orderstatus || ' ' || o_orderkey as base
  from orders)
select date, account_name,
       case when k % 4 = 0 then 'Expense' else 'S' || (case when k % 3 = 0 then 1 else 0 end) end as tran_type,
       case when k % 4 = 0 then priority end as category, cast(null as varchar) as tag,
       base as description, cast(null as varchar) as notes, 'USD' as currency, amount,
       {_id('date', 'base', 'amount', 'account_name')} as id
from o
""")
def q26(spark, sf):
    """G10 case 2: several statements, no similar texts: an id enters with
    the first statement holding it."""
    led, st = FX.first_wins_inputs(spark, sf)
    return merge_batch(led, st).ledger


def _fold_step_sql(before: str, j: int, after: str) -> str:
    """One statement of the fold: ``before`` and ``after`` are the ledger as
    rows (k, date, account_name, category, description, amount)."""
    return f"""
c{j} as (
  select l.k, l.src, l.description as l_desc, s.description as n_desc, s.k as row_no
  from {before} l join st s on s.j = {j} and l.date = s.date and l.amount = s.amount and l.account_name = s.account_name
  where l.description <> s.description
    and 2.0 * least(length(l.description), length(s.description))
        >= {DEFAULT_THRESHOLD} * (length(l.description) + length(s.description))),
{_ratio_cte(f"c{j}", str(j)).strip()},
u{j} as (
  select c.k, c.src, arg_max(c.n_desc, c.row_no) as new_desc
  from c{j} c join ratio{j} r on r.a = c.l_desc and r.b = c.n_desc where r.ratio >= {DEFAULT_THRESHOLD} group by c.k, c.src),
m{j} as (
  select l.k, l.src, l.date, l.account_name, l.category, coalesce(u.new_desc, l.description) as description, l.amount
  from {before} l left join u{j} u on l.k = u.k and l.src = u.src),
i{j} as (select distinct {_id('date', 'description', 'amount', 'account_name')} as id from m{j}),
{after} as (
  select * from m{j}
  union all
  select k, {j}, date, account_name, null, description, amount from st
  where j = {j} and {_id('date', 'description', 'amount', 'account_name')} not in (select id from i{j}))"""


@register("q27_merge_batch_contested", f"""
with recursive o as (
  select o_orderkey as k, date_trunc('month', o_orderdate)::timestamp as date, floor(o_totalprice / 1e5)::double as amount,
         'C' || (o_custkey % 50) as account_name, o_orderpriority as category, 'PAY REF ' || (o_orderkey % 1000) as base
  from orders),
l as (select k, -1 as src, date, account_name, category, base as description, amount from o where k % 3 = 0),
st as (
  select o.k, t.j, o.date, o.account_name, case when t.j = 1 then o.base || ' X' else o.base end as description, o.amount
  from o, (values (0), (1)) t(j) where (o.k + t.j) % 3 <> 0),
{_fold_step_sql('l', 0, 'l0').strip()},
{_fold_step_sql('l0', 1, 'l1').strip()}
select date, account_name, 'Expense' as tran_type, category, cast(null as varchar) as tag, description,
       cast(null as varchar) as notes, 'USD' as currency, amount,
       {_id('date', 'description', 'amount', 'account_name')} as id
from l1
""")
def q27(spark, sf):
    """G10 case 3: blocks with several statements and similar texts are
    folded in rounds, the r-th statement of every block at once."""
    led, st = FX.contested_inputs(spark, sf)
    return merge_batch(led, st).ledger


@register("q28_run_metrics", f"""
with recursive {_MERGE_CTE.strip()}, {_RATIO_CTE.strip()}, {_UPD_CTE.strip()}
select 'stmt_orders' as file, (select count(*) from s) as parsed,
       (select cast(coalesce(sum(merged), 0) as bigint) from upd) as merged, (select count(*) from added) as added
""")
def q28(spark, sf):
    """Per statement file rows parsed, pairs re-described, rows added."""
    led, st = _merge_inputs(spark, sf)
    return merge_statement(led, st).metrics


# ---------------------------------------------------------------------------
# A: sources and sinks
# ---------------------------------------------------------------------------

def _csv_field_sql(x: str) -> str:
    v = f"coalesce({x}, '')"
    return (f"(case when contains({v}, ',') or contains({v}, chr(10)) or contains({v}, '\"') "
            f"then '\"' || replace({v}, '\"', '\"\"') || '\"' else {v} end)")


@register("q29_csv_encode", f"""
select doc_id, concat_ws(',', {_csv_field_sql('cast(doc_id as varchar)')}, {_csv_field_sql('lang')},
                         {_csv_field_sql('source')}, {_csv_field_sql('text')}) as line
from documents
""")
def q29(spark, sf):
    """CSV lines, quoted only when needed, inner quotes doubled."""
    d = T(spark, sf, "documents")
    return d.select("doc_id", csv_line([F.col("doc_id"), F.col("lang"), F.col("source"), F.col("text")]).alias("line"))


@register("q30_html_tables", """
with n as (select r.r_regionkey, r.r_name, n.n_name, n.n_nationkey,
                  row_number() over (partition by r.r_regionkey order by n.n_nationkey) as rn
           from nation n join region r on n.n_regionkey = r.r_regionkey),
c as (select *, row_number() over (partition by c_nationkey order by c_custkey) as rn, count(*) over (partition by c_nationkey) as k from customer)
select distinct cast(100000 + r_regionkey as bigint) as page_id, cast(0 as bigint) as row_no,
       'Account Name,Nation,Key,Note' as line from n
union all
select cast(100000 + r_regionkey as bigint) as page_id, rn as row_no,
       r_name || ',' || n_name || ',' || n_nationkey || ',a & b' as line from n
union all
select distinct cast(200000 + c_nationkey as bigint), cast(0 as bigint), 'Account Name,Customer' from c
union all
select cast(200000 + c_nationkey as bigint), rn, 'SAVINGS ' || c_nationkey || ',' || c_name || chr(233) || '<' || c_mktsegment || '|' || c_custkey from c
union all
select distinct cast(200000 + c_nationkey as bigint), k + 1, 'SAVINGS ' || c_nationkey || ',' || k from c
""")
def q30(spark, sf):
    """A10/R2: the visible account table of every page -> CSV rows with the
    account name prepended: pages rendered from nation and from customer
    (foot before the rows, nested tables, hidden by an outer element,
    character references), and the real pages."""
    n = T(spark, sf, "nation")
    r = T(spark, sf, "region")
    rows_of = lambda key, tr: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key, tr.alias("tr")))), lambda x: x["tr"]), "")
    tr = F.concat(F.lit("<tr>\n  <td>\n\t"), F.col("n_name"), F.lit("\t</td><td>"), FX.s("n_nationkey"),
                  F.lit("</td><td class=\"x\">a &amp; b</td></tr>"))
    body = n.groupBy("n_regionkey").agg(rows_of("n_nationkey", tr).alias("body"))
    html = F.concat(
        F.lit('<html><body><h2 class="bel-typography bel-typography-h2">\n'), F.col("r_name"),
        F.lit('\t</h2><table id="creditCardStateTRX" style="display: none"><tr><td>hidden</td></tr></table>'),
        F.lit('<table id="transactionTable" class="t"><tr><th>Nation</th><th>Key</th><th>Note</th></tr>'),
        F.col("body"), F.lit("</table></body></html>"))
    rendered = body.join(r, body.n_regionkey == r.r_regionkey).select(
        (F.lit(100000) + F.col("r_regionkey")).cast("long").alias("page_id"), F.lit("").alias("url"), html.alias("html"))
    c = T(spark, sf, "customer")
    tr = F.concat(F.lit("<tr><td>"), F.col("c_name"), F.lit("&eacute;&#60;"), F.col("c_mktsegment"),
                  F.lit('<table id="transactionTable1"><tr><td>|<td>'), FX.s("c_custkey"), F.lit("</table>"))
    body = c.groupBy("c_nationkey").agg(rows_of("c_custkey", tr).alias("body"), F.count(F.lit(1)).alias("k"))
    html = F.concat(
        F.lit('<div id="debitAccountNameDiv"><p><span>\n\tSAVINGS '), FX.s("c_nationkey"), F.lit('</span></p></div>'),
        F.lit('<div style="display:none"><section><table id="creditCardRecentMovementsTable"><tr><td>hidden</td></tr></table></section></div>'),
        F.lit('<table id="transactionTable"><tfoot><tr><td>'), FX.s("k"), F.lit("</tfoot><thead><tr><th>Customer</thead>"), F.col("body"), F.lit("</table>"))
    accounts = body.select((F.lit(200000) + F.col("c_nationkey")).cast("long").alias("page_id"), F.lit("").alias("url"), html.alias("html"))
    pages = T(spark, sf, "pages").select("page_id", "url", "html").unionByName(rendered).unionByName(accounts)
    rows = extract_tables(pages)
    return rows.select("page_id", "row_no", csv_line_from_array(F.col("cells")).alias("line"))


@register("q31_csv_round_trip", f"""
select o_orderdate as date, 'C' || o_custkey as account_name, 'Expense' as tran_type, o_orderpriority as category,
       cast(null as varchar) as tag, 'ORDER, "' || o_orderpriority || '"' || chr(10) || o_orderkey as description,
       case when o_orderkey % 7 = 0 then ' note ' end as notes, 'USD' as currency,
       case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end as amount,
       {_id('o_orderdate', """'ORDER, "' || o_orderpriority || '"' || chr(10) || o_orderkey""",
            "case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end", "'C' || o_custkey")} as id
from orders
""")
def q31(spark, sf):
    """A6 -> A4: ledger written as CSV (BOM, quoting) and read back; the
    round trip keeps every value and id."""
    o = T(spark, sf, "orders")
    led = o.select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("date"),
        F.concat(F.lit("C"), FX.s("o_custkey")).alias("account_name"),
        F.lit("Expense").alias("tran_type"), F.col("o_orderpriority").alias("category"),
        F.lit(None).cast("string").alias("tag"),
        F.concat(F.lit('ORDER, "'), "o_orderpriority", F.lit('"\n'), FX.s("o_orderkey")).alias("description"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(" note ")).alias("notes"),
        F.lit("USD").alias("currency"),
        F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"),
    ).withColumn("id", row_id())
    path = scratch_path(spark, f"ledger-csv-{uuid.uuid4().hex}")
    write_ledger_csv(led, path)
    back = read_ledger_csv(spark, path, missing_ok=False)
    return back.withColumn("id", row_id())


@register("q32_stream_ingest", f"""
select cast(date '2024-01-01' + cast(c_custkey % 365 as integer) as timestamp) as date,
       'BAC USD 911' as account_name,
       case when ({_BAL}) < 0 then 'Expense' else 'Income' end as tran_type,
       cast(null as varchar) as category, cast(null as varchar) as tag,
       c_name || ' ' || c_mktsegment as description, cast(null as varchar) as notes, 'USD' as currency,
       {_BAL} as amount,
       {_id("cast(date '2024-01-01' + cast(c_custkey % 365 as integer) as timestamp)",
            "c_name || ' ' || c_mktsegment", _BAL, "'BAC USD 911'")} as id
from customer
""")
def q32(spark, sf):
    """Three overlapping statement files dropped in a folder, ingested
    by a Structured Streaming query (availableNow, one file per batch)."""
    from tallyspark.sources.accounts import accounts_from_dict
    from tallyspark.streaming.ingest import latest_version, start_ingest

    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    grid, _ = FX.bac_savings_grid(spark, sf, by="c_custkey", prefix="")
    data = grid.where(F.col("row_no") > 0)
    header = csv_line_from_array(F.array(*[F.lit(h) for h in FX.BAC_SAVINGS_HEADER]))
    # statement j holds every customer whose key % 3 <> j (each row is in two
    # files); one write, one file per statement (hash-partitioned by j)
    rows = data.select(F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j"), "row_no", "cells") \
        .where((F.col("row_no") - 1) % 3 != F.col("j"))
    lines = rows.select("j", "row_no", csv_line_from_array(F.col("cells")).alias("line"))
    heads = rows.select("j").distinct().select("j", F.lit(0).cast("long").alias("row_no"), header.alias("line"))
    (lines.unionByName(heads).repartition("j").sortWithinPartitions("j", "row_no").select("j", "line")
     .write.mode("errorifexists").partitionBy("j").text(f"{root}/drop"))
    accounts = accounts_from_dict(spark, {"BAC USD 911": {"currency": "USD", "bank": "BAC", "type": "savings",
                                                          "id_pattern": "BACUSD911"}})
    q = start_ingest(spark, f"{root}/drop", f"{root}/ledger", accounts, checkpoint=f"{root}/ckpt",
                     max_files_per_trigger=1, glob="part-*", recursive=True)
    q.awaitTermination()
    return latest_version(spark, f"{root}/ledger", q)


@register("q33_folder_ingest", f"""
select cast(date '2024-01-01' + cast(c_custkey % 365 as integer) as timestamp) as date,
       case when c_nationkey % 2 = 0 then 'BAC USD 911' else 'BAC HNL 271' end as account_name,
       case when ({_BAL}) < 0 then 'Expense' else 'Income' end as tran_type,
       cast(null as varchar) as category, cast(null as varchar) as tag,
       c_name || ' ' || c_mktsegment as description, cast(null as varchar) as notes,
       case when c_nationkey % 2 = 0 then 'USD' else 'HNL' end as currency,
       {_BAL} as amount,
       {_id("cast(date '2024-01-01' + cast(c_custkey % 365 as integer) as timestamp)",
            "c_name || ' ' || c_mktsegment", _BAL,
            "case when c_nationkey % 2 = 0 then 'BAC USD 911' else 'BAC HNL 271' end")} as id
from customer where c_nationkey <> 24
""")
def q33(spark, sf):
    """A1-A3 + B1-B7 + N2 + G7-G9 end to end: statement CSV files on disk
    (one per nation; odd nations written in cp1252; nation 24 belongs to an
    unknown account) -> folder scan -> identify -> normalise -> merge."""
    from tallyspark.plans.pipeline import run_batch
    from tallyspark.sources.accounts import accounts_from_dict
    from tallyspark.sources.ledger import empty_ledger

    root = scratch_path(spark, f"folder-{uuid.uuid4().hex}")
    c = T(spark, sf, "customer")
    acct = (F.when(F.col("c_nationkey") == 24, F.lit("BAC XXX 000"))
            .when(F.col("c_nationkey") % 2 == 0, F.lit("BAC USD 911")).otherwise(F.lit("BAC HNL 271")))
    neg = F.col("c_acctbal") < 0
    data = c.select(
        F.col("c_nationkey").alias("nation"), (F.col("c_custkey") + 1).alias("row_no"),
        csv_line([
            acct,
            FX.dmy(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))),
            FX.s("c_custkey"),
            F.concat(F.col("c_name"), F.lit("  "), F.col("c_mktsegment")),
            F.when(neg, FX.grouped_amount(-F.col("c_acctbal"))).otherwise(F.lit("")),
            F.when(~neg, FX.grouped_amount("c_acctbal")).otherwise(F.lit("")),
            FX.grouped_amount(F.abs(F.col("c_acctbal"))),
        ]).alias("line"),
    )
    header = csv_line([F.lit(h) for h in FX.BAC_SAVINGS_HEADER])
    heads = data.select("nation", F.lit(0).cast("long").alias("row_no"), header.alias("line")).distinct()
    lines = data.unionByName(heads).repartition("nation").sortWithinPartitions("nation", "row_no")
    for enc, parity in (("UTF-8", 0), ("windows-1252", 1)):
        # one column, separator / quote characters that never occur: lines are written verbatim
        (lines.where(F.col("nation") % 2 == parity).select("nation", "line").write
         .option("sep", "\u0001").option("quote", "\u0002").option("escape", "\u0003")
         .option("encoding", enc).partitionBy("nation").csv(f"{root}/in/{enc}"))
    accounts = accounts_from_dict(spark, {
        "BAC USD 911": {"currency": "USD", "bank": "BAC", "type": "savings", "id_pattern": "BACUSD911"},
        "BAC HNL 271": {"currency": "HNL", "bank": "BAC", "type": "savings", "id_pattern": "BACHNL271"},
    })
    res = run_batch(spark, [f"{root}/in/UTF-8", f"{root}/in/windows-1252"], empty_ledger(spark), accounts,
                    glob="part-*")
    return res.merge.ledger


# ---------------------------------------------------------------------------
# folders of many kinds of files, ledger versions, account checks
# ---------------------------------------------------------------------------

def _verbatim(lines, path: str, encoding: str) -> None:
    """One .csv file per value of ``kind``, its lines as they are."""
    # separator and quote characters that never occur
    (lines.repartition("kind").sortWithinPartitions("kind", "k").select("kind", "line").write
     .option("sep", "\u0001").option("quote", "\u0002").option("escape", "\u0003").option("encoding", encoding)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").partitionBy("kind").csv(path))


@register("q34_file_rejects", """
select c_custkey % 6 as kind,
       case c_custkey % 6 when 1 then 'format not supported' when 2 then 'quoted cell not closed' when 3 then 'empty file'
                          when 4 then 'text is neither UTF-8 nor cp1252' end as reason,
       cast(case when c_custkey % 6 in (0, 5) then count(*) else 0 end as bigint) as n_rows,
       cast(case when c_custkey % 6 in (0, 5) then sum(c_custkey) else 0 end as bigint) as total
from customer group by c_custkey % 6
""")
def q34(spark, sf):
    """A1-A3: one folder with files of every kind: quoted line breaks, another
    format, a quote left open, blank lines only, bytes of no known encoding,
    and cp1252; each gives its rows or a reject with the reason."""
    from tallyspark.sources.grid import scan_folder

    root = scratch_path(spark, f"kinds-{uuid.uuid4().hex}")
    c = T(spark, sf, "customer").select((F.col("c_custkey") % 6).alias("kind"), F.col("c_custkey").alias("k"), FX.s("c_custkey").alias("key"), "c_name")
    name = F.concat("c_name", F.lit(' "x",\n\u00f1'))
    (c.where("kind = 0").repartition(1).select("key", name.alias("name"))
     .write.option("quote", '"').option("escape", '"').csv(f"{root}/in/kind=0"))
    c.where("kind = 1").repartition(1).select("key").write.text(f"{root}/in/kind=1")
    line = F.when(F.col("kind") == 2, F.concat("key", F.when(F.col("k") == 2, ',"open').otherwise(",open"))).when(F.col("kind") == 3, F.lit(" \t")) \
        .when(F.col("kind") == 4, F.concat("key", F.lit(",\u0081\u00ff"))).otherwise(F.concat("key", F.lit(',a\u20ac\n'.rstrip())))
    lines = c.select("kind", "k", line.alias("line"))
    _verbatim(lines.where("kind IN (2, 3)"), f"{root}/in/utf8", "UTF-8")
    _verbatim(lines.where("kind = 4"), f"{root}/in/none", "ISO-8859-1")
    _verbatim(lines.where("kind = 5"), f"{root}/in/cp", "windows-1252")
    grid, rejects = scan_folder(spark, f"{root}/in")
    kind = F.regexp_extract("file", "kind=([0-9])", 1).cast("long").alias("kind")
    right = F.when(F.element_at("cells", 2).endswith(' "x",\n\u00f1') | (F.element_at("cells", 2) == "a\u20ac"), F.element_at("cells", 1).cast("long"))
    good = grid.groupBy(kind).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(right).alias("total"))
    good = good.select("kind", F.lit(None).cast("string").alias("reason"), "n_rows", "total")
    zero = F.lit(0).cast("long")
    return good.unionByName(rejects.select(kind, "reason", zero.alias("n_rows"), zero.alias("total")))


@register("q35_all_layouts", " union all by name ".join(
    f"select {_CANON} from ({ORACLES[q]})" for q in (
        "q10_card_dual_currency", "q11_bac_savings", "q12_santander_savings", "q13_santander_card", "q14_ficohsa_savings", "q15_revolut_savings")))
def q35(spark, sf):
    """The statements of all six layouts in one grid: one pass for the
    headers, one for the rows."""
    made = [
        (FX.bac_card_grid(spark, sf, kept=False), LY.BAC_CARD), (FX.bac_savings_grid(spark, sf, kept=False), LY.BAC_SAVINGS),
        (FX.santander_grid(spark, sf, "san_sv_", "SANTANDER AHORRO", kept=False), LY.SANTANDER_SAVINGS),
        (_santander_card(spark, sf, kept=False), LY.SANTANDER_CARD),
        (FX.ficohsa_grid(spark, sf, kept=False), LY.FICOHSA_SAVINGS), (FX.revolut_grid(spark, sf, kept=False), LY.REVOLUT_SAVINGS),
    ]
    grid, routed = None, None
    for (g, r), lay in made:
        g = g.select("file", "row_no", "cells")
        r = r.select("file", "account_name", "currency", F.lit(lay.bank).alias("bank"), F.lit(lay.account_type).alias("account_type"))
        grid = g if grid is None else grid.unionByName(g)
        routed = r if routed is None else routed.unionByName(r)
    rows, _ = LY.normalise_all(stored(grid, "all-layouts", "zstd"), routed, on_error="reject")
    return rows


@register("q36_month_versions", """
select m as ym, cast(max(case when o_orderkey % 4 = 3 and year(o_orderdate) = 1995 then 1 else 0 end) as bigint) as version,
       cast(count(*) as bigint) as rows
from (select *, strftime(o_orderdate, '%Y-%m') as m from orders)
where o_orderkey % 4 <> 3 or year(o_orderdate) = 1995 group by m
""")
def q36(spark, sf):
    """G7 G9 on ledger versions: a statement of one year reads and writes the
    months of that year only; the others stay in the files they are in."""
    root = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    write_version(spark, root, 0, normalise_ledger(FX.merge_ledger(spark, sf)))
    o = FX._orders_base(spark, sf).where(F.year("date") == 1995)
    stmt = o.select(
        F.lit("year_1995").alias("file"), F.lit(0).cast("long").alias("stmt_seq"), F.col("k").alias("row_no"),
        "date", "account_name", F.lit("Expense").alias("tran_type"), F.col("base").alias("description"), F.lit("USD").alias("currency"), "amount")
    version, _ = merge_into(spark, root, 1, stmt)
    read = version.read(spark).withColumn("v", F.regexp_extract(F.col("_metadata.file_path"), "v=([0-9]+)", 1).cast("long"))
    return read.groupBy("ym").agg(F.max("v").alias("version"), F.count(F.lit(1)).alias("rows"))


@register("q37_verified_ids", """
select strftime(o_orderdate, '%Y-%m') as ym, cast(count(*) as bigint) as rows, cast(count(*) as bigint) as right_ids,
       strftime(o_orderdate, '%Y-%m') = '1996-03' as hashed_again
from orders where o_orderkey % 4 <> 3 group by all
""")
def q37(spark, sf):
    """ids of a stored ledger.  Months whose checksum agrees with the
    manifest are not hashed again; in one month ids were forged."""
    root = scratch_path(spark, f"verified-{uuid.uuid4().hex}")
    version = write_version(spark, root, 0, normalise_ledger(FX.merge_ledger(spark, sf)))
    month = version.paths(["1996-03"])[0]
    forged = stored(version.read(spark, ["1996-03"]).select(*LEDGER_COLUMNS).withColumn("id", F.sha2(F.col("id"), 256)), "forged")
    forged.write.mode("overwrite").parquet(month)
    rows, bad = verified_ledger(spark, version)
    return rows.groupBy("ym").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("id") == row_id(), 1)).alias("right_ids")) \
        .withColumn("hashed_again", F.col("ym").isin(*bad) if bad else F.lit(False))


@register("q38_ordered_export", f"""
with o as (
  select o_orderdate as date, 'C' || o_custkey as account_name, o_orderpriority as category,
         'ORDER, "' || o_orderkey || '"' as description, o_totalprice as amount from orders),
l as (
  select date, strftime(date, '%Y-%m-%d') || ',' || account_name || ',Expense,' || category || ',,"' || replace(description, '"', '""') || '",,USD,'
         || amount || ',' || {_id('date', 'description', 'amount', 'account_name')} as line from o),
a as (select cast(row_number() over (order by date desc, line) as bigint) as pos, line from l)
select * from a
union all
select 0 as pos, chr(65279) || 'date,account_name,tran_type,category,tag,description,notes,currency,amount,id' as line
""")
def q38(spark, sf):
    """The ledger's CSV in parts: newest date first, the parts in the
    order of their names, one BOM and one header."""
    o = T(spark, sf, "orders")
    led = o.select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("date"), F.concat(F.lit("C"), FX.s("o_custkey")).alias("account_name"),
        F.lit("Expense").alias("tran_type"), F.col("o_orderpriority").alias("category"), F.lit(None).cast("string").alias("tag"),
        F.concat(F.lit('ORDER, "'), FX.s("o_orderkey"), F.lit('"')).alias("description"), F.lit(None).cast("string").alias("notes"),
        F.lit("USD").alias("currency"), F.col("o_totalprice").alias("amount"), ).withColumn("id", row_id())
    path = scratch_path(spark, f"export-{uuid.uuid4().hex}")
    write_ledger_export(led, path)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"))
    lines = stored(lines, "export-lines")
    # where a split begins, from the rows of those before it
    splits = lines.groupBy("file", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("off", F.coalesce(F.sum("n").over(w), F.lit(0)))
    out = lines.join(sized_broadcast(splits), ["file", "split"])
    line = F.when(F.col("off") + F.col("at") - F.col("first") == 0, F.concat(F.lit("\ufeff"), F.replace("line", F.lit("\ufeff"), F.lit("")))).otherwise(F.col("line"))
    return out.select((F.col("off") + F.col("at") - F.col("first")).alias("pos"), line.alias("line"))


@register("q39_unknown_accounts", """
with names as (select c_name || case when c_custkey % 2 = 0 then ' (1).csv' else '.2024.csv' end as file, c_name, c_custkey from customer)
select file, c_name as account_name, c_custkey % 7 <> 0 as known from names
""")
def q39(spark, sf):
    """The account in a file's name, and whether it is configured."""
    c = T(spark, sf, "customer")
    files = c.select(F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, " (1).csv").otherwise(".2024.csv")).alias("file"))
    accounts = c.where("c_custkey % 7 <> 0").select(F.col("c_name").alias("account_name"))
    names = files.withColumn("account_name", account_from_filename(F.col("file")))
    unknown = unknown_accounts(names, accounts).withColumn("known", F.lit(False))
    return names.join(unknown.select("file", "known"), "file", "left").withColumn("known", F.coalesce("known", F.lit(True)))


@register("q40_accounts_json", """
select s_name as account_name, 'USD' as currency, 'BAC' as bank, 'savings' as account_type, 'BAC ' || s_suppkey || '|[A-Z]{2}' as id_pattern
from supplier where s_suppkey % 5 <> 0
""")
def q40(spark, sf):
    """The accounts file, a JSON map, read back without the accounts whose
    pattern no regex engine can use."""
    p = T(spark, sf, "supplier").select(
        "s_name", F.when(F.col("s_suppkey") % 5 == 0, F.lit("(")).otherwise(F.concat(F.lit("BAC "), FX.s("s_suppkey"), F.lit("|[A-Z]{2}"))).alias("pattern"))
    entry = F.struct(F.lit("USD").alias("currency"), F.lit("BAC").alias("bank"), F.lit("savings").alias("type"), F.col("pattern").alias("id_pattern"))
    text = p.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("s_name", entry.alias("e"))))).alias("json"))
    path = scratch_path(spark, f"accounts-{uuid.uuid4().hex}")
    text.write.text(path)
    accounts, _ = screen_patterns(read_accounts(spark, path))
    return accounts


@register("q41_raw_match", f"""
with a(account_name, id_pattern) as (values {", ".join(f"('{n}', '{p}')" for n, p, *_ in RAW_PATTERNS)}),
m as (select doc_id, a.account_name from documents, a where regexp_matches(text, id_pattern)),
c as (select doc_id, count(*) as n, min(account_name) as account_name from m group by doc_id)
select cast(d.doc_id as varchar) as file, case when c.n = 1 then c.account_name end as account_name,
       case when c.n is null then 'no account matched' when c.n > 1 then 'more than one account matched' end as reason
from documents d left join c on c.doc_id = d.doc_id where d.text is not null
""")
def q41(spark, sf):
    """Patterns with blanks and lower-case letters, on whole raw texts."""
    texts = T(spark, sf, "documents").where("text IS NOT NULL").select(FX.s("doc_id").alias("file"), "text")
    accounts = spark.createDataFrame(RAW_PATTERNS, "account_name string, id_pattern string, bank string, account_type string, currency string")
    unique, rejects = split_unique(match_accounts(texts, accounts, normalize=False), texts)
    none = F.lit(None).cast("string")
    return unique.select("file", "account_name", none.alias("reason")).unionByName(rejects.select("file", none.alias("account_name"), "reason"))


@register("q42_consumed_inputs", """
select c_nationkey as nation, c_nationkey % 3 = 0 as kept, cast(case when c_nationkey % 3 = 0 then 0 else count(*) end as bigint) as in_ledger
from customer group by c_nationkey
""")
def q42(spark, sf):
    """A batch with its deletions: the files of known accounts go once
    the ledger is committed, the others stay."""
    from tallyspark.plans.pipeline import run_batch
    from tallyspark.sources.accounts import accounts_from_dict
    from tallyspark.sources.grid import list_files
    from tallyspark.sources.ledger import empty_ledger, read_ledger

    root = scratch_path(spark, f"consumed-{uuid.uuid4().hex}")
    c = T(spark, sf, "customer").where("c_nationkey IS NOT NULL")
    account = F.when(F.col("c_nationkey") % 3 == 0, F.lit("OTHER BANK")).otherwise(F.lit("BAC USD 911"))
    line = csv_line([account, F.lit("05/01/2024"), FX.s("c_custkey"), F.concat(FX.s("c_nationkey"), F.lit("/"), FX.s("c_custkey")),
                     F.lit(""), FX.s("c_custkey"), F.lit("0")])
    data = c.select(F.col("c_nationkey").alias("kind"), (F.col("c_custkey") + 1).alias("k"), line.alias("line"))
    head = data.select("kind", F.lit(0).cast("long").alias("k"), csv_line([F.lit(h) for h in FX.BAC_SAVINGS_HEADER]).alias("line")).distinct()
    _verbatim(data.unionByName(head), f"{root}/in", "UTF-8")
    accounts = accounts_from_dict(spark, {"BAC USD 911": {"currency": "USD", "bank": "BAC", "type": "savings", "id_pattern": "BACUSD911"}})
    run_batch(spark, f"{root}/in", empty_ledger(spark), accounts, out_path=f"{root}/ledger", delete_inputs=True)
    nation = F.regexp_extract("file", "kind=([0-9]+)", 1).cast("int")
    left = list_files(spark, f"{root}/in").select(nation.alias("nation")).withColumn("kept", F.lit(True))
    led = read_ledger(spark, f"{root}/ledger").groupBy(F.split("description", "/")[0].cast("int").alias("nation")).agg(F.count(F.lit(1)).alias("in_ledger"))
    return led.join(left, "nation", "full").select(
        "nation", F.coalesce("kept", F.lit(False)).alias("kept"), F.coalesce("in_ledger", F.lit(0)).cast("long").alias("in_ledger"))
