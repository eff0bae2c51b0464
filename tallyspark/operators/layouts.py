"""Statement layouts (N1-N7) and the generic normaliser (C1-C6, D1-D11, E-*).

Every bank export is described by a declarative :class:`StatementLayout`
(where the header is, which header text feeds which canonical field, how
dates, amounts and transaction types are derived).  :func:`normalise`
interprets a layout into native Spark expressions over GRID rows, so all
files of all banks are normalised in one plan:

    GRID rows of routed files
      -> header row per file (one aggregate for the rules of all layouts)
      -> column positions per file (array_position on the header)
      -> data rows: cells at the file's positions -> clean -> typed row

The grid is scanned twice, for the headers and for the data, however many
layouts occur; what differs between layouts is data of the per-file table or
a branch of one projection.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import clean as C
from tallyspark.functions.identity import row_id
from tallyspark.operators.common import checkpointed, sized_broadcast, stored


@dataclass(frozen=True)
class HeaderRule:
    """Where the header row of a file is.

    ``first``   physical row 0 (CSV header);
    ``row``     a fixed physical row (C1);
    ``keyword`` the first row whose first cell equals ``keyword`` (C2).
    """

    kind: str = "first"
    row: int = 0
    keyword: str | None = None

    def predicate(self) -> Column:
        if self.kind == "first":
            return F.col("row_no") == 0
        if self.kind == "row":
            return F.col("row_no") == self.row
        if self.kind == "keyword":
            return F.get("cells", F.lit(0)) == F.lit(self.keyword)
        raise ValueError(f"unknown header rule {self.kind}")


@dataclass(frozen=True)
class StatementLayout:
    name: str
    bank: str
    account_type: str
    header: HeaderRule = field(default_factory=HeaderRule)
    # canonical field -> header text
    columns: dict = field(default_factory=dict)
    # header texts that must exist although they are not used (dropped columns)
    dropped: tuple = ()
    # dropped columns that are removed before the blank-row check (D1 then
    # applies to the first remaining column)
    drop_before_blank_check: bool = False
    date_format: str = C.DAY_FIRST
    date_strict: bool = False
    date_to_day: bool = False
    drop_null_dates: bool = True
    # "signed" | "dual_currency" | "debit_credit"
    amount_rule: str = "signed"
    strip_amount_chars: bool = True
    negate_amount: bool = False
    # "sign_income" | "sign_transfer" | "expense"
    type_rule: str = "sign_income"
    not_implemented: str | None = None

    def required(self) -> list[str]:
        return list(self.columns.values()) + list(self.dropped)


# ---------------------------------------------------------------------------
# The bank export layouts (header texts, header positions).
# ---------------------------------------------------------------------------
BAC_CARD = StatementLayout(
    name="bac_credit_card", bank="BAC", account_type="credit_card",
    columns={"date": "Fecha", "description": "Concepto",
             "amount_hnl": "Monto lempiras", "amount_usd": "Monto dólares"},
    dropped=("Account Name",),
    date_strict=True, amount_rule="dual_currency", negate_amount=True, type_rule="expense",
)
BAC_SAVINGS = StatementLayout(
    name="bac_savings", bank="BAC", account_type="savings",
    columns={"date": "Fecha", "description": "Descripción", "debits": "Débitos", "credits": "Créditos"},
    dropped=("Referencia", "Balance", "Account Name"),
    date_strict=True, amount_rule="debit_credit",
)
SANTANDER_CARD = StatementLayout(
    name="santander_credit_card", bank="SANTANDER", account_type="credit_card",
    header=HeaderRule("row", row=7),
    columns={"date": "FECHA OPERACIÓN", "description": "CONCEPTO", "amount": "IMPORTE EUR"},
    type_rule="sign_transfer",
)
SANTANDER_SAVINGS = StatementLayout(
    name="santander_savings", bank="SANTANDER", account_type="savings",
    header=HeaderRule("row", row=7),
    columns={"date": "FECHA OPERACIÓN", "description": "CONCEPTO", "amount": "IMPORTE EUR"},
    dropped=("FECHA VALOR", "SALDO"),
)
FICOHSA_SAVINGS = StatementLayout(
    name="ficohsa_savings", bank="FICOHSA", account_type="savings",
    header=HeaderRule("keyword", keyword="Fecha"),
    columns={"date": "Fecha", "description": "Descripción", "debits": "Débito", "credits": "Crédito"},
    amount_rule="debit_credit",
)
REVOLUT_SAVINGS = StatementLayout(
    name="revolut_savings", bank="REVOLUT", account_type="savings",
    columns={"date": "Started Date", "description": "Description", "amount": "Amount"},
    dropped=("Type", "Product", "Completed Date", "Currency", "State", "Balance", "Fee"),
    drop_before_blank_check=True,
    date_format=C.ISO_SECONDS, date_strict=True, date_to_day=True, drop_null_dates=False,
    strip_amount_chars=False,
)
REVOLUT_CARD = StatementLayout(
    name="revolut_credit_card", bank="REVOLUT", account_type="credit_card",
    not_implemented="Revolut card statements cannot be read yet",
)

# Variants for Santander CSV exports: the header is found by its first cell
# instead of a fixed row (blank lines in a CSV shift physical rows).  Pass
# ``layouts=SANTANDER_BY_KEYWORD_LAYOUTS`` to use them.
SANTANDER_CARD_BY_KEYWORD = dataclasses.replace(
    SANTANDER_CARD, header=HeaderRule("keyword", keyword="FECHA OPERACIÓN"))
SANTANDER_SAVINGS_BY_KEYWORD = dataclasses.replace(
    SANTANDER_SAVINGS, header=HeaderRule("keyword", keyword="FECHA OPERACIÓN"))

LAYOUTS: tuple[StatementLayout, ...] = (
    BAC_CARD, BAC_SAVINGS, SANTANDER_CARD, SANTANDER_SAVINGS, FICOHSA_SAVINGS,
    REVOLUT_SAVINGS, REVOLUT_CARD,
)
SANTANDER_BY_KEYWORD_LAYOUTS: tuple[StatementLayout, ...] = (
    BAC_CARD, BAC_SAVINGS, SANTANDER_CARD_BY_KEYWORD, SANTANDER_SAVINGS_BY_KEYWORD, FICOHSA_SAVINGS,
    REVOLUT_SAVINGS, REVOLUT_CARD,
)
# banks with a normaliser; a known bank with another account type is rejected
KNOWN_BANKS = ("BAC", "SANTANDER", "REVOLUT", "FICOHSA")


# ---------------------------------------------------------------------------
# header handling
# ---------------------------------------------------------------------------

def _by_layout(layouts, rule, key) -> Column:
    """``rule(layout)`` of the row's layout; layouts of equal ``key`` share a
    branch, and a single key needs none."""
    groups: dict = {}
    for lay in layouts:
        groups.setdefault(key(lay), []).append(lay)
    if len(groups) == 1:
        return rule(layouts[0])
    out = None
    for same in groups.values():
        hit, value = F.col("layout").isin(*[lay.name for lay in same]), rule(same[0])
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def find_headers(grid: DataFrame, rule: HeaderRule) -> DataFrame:
    """(file, hdr_row, header) from the candidate rows of each file."""
    return _headers(grid.where(rule.predicate()), [])


def _headers(candidates: DataFrame, by: list[str]) -> DataFrame:
    return candidates.groupBy("file", *by).agg(F.min("row_no").alias("hdr_row"), F.min_by("cells", "row_no").alias("header"))


def fields_of(layouts) -> list[str]:
    """The fields that some layout has."""
    return list(dict.fromkeys(fld for lay in layouts for fld in lay.columns))


def header_positions(headers: DataFrame, layouts) -> DataFrame:
    """Per file: 1-based position of every field's header text (0 = missing,
    null = not in the layout), the position of the column for the blank-row
    check, and the list of missing header texts."""
    keep = [F.col(c) for c in headers.columns if c != "header"]
    header = F.coalesce(F.col("header"), F.array().cast("array<string>"))
    cols = []
    for fld in fields_of(layouts):
        at = lambda lay, f=fld: F.array_position(header, F.lit(lay.columns[f])).cast("int") if f in lay.columns else F.lit(None).cast("int")
        cols.append(_by_layout(layouts, at, lambda lay, f=fld: lay.columns.get(f)).alias(f"_p_{fld}"))

    def blank_position(lay: StatementLayout) -> Column:
        if not (lay.drop_before_blank_check and lay.dropped):
            return F.lit(1)
        drops = F.array(*[F.lit(t) for t in lay.dropped])
        first_kept = F.get(F.filter(header, lambda x: x.isNull() | ~F.array_contains(drops, x)), F.lit(0))
        return F.array_position(header, first_kept).cast("int")

    missing = _by_layout(layouts, lambda lay: F.array_except(F.array(*[F.lit(t) for t in lay.required()]), header), lambda lay: tuple(lay.required()))
    return headers.select(*keep, *cols, missing.alias("_missing"), _by_layout(layouts, blank_position, lambda lay: (lay.drop_before_blank_check, lay.dropped)).alias("_p_blank"))


def cell_at(fld: str) -> Column:
    """The field's cell of a grid row, by the position in its file."""
    p = F.col(f"_p_{fld}")
    return F.when(p > 0, F.get("cells", F.greatest(p, F.lit(1)) - 1))


def _cell(fld: str) -> Column:
    return F.col(f"_{fld}")


# ---------------------------------------------------------------------------
# value rules
# ---------------------------------------------------------------------------

def _amount_text(fld: str, layout: StatementLayout) -> Column:
    raw = _cell(fld)
    if layout.strip_amount_chars:
        return C.numeric_text(raw)  # D2, D3
    return C.collapse_ws(raw)  # D4 only


def _number(txt: Column, layout: StatementLayout) -> Column:
    return C.round_half_even_2(C.to_number(txt, digits_only=layout.strip_amount_chars))  # D9, D10


def amount_and_currency(layout: StatementLayout) -> tuple[Column, Column]:
    """(amount, currency) per the layout's amount rule (E-a, E-b)."""
    account_currency = F.col("currency")
    if layout.amount_rule == "dual_currency":
        hnl = _amount_text("amount_hnl", layout)
        usd = _amount_text("amount_usd", layout)
        currency = F.when(hnl.isNull(), F.lit("USD")).otherwise(F.lit("HNL"))
        amount = _number(F.coalesce(hnl, usd), layout)
    elif layout.amount_rule == "debit_credit":
        debits = C.negate(_number(_amount_text("debits", layout), layout))
        credits = _number(_amount_text("credits", layout), layout)
        amount = F.when(debits.isNull() | (debits == 0), credits).otherwise(debits)
        currency = account_currency
    else:
        amount = _number(_amount_text("amount", layout), layout)
        currency = account_currency
    if layout.negate_amount:
        amount = C.negate(amount)
    return amount, currency


def tran_type(layout: StatementLayout, amount: Column) -> Column:
    """E-c / E-d / E-e (a NULL amount counts as not negative)."""
    if layout.type_rule == "expense":
        return F.lit("Expense")
    other = "Transfer" if layout.type_rule == "sign_transfer" else "Income"
    return F.when(amount < 0, F.lit("Expense")).otherwise(F.lit(other))


def date_value(layout: StatementLayout, strict: bool) -> Column:
    if layout.date_to_day:
        # timestamps hold an inner blank: whitespace runs are collapsed
        return C.parse_timestamp_day(C.collapse_ws(_cell("date")), layout.date_format, strict)
    # a valid day-first date has no inner whitespace: stripping equals D4
    return C.parse_date(C.strip_ws(_cell("date")), layout.date_format, strict, stripped=True)


# ---------------------------------------------------------------------------
# the normaliser
# ---------------------------------------------------------------------------

def normalise(grid: DataFrame, files: DataFrame, layout: StatementLayout,
              on_error: str = "raise") -> tuple[DataFrame, DataFrame]:
    """Canonical rows of the files routed to one ``layout``: (rows, rejects);
    ``files`` has (file, account_name, currency)."""
    return _normalise(grid, files.select("file", "account_name", "currency", F.lit(layout.name).alias("layout")), [layout], on_error)


def _normalise(grid: DataFrame, files: DataFrame, layouts, on_error: str) -> tuple[DataFrame, DataFrame]:
    """Canonical rows, and rejects (file, reason), of the files of all
    ``layouts``; ``files``: (file, account_name, currency, layout)."""
    # per-file tables are small (one row per file): broadcast after a size
    # check, so the grid is never shuffled by file (a file may be huge)
    files = checkpointed(files)
    rejects = None
    for lay in layouts:
        if lay.not_implemented:
            r = files.where(F.col("layout") == lay.name).select("file", F.lit(lay.not_implemented).alias("reason"))
            rejects = r if rejects is None else rejects.unionByName(r)
    layouts = [lay for lay in layouts if not lay.not_implemented]
    if not layouts:
        rows = grid.sparkSession.createDataFrame([], ROWS_SQL)
        return rows, rejects if rejects is not None else files.select("file", F.lit("").alias("reason")).limit(0)

    files = files.where(F.col("layout").isin(*[lay.name for lay in layouts]))
    ruled = grid.join(sized_broadcast(files.select("file", "layout")), on="file")
    # the headers of all layouts in one aggregate: the first row that its rule names
    headers = _headers(ruled.where(_by_layout(layouts, lambda lay: lay.header.predicate(), lambda lay: lay.header)), ["layout"])
    headers = files.select("file", "account_name", "currency").join(headers, on="file", how="left")
    pos = checkpointed(header_positions(headers, layouts))
    ok = checkpointed(pos.where(F.col("hdr_row").isNotNull() & (F.size("_missing") == 0)))
    no_header = pos.where(F.col("hdr_row").isNull()).select("file", F.lit("header_not_found").alias("reason"))
    lacking = pos.where(F.col("hdr_row").isNotNull() & (F.size("_missing") > 0)).select(
        "file", F.concat(F.lit("missing_columns: "), F.array_join("_missing", ", ")).alias("reason"))
    own = no_header.unionByName(lacking)
    rejects = own if rejects is None else rejects.unionByName(own)

    data = grid.join(sized_broadcast(ok), on="file").where(F.col("row_no") > F.col("hdr_row"))
    blank_cell = F.get("cells", F.greatest(F.col("_p_blank"), F.lit(1)) - 1)
    data = data.where(~C.is_blank(F.when(F.col("_p_blank") > 0, blank_cell)))  # D1
    # the file's cells by field, whatever its layout
    data = data.select("file", "row_no", "hdr_row", "layout", "account_name", "currency",
                       *[cell_at(fld).alias(f"_{fld}") for fld in fields_of(layouts)])

    strict = lambda lay: lay.date_strict and on_error == "raise"
    # the row-position guard keeps the (possibly raising) strict parse from
    # being pushed below the header join onto header or preamble rows
    below_header = F.col("row_no") > F.col("hdr_row")
    date = _by_layout(layouts, lambda lay: date_value(lay, strict(lay)), lambda lay: (lay.date_format, lay.date_to_day, strict(lay)))
    amount_rule = lambda lay: (lay.amount_rule, lay.strip_amount_chars, lay.negate_amount)
    rejecting = on_error != "raise" and any(lay.date_strict for lay in layouts)
    # rows the strict parse would have failed on
    bad = F.col("layout").isin(*[lay.name for lay in layouts if lay.date_strict]) & ~C.is_blank(_cell("date")) & F.col("date").isNull()
    out = data.select(
        "file", "row_no", "layout", "account_name",
        F.when(below_header, date).alias("date"),
        C.collapse_ws(_cell("description")).alias("description"),  # D4
        _by_layout(layouts, lambda lay: amount_and_currency(lay)[1], amount_rule).alias("currency"),
        _by_layout(layouts, lambda lay: amount_and_currency(lay)[0], amount_rule).alias("amount"),
        *([_cell("date")] if rejecting else []),
    )
    if rejecting:
        # written once, and read for the rows and for the rejects
        out = stored(out.withColumn("bad", bad).drop("_date"), "normalised", "zstd")
        counts = out.where("bad").groupBy("file").agg(F.concat(F.lit("bad_date_rows: "), F.count(F.lit(1)).cast("string")).alias("reason"))
        rejects = rejects.unionByName(counts)
    drops = [lay.name for lay in layouts if lay.drop_null_dates]
    if len(drops) == len(layouts):
        out = out.where(F.col("date").isNotNull())  # D8
    elif drops:
        out = out.where(F.col("date").isNotNull() | ~F.col("layout").isin(*drops))
    out = out.withColumn("tran_type", _by_layout(layouts, lambda lay: tran_type(lay, F.col("amount")), lambda lay: lay.type_rule))
    out = out.withColumn("id", row_id())
    return out.select("file", "row_no", "date", "account_name", "tran_type", "description",
                      "currency", "amount", "id"), rejects


ROWS_SQL = "file string, row_no long, date timestamp_ntz, account_name string, tran_type string, description string, currency string, amount double, id string"


def normalise_all(grid: DataFrame, routed: DataFrame, layouts=LAYOUTS,
                  on_error: str = "raise") -> tuple[DataFrame, DataFrame]:
    """Every routed file through its layout, in one plan.  ``routed`` has
    (file, account_name, currency, bank, account_type)."""
    routed = checkpointed(routed)  # one row per file
    name = None
    for lay in layouts:
        hit = (F.col("bank") == lay.bank) & (F.col("account_type") == lay.account_type)
        name = F.when(hit, lay.name) if name is None else name.when(hit, lay.name)
    named = routed.withColumn("layout", name)
    # the layouts that occur: at most as many names as there are layouts
    present = {r[0] for r in named.select("layout").distinct().collect()}
    found = [lay for lay in layouts if lay.name in present]
    rows, rejects = _normalise(grid, named.where("layout IS NOT NULL").select("file", "account_name", "currency", "layout"), found, on_error)
    unrouted = named.where("layout IS NULL").select(
        "file",
        F.when(F.col("bank").isin(*KNOWN_BANKS), F.lit("account type not supported"))
        .otherwise(F.concat(F.lit("unknown bank: "), F.coalesce("bank", F.lit("")))).alias("reason"),
    )
    return rows, rejects.unionByName(unrouted)


def route(bank: Column, account_type: Column, layouts=LAYOUTS) -> Column:
    """B6/B7 as one expression: the layout name, or the reason a file is
    rejected (unknown bank, unsupported type, not implemented)."""
    expr = (
        F.when(bank.isin(*KNOWN_BANKS), F.lit("reject: account type not supported"))
        .otherwise(F.concat(F.lit("reject: unknown bank: "), F.coalesce(bank, F.lit(""))))
    )
    for lay in reversed(layouts):
        hit = (bank == lay.bank) & (account_type == lay.account_type)
        val = F.lit(f"reject: {lay.not_implemented}") if lay.not_implemented else F.lit(lay.name)
        expr = F.when(hit, val).otherwise(expr)
    return expr
