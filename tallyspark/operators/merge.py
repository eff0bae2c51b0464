"""Incremental ledger merge.

Semantics reproduced (per statement, in statement order):

1. every ledger row whose ``(date, amount, account_name)`` equals a new row's
   and whose description differs but is similar (ratio >= threshold) takes
   that new row's description; the last matching new row wins; matching
   always looks at the ledger as it was before this statement;
2. ids of the ledger are recomputed;
3. new rows whose id is not in the ledger are appended (duplicates inside
   the statement all survive).

Spark plan
----------
Blocks ``(date, amount, account_name)`` never interact, so the statement
fold runs per block:

* blocks touched by one statement, and blocks with one distinct text, need no
  fold: one pass (texts joined as arrays on the block key plus a length band,
  all pairs of a batch compared at once, ``max_by`` for last-writer-wins,
  id-based anti-join);
* *contested* blocks (>= 2 statements and >= 2 distinct texts) are folded in
  rounds: round ``r`` takes the ``r``-th statement of every block at once,
  with the same native pass.  Rows of equal id and text move together, so the
  state of a round is a table of distinct texts, written in the shared folder;
  a block leaves it after its last statement.

Both give the same two small tables, re-descriptions by ledger id and the
statement rows that enter, so the big ledger is read twice, for the touched
rows and for the output.  It is only ever the probe side of joins against
statement-sized tables; it is scanned, never shuffled on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.identity import amount_text, id_of_texts, row_id
from tallyspark.functions.similarity import (
    DEFAULT_THRESHOLD,
    character_groups,
    length_band,
    length_bound,
    matches_of,
)
from tallyspark.schema import LEDGER, LEDGER_COLUMNS
from tallyspark.operators.common import size_of, sized_broadcast, stored

KEYS = ["date", "amount", "account_name"]


@dataclass
class MergeResult:
    ledger: DataFrame  # LEDGER columns: updated ledger plus appended rows
    added: DataFrame  # appended statement rows (LEDGER columns + file, stmt_seq, row_no)
    updates: DataFrame  # (old_id, new_description): re-descriptions of ledger rows
    metrics: DataFrame  # per file: parsed, merged, added


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------

def _checkpoint(df: DataFrame) -> DataFrame:
    """A table of the merge, packed by column; its shuffle files go."""
    return stored(df, "merge", "zstd")


def _nan_to_null(df: DataFrame) -> DataFrame:
    """pandas never matches NaN in ``==``; SQL NULL gives the same, NaN not."""
    return df.withColumn("amount", F.when(F.isnan("amount"), F.lit(None).cast("double")).otherwise(F.col("amount")))


NO_MONTH = "none"


def month_of(date: Column | str = "date") -> Column:
    """The month partition of a row: rows without a date are one of their own."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


def _keys_not_null():
    return F.col("date").isNotNull() & F.col("amount").isNotNull() & F.col("account_name").isNotNull()


def normalise_ledger(ledger: DataFrame, trust_ids: bool = False) -> DataFrame:
    """Ledger in canonical column order with a fresh id (F1).

    ``trust_ids``: keep stored ids (a parquet ledger written by this engine
    always stores the id of its content) and hash only rows without one;
    this skips re-hashing the whole ledger on every run."""
    led = ledger
    for c in LEDGER_COLUMNS:
        if c not in led.columns:
            led = led.withColumn(c, F.lit(None).cast(LEDGER[c].dataType))
    led = _nan_to_null(led.select(*LEDGER_COLUMNS))
    if trust_ids:
        return led.withColumn("id", F.coalesce(F.col("id"), row_id()))
    return led.withColumn("id", row_id())


def prepare_statements(stmts: DataFrame, order_col: str = "stmt_seq") -> DataFrame:
    """Canonical rows with the columns the merge needs."""
    df = stmts
    if "file" not in df.columns:
        df = df.withColumn("file", F.lit(None).cast("string"))
    if order_col not in df.columns:
        df = df.withColumn(order_col, F.lit(0).cast("long"))
    if "row_no" not in df.columns:
        raise ValueError("statement rows need a row_no column (file order)")
    for c in ("tran_type", "currency"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = _nan_to_null(df)
    if "id" not in df.columns:
        df = df.withColumn("id", row_id())
    return df.select(
        "file", F.col(order_col).alias("stmt_seq"), "row_no", "date", "account_name",
        "tran_type", "description", "currency", "amount", "id",
    )


def _to_ledger_rows(stmt_rows: DataFrame) -> DataFrame:
    return stmt_rows.select(
        "date", "account_name", "tran_type",
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("tag"),
        "description",
        F.lit(None).cast("string").alias("notes"),
        "currency", "amount", "id",
    )


def _added_rows(stmt_rows: DataFrame) -> DataFrame:
    """Appended statement rows: ledger columns plus their origin."""
    led = _to_ledger_rows(stmt_rows).columns
    return stmt_rows.select(
        *[c if c in stmt_rows.columns else F.lit(None).cast("string").alias(c) for c in led],
        "file", F.col("stmt_seq").cast("string").alias("stmt_seq"), "row_no",
    )


def _ledger_texts(ledger: DataFrame) -> DataFrame:
    """Distinct (block, id, description) of the ledger with their row count."""
    return (
        ledger.where(_keys_not_null() & F.col("description").isNotNull())
        .groupBy(*KEYS, "id", "description")
        .agg(F.count(F.lit(1)).alias("l_n"))
        .withColumnRenamed("id", "l_id")
        .withColumnRenamed("description", "l_desc")
    )


def _new_texts(stmts: DataFrame) -> DataFrame:
    """Distinct (block, description) of statement rows, with the position
    of the last row holding it (last writer wins) and their count."""
    return (
        stmts.where(_keys_not_null() & F.col("description").isNotNull())
        .groupBy(*KEYS, F.col("description").alias("n_desc"))
        .agg(
            F.max(F.struct("stmt_seq", "row_no")).alias("n_last"),
            F.count(F.lit(1)).alias("n_cnt"),
            F.max("file").alias("n_file"),
        )
    )


def candidate_pairs(left: DataFrame, right: DataFrame, left_text: str, right_text: str,
                    threshold: float) -> DataFrame:
    """Pairs in the same block whose texts differ and pass the exact length
    bound.  The block key plus a geometric length band is the equi-join
    key, so texts of incompatible lengths are never paired."""
    lft = left.withColumn("_la", F.length(left_text)).withColumn("_ga", character_groups(F.col(left_text)))
    lft = lft.withColumn("_band", length_band(F.col("_la"), threshold))
    rgt = right.withColumn("_lb", F.length(right_text)).withColumn("_gb", character_groups(F.col(right_text)))
    b = length_band(F.col("_lb"), threshold)
    rgt = rgt.withColumn("_band", F.explode(F.array(b - 1, b, b + 1)))
    return (
        lft.join(rgt, on=KEYS + ["_band"], how="inner")
        .where((F.col(left_text) != F.col(right_text)) & length_bound(F.col("_la"), F.col("_lb"), threshold))
        .drop("_band")
    )


# texts of a block that are compared with as many at once
CHUNK = 256


def _packed(texts: DataFrame, text: str, value: Column, name: str) -> DataFrame:
    """The texts of a block and length band as arrays of at most ``CHUNK``."""
    w = Window.partitionBy(*KEYS, "_band").orderBy(text)
    chunk = F.floor((F.row_number().over(w) - 1) / CHUNK)
    return texts.withColumn("_chunk", chunk).groupBy(*KEYS, "_band", F.col("_chunk").alias(f"_{name}_chunk")) \
        .agg(F.sort_array(F.collect_list(value)).alias(f"_{name}"))


def similar_matches(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Per ``l_desc`` of a block the ``n_desc`` of the same block that
    differ and reach the threshold: the last of them (``n_last``), its text
    (``new_desc``) and file (``last_file``), the greatest file (``n_file``),
    and their rows (``n_cnt``); in parts, to be aggregated.  ``left``:
    (block, l_desc); ``right``: (block, n_desc, n_last, n_cnt, n_file).

    As in ``candidate_pairs`` texts of incompatible length never meet; those
    that do are compared as arrays, every pair of a block in one row of at
    most ``CHUNK`` x ``CHUNK``, dealt evenly."""
    left = left.withColumn("_band", length_band(F.length("l_desc"), threshold))
    b = length_band(F.length("n_desc"), threshold)
    right = right.withColumn("_band", F.explode(F.array(b - 1, b, b + 1)))
    lft = _packed(left, "l_desc", F.col("l_desc"), "l")
    rgt = _packed(right, "n_desc", F.struct("n_last", "n_desc", "n_cnt", "n_file"), "r")
    rows = lft.join(rgt, on=KEYS + ["_band"]).withColumn("_r_desc", F.col("_r.n_desc"))
    # a text alone with itself has no partner
    rows = rows.where((F.size("_l") > 1) | (F.size("_r") > 1) | (F.col("_l") != F.col("_r_desc")))
    # the work of a row is in its pairs, not in its bytes
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, *KEYS, "_band", "_l_chunk", "_r_chunk")
    found = rows.withColumn("_m", F.explode(matches_of("_l", "_r_desc", "_r.n_cnt", "_r.n_file", F.lit(float(threshold)))))
    last = F.get("_r", F.col("_m.last"))
    return found.select(
        *KEYS, F.get("_l", F.col("_m.i")).alias("l_desc"), last["n_desc"].alias("new_desc"), last["n_last"].alias("n_last"),
        last["n_file"].alias("last_file"), F.get("_r", F.col("_m.label"))["n_file"].alias("n_file"), F.col("_m.n").alias("n_cnt"))


def touched_ledger(ledger: DataFrame, stmts: DataFrame, n_bytes: int | None = None) -> DataFrame:
    """Ledger rows the statements can affect: rows in the statements' blocks
    (semi join against the broadcast block keys, checked size) plus rows
    with a missing key part (their ids can still equal a statement id).
    Materialised: it is the small working set of the merge."""
    blocks = stmts.where(_keys_not_null()).select(*KEYS).distinct()  # within the statements' bytes
    in_blocks = ledger.join(sized_broadcast(blocks, bound=n_bytes), on=KEYS, how="left_semi")
    null_keys = ledger.where(~_keys_not_null())
    return stored(in_blocks.unionByName(null_keys), "touched", "zstd")


MODES = ("reference", "protect_exact")


def _without_exact(lt: DataFrame, nt: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """``mode="protect_exact"``: texts that both sides of a block have take
    no part in re-description."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "reference":
        return lt, nt
    same = lt.select(*KEYS, F.col("l_desc").alias("t")).join(
        nt.select(*KEYS, F.col("n_desc").alias("t")), on=KEYS + ["t"], how="left_semi")
    return (lt.join(same.withColumnRenamed("t", "l_desc"), on=KEYS + ["l_desc"], how="left_anti"),
            nt.join(same.withColumnRenamed("t", "n_desc"), on=KEYS + ["n_desc"], how="left_anti"))


def fuzzy_updates(touched: DataFrame, stmts: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                  mode: str = "reference") -> DataFrame:
    """One row per re-described ledger id: (l_id, new_desc, merged,
    n_file).  ``merged`` counts matched (ledger row, new row) pairs.
    ``touched``: the ledger rows of the statements' blocks.

    ``mode="protect_exact"``: a ledger text that the statement repeats
    exactly, and a statement text already in the ledger, take no part in
    re-description (two real, similar transactions of one day and amount
    then keep their own descriptions)."""
    lt, nt = _without_exact(_ledger_texts(touched), _new_texts(stmts), mode)
    # texts of equal characters and other missing values may have several ids
    pairs = similar_matches(lt.select(*KEYS, "l_desc").distinct(), nt, threshold).drop("n_file").join(lt, on=KEYS + ["l_desc"])
    return pairs.groupBy("l_id").agg(
        F.max_by("new_desc", "n_last").alias("new_desc"),
        F.sum(F.col("l_n") * F.col("n_cnt")).alias("merged"),
        F.max_by("last_file", "n_last").alias("n_file"),
    )


def apply_updates(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """G6 + F2: new description for every ledger row with an updated id,
    then the id is recomputed for those rows only."""
    upd = updates.select(F.col("l_id").alias("id"), "new_desc")
    j = ledger.join(sized_broadcast(upd), on="id", how="left")
    desc = F.coalesce(F.col("new_desc"), F.col("description"))
    out = j.withColumn("description", desc).withColumn(
        "id", F.when(F.col("new_desc").isNotNull(), row_id()).otherwise(F.col("id"))
    )
    return out.select(*LEDGER_COLUMNS)


def first_statement_rows(stmts: DataFrame, n_bytes: int | None = None) -> DataFrame:
    """An id enters with the first statement holding it; all duplicates of
    that statement stay.  A map-side-combined aggregate per id, broadcast
    back behind the statement-count bound: no window, no hot-id task."""
    first = stmts.groupBy("id").agg(F.min("stmt_seq").alias("_first"))  # within the statements' bytes
    first = sized_broadcast(first, bound=n_bytes)
    return stmts.join(first, on="id").where(F.col("stmt_seq") == F.col("_first")).drop("_first")


def new_rows(ledger_ids: DataFrame, stmts: DataFrame, n_bytes: int | None = None) -> DataFrame:
    """Statement rows whose id is not in the ledger.

    The ledger is reduced to the ids the statements carry first (semi join,
    statement side is the small build side), so the anti join never
    shuffles the whole ledger."""
    ids = stmts.select("id").distinct()  # within the statements' bytes
    present = ledger_ids.select("id").join(sized_broadcast(ids, bound=n_bytes), on="id", how="left_semi")
    return stmts.join(present, on="id", how="left_anti")


# ---------------------------------------------------------------------------
# fold of contested blocks
# ---------------------------------------------------------------------------

_NODE = ["date", "amount", "account_name", "origin", "added_by", "id", "description", "amount_txt", "n"]


def _ranked(stmts: DataFrame) -> DataFrame:
    """Distinct (block, statement, id, description) of statement rows with
    the statement's dense rank in its block, the last row holding the text,
    the number of rows and the file."""
    texts = stmts.withColumn("amount_txt", amount_text("amount")).groupBy(*KEYS, "stmt_seq", "id", "description", "amount_txt").agg(
        F.max("row_no").alias("n_last"), F.count(F.lit(1)).alias("n_cnt"), F.max("file").alias("n_file"))
    # ranks of the block's statements, not of its rows: one row per statement
    seqs = stmts.select(*KEYS, "stmt_seq").distinct()
    block = Window.partitionBy(*KEYS)
    seqs = seqs.withColumn("rank", F.row_number().over(block.orderBy("stmt_seq"))) \
        .withColumn("n_ranks", F.count(F.lit(1)).over(block))
    return texts.join(sized_broadcast(seqs), on=KEYS + ["stmt_seq"])


def fold_rounds(touched: DataFrame, stmts: DataFrame, threshold: float,
                mode: str = "reference") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fold of contested blocks.  ``touched`` and ``stmts`` hold the ledger
    and statement rows of those blocks.  Returns

    * (l_id, new_desc): ledger rows whose text ends up another one;
    * the statement rows that enter, with their final description and id;
    * (n_file, merged): matched (ledger row, statement row) pairs per file.
    """
    turns = _checkpoint(_ranked(stmts))
    rounds = turns.agg(F.max("n_ranks")).first()[0] or 0
    ledger_ids = touched.withColumn("amount_txt", amount_text("amount")).groupBy(*KEYS, "id", "description", "amount_txt").agg(
        F.count(F.lit(1)).alias("n"))
    seq_type = stmts.schema["stmt_seq"].dataType
    ends = sized_broadcast(turns.select(*KEYS, "n_ranks").distinct())
    state = _checkpoint(ledger_ids.withColumn("origin", F.col("id")).withColumn("added_by", F.lit(None).cast(seq_type)).select(*_NODE))
    done, pairs_of = [], []
    for r in range(1, rounds + 1):
        now = turns.where(F.col("rank") == r)
        old = state.where(F.col("description").isNotNull())
        new = now.where(F.col("description").isNotNull())
        lft = old.groupBy(*KEYS, F.col("description").alias("l_desc")).agg(F.sum("n").alias("l_n"))
        rgt = new.groupBy(*KEYS, F.col("description").alias("n_desc")).agg(
            F.max("n_last").alias("n_last"), F.sum("n_cnt").alias("n_cnt"), F.max("n_file").alias("n_file"))
        lft, rgt = _without_exact(lft, rgt, mode)
        found = similar_matches(lft.select(*KEYS, "l_desc"), rgt, threshold).groupBy(*KEYS, "l_desc").agg(
            F.max_by("new_desc", "n_last").alias("new_desc"), F.max("n_file").alias("n_file"), F.sum("n_cnt").alias("n_cnt"))
        moved = _checkpoint(found.join(lft, on=KEYS + ["l_desc"]).withColumn("merged", F.col("l_n") * F.col("n_cnt")).drop("l_n", "n_cnt"))
        pairs_of.append(moved.select("n_file", "merged"))
        # a null text never moves: plain equality leaves it out
        after = state.join(moved.select(*KEYS, F.col("l_desc").alias("description"), "new_desc"), on=KEYS + ["description"], how="left")
        text = F.coalesce("new_desc", "description")
        after = after.withColumn("id", F.when(F.col("new_desc").isNotNull(), id_of_texts("date", text, "amount_txt", "account_name")).otherwise(F.col("id")))
        after = after.withColumn("description", text).select(*_NODE)
        enter = now.join(after.select(*KEYS, "id").distinct(), on=KEYS + ["id"], how="left_anti").select(
            *KEYS, F.col("id").alias("origin"), F.col("stmt_seq").alias("added_by"), "id", "description", "amount_txt", F.col("n_cnt").alias("n"))
        state = _checkpoint(after.unionByName(enter).join(ends, on=KEYS).withColumn("open", F.col("n_ranks") > r).drop("n_ranks"))
        done.append(state.where(~F.col("open")).select(*_NODE))
        state = state.where("open").select(*_NODE)
    nodes = done[0]
    for d in done[1:]:
        nodes = nodes.unionByName(d)
    merged = pairs_of[0]
    for m in pairs_of[1:]:
        merged = merged.unionByName(m)
    changed = nodes.where(F.col("added_by").isNull() & (F.col("id") != F.col("origin"))).select(
        F.col("origin").alias("l_id"), F.col("description").alias("new_desc"))
    final = nodes.where(F.col("added_by").isNotNull()).select(
        *KEYS, F.col("origin").alias("id"), F.col("added_by").alias("stmt_seq"), F.col("id").alias("new_id"), F.col("description").alias("new_desc"))
    entered = stmts.join(final, on=KEYS + ["id", "stmt_seq"]).withColumn("description", F.col("new_desc")) \
        .withColumn("id", F.col("new_id")).select(*stmts.columns)
    return changed, entered, merged.groupBy("n_file").agg(F.sum("merged").alias("merged"))


# ---------------------------------------------------------------------------
# public entry points
# ---------------------------------------------------------------------------

def mixed_blocks(touched: DataFrame, stmts: DataFrame) -> DataFrame:
    """Blocks of the statements with >= 2 distinct texts among their ledger
    and statement rows; in the others no re-description can happen.
    ``contested``: >= 2 statements, the sequential fold is needed (with one
    statement it is a single step).  One aggregate by text, one by block, no
    pairwise comparison."""
    keyed = lambda df, seq: df.where(_keys_not_null()).select(*KEYS, "description", seq.alias("seq"))
    texts = keyed(stmts, F.col("stmt_seq")).unionByName(keyed(touched, F.lit(None).cast(stmts.schema["stmt_seq"].dataType)))
    texts = texts.groupBy(*KEYS, "description").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    blocks = texts.groupBy(*KEYS).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.count("description").alias("n_txt"))
    return blocks.where(F.col("n_txt") >= 2).select(*KEYS, F.coalesce(F.col("first") < F.col("last"), F.lit(False)).alias("contested"))


def merge_batch(
    ledger: DataFrame,
    stmts: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    order_col: str = "stmt_seq",
    single_statement: bool = False,
    mode: str = "reference",
    trust_ledger_ids: bool = False,
) -> MergeResult:
    """Merge statements (in ``order_col`` order) into the ledger.  Where
    the ledger has its month partition ``ym``, only the statements' months are
    read for the merge, and all for the output."""
    partitioned = ledger if "ym" in ledger.columns else None
    ledger = normalise_ledger(ledger, trust_ledger_ids)
    # statements are the new (small) side and are used by every step below:
    # materialise them once in the shared checkpoint folder, packed by column
    stmts = stored(prepare_statements(stmts, order_col), "statements", "zstd")
    n_bytes = size_of(stmts)  # bounds every table of statement keys and ids below
    slice_ = ledger
    if partitioned is not None:
        # the id begins with the date: a row of another month is never equal
        months = [r[0] for r in stmts.select(month_of().alias("ym")).distinct().collect()]
        slice_ = normalise_ledger(partitioned.where(F.coalesce("ym", F.lit(NO_MONTH)).isin(*months)), trust_ledger_ids) if months else ledger.limit(0)
    touched = touched_ledger(slice_, stmts, n_bytes)  # all later steps read this, not the ledger
    if not single_statement:
        # one statement in the batch: no fold is possible (tiny aggregate)
        single_statement = (stmts.agg(F.countDistinct("stmt_seq")).first()[0] or 0) <= 1
    plain, plain_touched, fold = stmts, touched, None
    near, near_touched = plain, plain_touched
    if not single_statement:
        mixed = _checkpoint(mixed_blocks(touched, stmts))
        # small beside the rows: these are not shuffled to find those of a block
        contested = sized_broadcast(mixed.where("contested").select(*KEYS))
        # texts that meet another one
        others = sized_broadcast(mixed.where(~F.col("contested")).select(*KEYS))
        near, near_touched = (df.join(others, on=KEYS, how="left_semi") for df in (stmts, touched))
        if not contested.isEmpty():
            plain = stmts.join(contested, on=KEYS, how="left_anti")
            plain_touched = touched.join(contested, on=KEYS, how="left_anti")
            fold = fold_rounds(touched.join(contested, on=KEYS, how="left_semi"),
                               stmts.join(contested, on=KEYS, how="left_semi"), threshold, mode)

    updates = _checkpoint(fuzzy_updates(near_touched, near, threshold, mode))
    cand = plain if single_statement else first_statement_rows(plain, n_bytes)
    added = new_rows(apply_updates(plain_touched, updates), cand, n_bytes)
    merged = updates.select("n_file", "merged")
    changed = updates.select("l_id", "new_desc")
    if fold is not None:
        changed = _checkpoint(changed.unionByName(fold[0]))
        added = added.unionByName(_checkpoint(fold[1]))
        merged = merged.unionByName(fold[2])
    added_rows = _added_rows(added)
    return MergeResult(
        ledger=apply_updates(ledger, changed).unionByName(_to_ledger_rows(added)),
        added=added_rows,
        updates=changed.select(F.col("l_id").alias("old_id"), F.col("new_desc").alias("new_description")),
        metrics=run_metrics(stmts, merged, added_rows),
    )


def merge_statement(ledger: DataFrame, stmt: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                    mode: str = "reference") -> MergeResult:
    """G3-G9 for one statement."""
    return merge_batch(ledger, stmt, threshold, single_statement=True, mode=mode)


def run_metrics(stmts: DataFrame, upd_pairs: DataFrame, added_rows: DataFrame) -> DataFrame:
    """Per file rows parsed, matched pairs re-described, rows added."""
    parsed = stmts.groupBy("file").agg(F.count(F.lit(1)).alias("parsed"))
    merged = upd_pairs.groupBy(F.col("n_file").alias("m_file")).agg(F.sum("merged").alias("merged"))
    added = added_rows.groupBy(F.col("file").alias("a_file")).agg(F.count(F.lit(1)).alias("added"))
    return (
        parsed.join(merged, parsed["file"].eqNullSafe(merged["m_file"]), "left")
        .join(added, parsed["file"].eqNullSafe(added["a_file"]), "left")
        .select(
            parsed["file"],
            F.col("parsed").cast("long").alias("parsed"),
            F.coalesce(F.col("merged"), F.lit(0)).cast("long").alias("merged"),
            F.coalesce(F.col("added"), F.lit(0)).cast("long").alias("added"),
        )
    )
