"""The batch job: statement folder + ledger -> new ledger (one lazy plan).

    GRID scan -> identify (pattern join) -> one projection for all layouts
    -> id -> merge_batch -> write new ledger -> delete inputs

Actions happen only at the checkpoints named in the operators, at the sink
and for the metrics.  Inputs are deleted only after the new ledger is
committed (the reference deletes first and may lose data), and a crash in
between is made good by the next run (``plans.consume``).
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.identify import identify
from tallyspark.operators.layouts import LAYOUTS, normalise_all
from tallyspark.operators.merge import MergeResult, merge_batch
from tallyspark.session import ensure_session_defaults
from tallyspark.sources.accounts import screen_patterns
from tallyspark.operators.common import stored
from tallyspark.sources.grid import scan_folder
from tallyspark.plans.consume import consume
from tallyspark.sources.ledger import validate_output_path, write_ledger, write_ledger_csv

FATAL_REASONS = ("missing_columns", "header_not_found", *(lay.not_implemented for lay in LAYOUTS if lay.not_implemented))


class StatementError(ValueError):
    pass


@dataclass
class BatchResult:
    merge: MergeResult
    statements: DataFrame
    rejects: DataFrame


def load_statements(spark: SparkSession, in_dir: str | list[str], accounts: DataFrame,
                    on_error: str = "raise", num_chars: int = 400, layouts=LAYOUTS,
                    glob: str | None = "*.csv") -> tuple[DataFrame, DataFrame]:
    """Canonical rows of every identified file, with
    ``stmt_seq`` = file path (statement order), and rejects (file, reason)."""
    ensure_session_defaults(spark)
    accounts, bad_patterns = screen_patterns(accounts)
    if bad_patterns:
        warnings.warn(f"accounts left out, their id_pattern does not compile: {', '.join(bad_patterns)}", stacklevel=2)
    grid, rej_scan = scan_folder(spark, in_dir, glob)
    grid = stored(grid, "grid")
    routed, rej_id = identify(grid, accounts, num_chars)
    rows, rej_norm = normalise_all(grid, routed, layouts, on_error)
    rejects = rej_scan.unionByName(rej_id).unionByName(rej_norm)
    if on_error == "raise":
        fatal = rej_norm.where(F.exists(F.array(*[F.lit(r) for r in FATAL_REASONS]),
                                        lambda r: F.col("reason").startswith(r)))
        bad = fatal.collect()  # reject list: one row per failing file
        if bad:
            raise StatementError("; ".join(f"{r.file}: {r.reason}" for r in bad))
    stmts = rows.withColumn("stmt_seq", F.col("file"))
    return stmts, rejects


def run_batch(spark: SparkSession, in_dir: str | list[str], ledger: DataFrame, accounts: DataFrame,
              out_path: str | None = None, threshold: float = 0.8, on_error: str = "raise",
              out_format: str = "parquet", delete_inputs: bool = False,
              glob: str | None = "*.csv", mode: str = "reference", num_chars: int = 400,
              layouts=LAYOUTS, trust_ledger_ids: bool = False) -> BatchResult:
    if out_path:
        validate_output_path(spark, out_path)  # before any work is done
    stmts, rejects = load_statements(spark, in_dir, accounts, on_error, num_chars, layouts, glob)
    res = merge_batch(ledger, stmts, threshold, mode=mode, trust_ledger_ids=trust_ledger_ids)
    if out_path:
        write = write_ledger_csv if out_format == "csv" else write_ledger
        if delete_inputs:
            files = [r[0] for r in stmts.select("file").distinct().collect()]  # file names only
            consume(spark, consume_log(out_path), files, f"{out_path.rstrip('/')}/_SUCCESS", lambda: write(res.ledger, out_path))
        else:
            write(res.ledger, out_path)
    return BatchResult(merge=res, statements=stmts, rejects=rejects)


def consume_log(out_path: str) -> str:
    """Where the intents to delete inputs are kept: beside the ledger."""
    return out_path.rstrip("/").rpartition("/")[0] + "/_consume"
