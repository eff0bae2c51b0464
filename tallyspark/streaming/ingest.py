"""Incremental drop-folder ingest with Structured Streaming.

``readStream`` over the statement folder (file source: every new file is
picked up exactly once per checkpoint) carries file names only;
``foreachBatch`` runs the batch job's scan on the files of the micro-batch,
merges them into the months of ledger version ``batch_id`` that they touch,
and writes those as version ``batch_id + 1``, with the batch's rejects.  A
version is there once its manifest is: a replayed batch that had finished is
left as it is, one that had not is written again from the same input (the
file source's checkpoint replays the batch boundaries unchanged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.merge import normalise_ledger
from tallyspark.plans.pipeline import load_statements
from tallyspark.schema import LEDGER_COLUMNS
from tallyspark.session import ensure_session_defaults
from tallyspark.sources.grid import decoded, literal_paths
from tallyspark.sources.ledger import empty_ledger
from tallyspark.sources.versions import merge_into, open_version, versions, write_version

# files of one micro-batch: their names go through the driver
MAX_FILES = 10_000


def rejects_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_rejects/version={version:09d}"


def _stream_files(spark: SparkSession, in_dir: str, max_files: int,
                  glob: str = "*.csv", recursive: bool = False, clean_source: str | None = None,
                  archive_dir: str | None = None):
    r = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
    )
    r = r.option("maxFilesPerTrigger", str(max_files))
    if clean_source:
        # A9 for the stream: the source archives / deletes a file once a
        # later batch has committed (the last file stays until then)
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return r.load(in_dir).select(decoded(F.col("_metadata.file_path")).alias("file"))


def start_ingest(spark: SparkSession, in_dir: str, ledger_root: str, accounts: DataFrame,
                 checkpoint: str | None = None, initial_ledger: DataFrame | None = None,
                 threshold: float = 0.8,
                 max_files_per_trigger: int = MAX_FILES, available_now: bool = True,
                 on_error: str = "reject", glob: str = "*.csv", recursive: bool = False,
                 mode: str = "reference", clean_source: str | None = None,
                 archive_dir: str | None = None):
    """Start the ingest query; returns the StreamingQuery.  ``rejects_path``
    has the rejects (file, reason) of the batch that wrote a version."""
    ensure_session_defaults(spark)
    accounts = accounts.cache()
    if checkpoint is None:
        checkpoint = ledger_root.rstrip("/") + "/_stream"  # a restart finds it again

    if not versions(spark, ledger_root):
        first = initial_ledger if initial_ledger is not None else empty_ledger(spark)
        write_version(spark, ledger_root, 0, normalise_ledger(first))

    def merge_micro_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id + 1 in versions(spark, ledger_root):
            return
        files = [r[0] for r in batch.collect()]  # file names only, never rows
        stmts, rejects = load_statements(spark, literal_paths(files), accounts, on_error, glob=None)
        # before the version: a version that is there has its rejects
        rejects.write.mode("overwrite").parquet(rejects_path(ledger_root, batch_id + 1))
        merge_into(spark, ledger_root, batch_id + 1, stmts, threshold, mode)

    src = _stream_files(spark, in_dir, max_files_per_trigger, glob, recursive, clean_source, archive_dir)
    w = src.writeStream \
        .foreachBatch(merge_micro_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def latest_version(spark: SparkSession, ledger_root: str, query=None) -> DataFrame:
    """The newest committed ledger version under ``ledger_root``."""
    return open_version(spark, ledger_root).read(spark).select(*LEDGER_COLUMNS)
