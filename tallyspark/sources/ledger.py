"""Ledger scan and sink.

The working ledger is a parquet table (columnar, typed, splittable).  The
CSV form of the reference (UTF-8 with BOM, 10 fixed columns, pandas-style
text) is supported for import and export.  A run never overwrites the path
it reads: every run writes a new location.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.clean import blank_to_null, na_tokens_to_null
from tallyspark.functions.identity import amount_text
from tallyspark.schema import LEDGER, LEDGER_COLUMNS, LEDGER_DECLARED, enforce_schema
from tallyspark.sources.csv_text import csv_line

BOM = "﻿"


class FileReadError(IOError):
    pass


def empty_ledger(spark: SparkSession) -> DataFrame:
    """A5: a typed empty ledger (first run)."""
    return spark.createDataFrame([], LEDGER)


def _path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the path's own file system; anything but "not there" raises."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
    except (Py4JJavaError, PySparkException) as e:
        raise FileReadError(f"storage of {path} cannot be reached: {e}") from e


def clean_ledger_text(df: DataFrame) -> DataFrame:
    """G2 text part: missing-value tokens and blank text become NULL."""
    out = []
    for c in df.columns:
        col = na_tokens_to_null(F.col(c).cast("string"))
        out.append(blank_to_null(col).alias(c))
    return df.select(*out)


def read_ledger_csv(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """A4 + G1 + G2: ledger CSV -> typed ledger (id not yet computed).  An
    absent path raises, unless ``missing_ok`` says that this is a first run."""
    if not _path_exists(spark, path):
        if missing_ok:
            return empty_ledger(spark)
        raise FileReadError(f"no ledger CSV at {path}")
    raw = (
        spark.read.option("header", "true").option("multiLine", "true")
        .option("escape", '"').option("inferSchema", "false").csv(path)
    )
    raw = raw.toDF(*[c.lstrip(BOM) for c in raw.columns])
    return enforce_schema(clean_ledger_text(raw), LEDGER_DECLARED)


def read_ledger(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Parquet ledger.  An absent path raises, unless ``missing_ok`` says that
    this is a first run; unreachable storage always raises."""
    if not _path_exists(spark, path):
        if missing_ok:
            return empty_ledger(spark)
        raise FileReadError(f"no ledger at {path}")
    found = spark.read.parquet(path)
    if "ym" not in found.columns:
        return enforce_schema(found, LEDGER_DECLARED)
    # the month partition of write_ledger, by which a merge reads less
    enforce_schema(found.drop("ym"), LEDGER_DECLARED)
    return found.select(*LEDGER_COLUMNS, F.col("ym").cast("string").alias("ym"))


def write_ledger(df: DataFrame, path: str, partition_by_month: bool = False) -> None:
    """Parquet ledger; optionally partitioned by month so later merges read
    only the months a statement touches."""
    w = df.select(*LEDGER_COLUMNS)
    if partition_by_month:
        w = w.withColumn("ym", F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none")))
        w.write.mode("errorifexists").partitionBy("ym").parquet(path)
    else:
        w.write.mode("errorifexists").parquet(path)


def ledger_date_text(col) -> F.Column:
    """CSV text of a ledger date: ``yyyy-MM-dd`` at midnight, else full."""
    c = F.col(col) if isinstance(col, str) else col
    full = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when((F.date_format(c, "HH:mm:ss") == "00:00:00") & (frac == "000000"), F.date_format(c, "yyyy-MM-dd"))
        .when(frac == "000000", full)
        .otherwise(F.concat(full, F.lit("."), frac))
    )


def _csv_texts() -> list[F.Column]:
    """The ledger's columns as the texts of its CSV."""
    cols = []
    for c in LEDGER_COLUMNS:
        if c == "date":
            cols.append(ledger_date_text("date"))
        elif c == "amount":
            cols.append(F.when(F.col("amount").isNull() | F.isnan("amount"), F.lit(None).cast("string")).otherwise(amount_text("amount")))
        else:
            cols.append(F.col(c))
    return cols


def ledger_csv_frame(df: DataFrame) -> DataFrame:
    """Ledger as the text columns written to CSV."""
    names = [BOM + LEDGER_COLUMNS[0], *LEDGER_COLUMNS[1:]]
    return df.select(*[e.alias(c) for e, c in zip(_csv_texts(), names, strict=True)])


def write_ledger_csv(df: DataFrame, path: str) -> None:
    """CSV with a UTF-8 BOM before the header of every part file, pandas
    quoting (only fields with a comma, quote or newline), empty for NULL."""
    (
        ledger_csv_frame(df).write.mode("errorifexists")
        .option("header", "true").option("escape", '"').option("quote", '"')
        .option("emptyValue", "").option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_ledger_export(df: DataFrame, path: str) -> None:
    """G8 + A6: one CSV in parts.  Rows are ordered by date, newest first, and
    rows of a date by their line.  The parts, in the order of their names, are
    the file: BOM and header in the first one only."""
    rows = df.select(F.lit(1).alias("k"), F.col("date"), csv_line(_csv_texts()).alias("line"))
    head = df.sparkSession.range(1).select(
        F.lit(0).alias("k"), F.lit(None).cast("timestamp_ntz").alias("date"), F.lit(BOM + ",".join(LEDGER_COLUMNS)).alias("line"))
    # range partitions over the whole key: a date of very many rows is cut too
    ordered = head.unionByName(rows).orderBy("k", F.desc_nulls_last("date"), "line")
    ordered.select("line").write.mode("errorifexists").text(path)


def validate_output_path(spark: SparkSession, path: str) -> str:
    """The folder that is to hold the ledger must be there, on whatever
    storage it is."""
    parent = path.rstrip("/").rpartition("/")[0]
    if parent and not _path_exists(spark, parent):
        raise ValueError(f"output folder {parent} is missing")
    return path
