"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tallyspark.session import scratch_path

# rows of an Arrow batch handed to Python: whole texts may be long, so batches
# are kept far below Spark's default of 10,000 rows
ARROW_ROWS = 1000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Small Arrow batches, unless the session chose a size itself."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) >= 10_000:
        spark.conf.set(key, str(ARROW_ROWS))


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the cluster's shared scratch folder and read
    it back: cuts lineage, fixes row ids, survives lost executors, and later
    readers take only the columns they need."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}-{uuid.uuid4().hex}"
    # nothing reads this query's shuffle files after the write
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialised`` that no later step reads."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; a null text is empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def free_names(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns whose names the operator computes itself."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def in_blocks(rows: list, size_of, max_bytes: int) -> Iterator[list]:
    """Consecutive runs of ``rows`` of about ``max_bytes`` (one row at least)."""
    block, size = [], 0
    for r in rows:
        n = size_of(r)
        if block and size + n > max_bytes:
            yield block
            block, size = [], 0
        block.append(r)
        size += n
    if block:
        yield block


def hot_rows(rows: int, least: int, spark: SparkSession) -> int:
    """Rows of one key from which it is dealt apart: a twentieth of a mean
    partition's, so at most 20 keys a partition are, and ``least``."""
    return max(least, rows // (20 * shuffle_partitions(spark)))
