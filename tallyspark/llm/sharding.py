"""Sharding by global byte-size prefix sums (DataFrame functions only).

Rows are put into one global order by range partitioning on the id.  Each
partition's byte total gives its start offset (a prefix sum over one row per
partition); a running sum inside the partition completes each row's global
offset.  Cutting the offsets at equal targets gives contiguous shards whose
sizes differ by at most one row's size from the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import materialised, shuffle_partitions

#: bytes that a row costs beside its text
ROW_OVERHEAD = 8
COMPUTED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def assign_shards(
    df: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    overhead: int = ROW_OVERHEAD,
) -> DataFrame:
    """Contiguous shards ``0 .. n_shards - 1`` of near-equal bytes.

    Adds ``size`` (UTF-8 bytes of the text plus ``overhead``), ``text_crc32``
    (unsigned), ``law`` (``bytes``), ``shard``, ``slot`` (place inside the
    shard, gapless from 0) and ``grown_shard`` (null under this law).
    ``keep`` names the input columns to carry (default: all).

    A null text counts as empty (size = overhead, crc32 = 0).  Null ids come
    first.  Ties on the id are ordered by checksum, size and scan order, so
    repeated rows get slots of their own.  An empty table gives no row.  Input
    columns named like a computed one are replaced.
    """
    spark = df.sparkSession
    keep = df.columns if keep is None else keep
    data = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    carried = [c for c in keep if c.lower() not in COMPUTED]
    base = df.select(
        *[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(carried)],
        F.col(f"`{id_col}`").alias("_id"),
        (F.octet_length(data) + F.lit(overhead)).cast("long").alias("_size"),
        F.crc32(data).alias("_crc"),
        F.monotonically_increasing_id().alias("_scan"),
    )
    order = ["_id", "_crc", "_size", "_scan"]
    # the table is written so that the partition numbers stay what they are
    ranged = materialised(
        base.repartitionByRange(shuffle_partitions(spark), *order).withColumn("_part", F.spark_partition_id()),
        "shard-order",
    )
    # one row per range partition: a size bound that does not depend on the data
    totals = ranged.groupBy("_part").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(every).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    placed = (
        ranged.withColumn("_run", F.coalesce(F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_nth", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "_part")
        .withColumn("shard", F.expr(f"least(cast((_bytes_before + _run) * {int(n_shards)}L div _total as int), {int(n_shards) - 1})"))
        .withColumn("_row", F.col("_rows_before") + F.col("_nth"))
    )
    # the first row of each shard, from the running sums of the written table
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *[F.col(f"in_{i}").alias(c) for i, c in enumerate(carried)],
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard"),
        (F.col("_row") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
