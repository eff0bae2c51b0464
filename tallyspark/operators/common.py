"""Execution helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir, scratch_path

# Small-side tables are broadcast up to this size, as Spark would hold it.
BROADCAST_BYTES = 48 << 20
# bytes of a row besides its texts and arrays
ROW_BYTES = 16
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, cuts lineage, fixes non-deterministic ids)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as Parquet in the shared scratch folder: like ``checkpointed``,
    and later reads take only the columns and row groups they need."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    # nothing reads this query's shuffle files after the write
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _bytes(df: DataFrame):
    """Upper estimate of a row's bytes in memory."""
    out = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary"):
            out = out + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif kind in ("array", "map", "struct"):
            out = out + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 2
        else:
            out = out + 8
    return out


def size_of(df: DataFrame) -> int:
    """Bytes of ``df`` in memory, texts included (an upper estimate); reads
    it once, so callers pass materialised or cheap tables."""
    return df.agg(F.sum(_bytes(df).cast("long"))).first()[0] or 0


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES, bound: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its bytes are within ``limit``; otherwise
    leave the join to a shuffle, which AQE may still split.  ``bound``: a
    proven upper bound of the bytes (that of the table ``df`` is taken from);
    without it ``df`` is measured."""
    size = bound if bound is not None else size_of(df)
    return F.broadcast(df) if size <= limit else df
