"""Schemas of the engine and the ledger schema check (G1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ledger columns in output order, and their declared types.
LEDGER_COLUMNS = (
    "date", "account_name", "tran_type", "category", "tag",
    "description", "notes", "currency", "amount", "id",
)
LEDGER_DECLARED = {
    "date": "datetime64[ns]",
    "account_name": "string",
    "tran_type": "string",
    "category": "string",
    "tag": "string",
    "description": "string",
    "notes": "string",
    "currency": "string",
    "amount": "float64",
    "id": "string",
}

_SPARK_TYPE = {
    "datetime64[ns]": T.TimestampNTZType(),
    "float64": T.DoubleType(),
    "int64": T.LongType(),
    "string": T.StringType(),
    "object": T.StringType(),
}

LEDGER = T.StructType([T.StructField(c, _SPARK_TYPE[LEDGER_DECLARED[c]], True) for c in LEDGER_COLUMNS])

CANONICAL = T.StructType(
    [
        T.StructField("file", T.StringType(), True),
        T.StructField("stmt_seq", T.LongType(), True),
        T.StructField("row_no", T.LongType(), True),
        T.StructField("date", T.TimestampNTZType(), True),
        T.StructField("account_name", T.StringType(), True),
        T.StructField("tran_type", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("currency", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("id", T.StringType(), True),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("account_name", T.StringType(), False),
        T.StructField("currency", T.StringType(), True),
        T.StructField("bank", T.StringType(), True),
        T.StructField("account_type", T.StringType(), True),
        T.StructField("id_pattern", T.StringType(), True),
    ]
)

GRID = T.StructType(
    [
        T.StructField("file", T.StringType(), False),
        T.StructField("row_no", T.LongType(), False),
        T.StructField("cells", T.ArrayType(T.StringType()), False),
    ]
)


class SchemaError(ValueError):
    pass


def enforce_schema(df: DataFrame, declared: dict[str, str] | None = None) -> DataFrame:
    """G1: missing or extra columns raise; every column is cast to its
    declared type; an unsupported declared type raises.  The name checks
    are metadata only (no job)."""
    declared = dict(declared or LEDGER_DECLARED)
    missing = [c for c in declared if c not in df.columns]
    if missing:
        raise SchemaError(f"ledger has missing columns: {missing}")
    extra = [c for c in df.columns if c not in declared]
    if extra:
        raise SchemaError(f"ledger has extra columns: {extra}")
    bad = [t for t in declared.values() if t not in _SPARK_TYPE]
    if bad:
        raise SchemaError(f"unsupported data type: {bad[0]}")
    dtypes = dict(df.dtypes)
    out = []
    for col, typ in declared.items():
        c = F.col(col)
        if typ == "datetime64[ns]":
            if dtypes[col].startswith("timestamp") or dtypes[col] == "date":
                e = c.cast("timestamp_ntz")
            else:
                e = F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")
        elif typ == "float64":
            e = c.cast("double")
        elif typ == "int64":
            e = c.cast("long")
        else:
            e = c.cast("string")
        out.append(e.alias(col))
    return df.select(*out)
