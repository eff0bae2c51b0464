"""Account dimension (A8): account name -> currency, bank, type, id pattern.

The configuration is a JSON map ``{name: {currency, bank, type,
id_pattern}}``.  It is read by Spark (``wholetext`` + ``from_json`` into a
map, then ``explode``), so the same code reads it from any shared storage.
Patterns are screened once on load, by Spark's tasks: an invalid pattern would
otherwise fail every ``rlike`` of the identification join.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.common import sized_broadcast, stored
from tallyspark.schema import ACCOUNTS

_MAP_TYPE = "map<string, struct<currency: string, bank: string, type: string, id_pattern: string>>"


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Accounts JSON file -> ACCOUNTS rows."""
    raw = spark.read.text(path, wholetext=True)
    read = raw.select(F.from_json("value", _MAP_TYPE).alias("m"))
    if not read.where("m IS NULL").isEmpty():
        raise ValueError(f"accounts file {path} is not a JSON map of accounts")
    parsed = read.select(F.explode("m").alias("account_name", "a"))
    # the file is one JSON document: parsed once, its accounts then read by many tasks
    return stored(parsed.select(
        "account_name",
        F.col("a.currency").alias("currency"),
        F.col("a.bank").alias("bank"),
        F.col("a.type").alias("account_type"),
        F.col("a.id_pattern").alias("id_pattern"),
    ), "accounts")


def accounts_from_dict(spark: SparkSession, cfg: dict) -> DataFrame:
    """ACCOUNTS rows from an in-memory configuration map."""
    rows = [
        (name, a.get("currency"), a.get("bank"), a.get("type"), a.get("id_pattern"))
        for name, a in cfg.items()
    ]
    return spark.createDataFrame(rows, ACCOUNTS)


def pattern_is_valid(pattern: str | None) -> bool:
    if pattern is None:
        return False
    # the engine that runs the patterns judges them
    jvm = SparkContext._active_spark_context._jvm
    try:
        jvm.java.util.regex.Pattern.compile(pattern)
        return True
    except (Py4JJavaError, IllegalArgumentException):
        return False


def _compiles(pattern: str) -> Column:
    """``pattern_is_valid`` of a column, judged where the rows are."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.col(pattern)).isNotNull()


def screen_patterns(accounts: DataFrame) -> tuple[DataFrame, list[str]]:
    """Drop accounts whose pattern does not compile; returns (valid accounts,
    names of the invalid ones).  Rows without a name are left out once a named
    one is invalid, as are all rows of an invalid name."""
    bad = accounts.where(~_compiles("id_pattern")).select("account_name")
    names = [r.account_name for r in bad.collect()]  # no rows but those to tell of
    if not names:
        return accounts, names
    # a name may come twice: one invalid pattern leaves out all of its rows
    invalid = sized_broadcast(bad.where("account_name IS NOT NULL").distinct())
    valid = accounts.where("account_name IS NOT NULL").join(invalid, "account_name", "left_anti")
    return valid, names
