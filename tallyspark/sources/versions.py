"""The ledger as versions of month partitions.

    <root>/data/v=<version>/ym=<month>/part-*.parquet
    <root>/manifests/<version>.json

A manifest names, for every month, the version whose files hold it, its rows
and a checksum.  A new version writes only the months that it changes and
points to the older files for the others.  The manifest is created last and
exclusively: a version without one does not exist, and a writer that repeats
a finished version finds it there.  Rows without a date are the month
``none``.  A row's month is part of its identity (the id begins with the
date), so months never interact in a merge.

The checksum of a month is free of order and covers content and id.  Where it
agrees with the manifest, stored ids are those of their rows, so nothing is
hashed again; a month that disagrees is hashed anew.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.identity import row_id
from tallyspark.operators.common import checkpointed
from tallyspark.operators.merge import merge_batch, month_of
from tallyspark.schema import LEDGER, LEDGER_COLUMNS
from tallyspark.sources.ledger import FileReadError, empty_ledger

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small text file; False if there is one of that name."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except (Py4JJavaError, PySparkException):
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def checksums(rows: DataFrame) -> DataFrame:
    """(ym, rows, checksum) of rows with ``ym`` and the ledger's columns."""
    h = F.xxhash64(*[F.col(c) for c in LEDGER_COLUMNS])
    # repeated rows cancel out in an xor, and not in a sum
    both = F.concat_ws("-", F.hex(F.bit_xor(h)), F.sum(F.pmod(h, F.lit(1 << 31))).cast("string"))
    return rows.groupBy("ym").agg(F.count(F.lit(1)).alias("rows"), both.alias("checksum"))


@dataclass(frozen=True)
class Version:
    root: str
    number: int
    #: month -> {"v": version that wrote it, "rows": n, "checksum": text}
    months: dict[str, dict]

    def paths(self, months=None) -> list[str]:
        wanted = self.months if months is None else [m for m in months if m in self.months]
        return [f"{self.root}/data/v={self.months[m]['v']:09d}/ym={m}" for m in sorted(wanted)]

    def read(self, spark: SparkSession, months=None) -> DataFrame:
        """Ledger rows with their month ``ym``, of the given months only."""
        paths = self.paths(months)
        if not paths:
            return empty_ledger(spark).withColumn("ym", F.lit(None).cast("string"))
        schema = LEDGER.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
        found = spark.read.schema(f"{schema}, v string, ym string").option("basePath", f"{self.root}/data").parquet(*paths)
        return found.drop("v")


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/manifests/{number:09d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{root.rstrip('/')}/manifests") if n.endswith(".json"))


def open_version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version of the ledger (default: the newest)."""
    found = versions(spark, root)
    if number is None and found:
        number = found[-1]
    if number is None or number not in found:
        raise FileReadError(f"no ledger version {'' if number is None else number} under {root}")
    return Version(root.rstrip("/"), number, json.loads(read_text(spark, _manifest(root, number))))


def write_version(spark: SparkSession, root: str, number: int, rows: DataFrame, base: Version | None = None, months=()) -> Version:
    """Version ``number``: ``rows`` replace the given ``months`` of ``base``
    (all of them for a first version), the other months stay where they are.
    A version that is there already is left as it is."""
    root = root.rstrip("/")
    if number in versions(spark, root):
        return open_version(spark, root, number)
    data = f"{root}/data/v={number:09d}"
    delete_path(spark, data)  # of a writer that did not get to its manifest
    out = rows.select(*LEDGER_COLUMNS).withColumn("ym", month_of())
    # large months are cut into several files, small ones share a task
    out.hint("rebalance", "ym").write.partitionBy("ym").parquet(data)
    entries = {} if base is None else {m: e for m, e in base.months.items() if m not in set(months)}
    if any(n.startswith("ym=") for n in names_in(spark, data)):
        schema = LEDGER.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
        written = spark.read.schema(f"{schema}, ym string").parquet(data)
        # one row per month
        entries |= {r["ym"]: {"v": number, "rows": r["rows"], "checksum": r["checksum"]} for r in checksums(written).collect()}
    write_once(spark, _manifest(root, number), json.dumps(entries, sort_keys=True))
    return open_version(spark, root, number)


def verified_ledger(spark: SparkSession, version: Version, months=None) -> tuple[DataFrame, list[str]]:
    """The ledger (of some months) with ids that belong to their rows, and
    the months that had to be hashed again because their checksum differs
    from the manifest's."""
    rows = version.read(spark, months)
    wanted = {m: e for m, e in version.months.items() if months is None or m in months}
    now = {r["ym"]: (r["rows"], r["checksum"]) for r in checksums(rows).collect()} if wanted else {}
    bad = sorted(m for m, e in wanted.items() if now.get(m) != (e["rows"], e["checksum"]))
    if bad:
        rows = rows.withColumn("id", F.when(F.col("ym").isin(*bad), row_id()).otherwise(F.col("id")))
    return rows, bad


def merge_into(spark: SparkSession, root: str, number: int, stmts: DataFrame, threshold: float = 0.8, mode: str = "reference"):
    """Merges statements into version ``number - 1`` and writes ``number``:
    only the months of the statements are read, and only those in which a row
    was re-described or added are written.  Returns (version, MergeResult);
    the result's ledger holds the months that were read.  A version that is
    there already is returned as it is, with None."""
    if number in versions(spark, root):
        return open_version(spark, root, number), None
    base = open_version(spark, root, number - 1)
    stmts = checkpointed(stmts)
    months = [r["ym"] for r in stmts.select(month_of().alias("ym")).distinct().collect()]  # at most one per month
    rows, _ = verified_ledger(spark, base, months)
    res = merge_batch(rows, stmts, threshold, mode=mode, trust_ledger_ids=True)
    changed = res.added.select(month_of().alias("ym")).union(
        rows.join(res.updates.select(F.col("old_id").alias("id")), "id", "left_semi").select("ym")
    ).distinct()
    changed = [r["ym"] for r in changed.collect()]
    out = res.ledger.where(month_of().isin(*changed)) if changed else res.ledger.limit(0)
    return write_version(spark, root, number, out, base, changed), res


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes manifests but the newest ``keep``, and the months' files that
    none of those names.  Returns the deleted paths."""
    root = root.rstrip("/")
    found = versions(spark, root)
    used = {p for v in found[-keep:] for p in open_version(spark, root, v).paths()}
    gone = []
    for v in found[:-keep]:
        delete_path(spark, _manifest(root, v))
    for d in names_in(spark, f"{root}/data"):
        if int(d.removeprefix("v=")) > found[-1]:
            continue  # being written
        for m in names_in(spark, f"{root}/data/{d}"):
            path = f"{root}/data/{d}/{m}"
            if m.startswith("ym=") and path not in used:
                delete_path(spark, path)
                gone.append(path)
    return gone
