"""A training corpus from ``documents``: five stages, each by one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet in the shared scratch folder and rereads as the next
stage's ``docs``.  All but the last return the columns of ``docs``.

1. ``language_id`` drops documents without a letter, and those whose language
   the classifier cannot tell (posterior below ``MIN_SCORE``).
2. ``near_dedup`` keeps one document, that of the smallest id, of each group of
   near-duplicates (5-word shingles, similarity 0.8); equal rows leave one row.
3. ``decontaminate`` drops documents that hold a benchmark window.
4. ``mix_sources`` repeats or thins each source to its target share of bytes.
5. ``shard`` assigns every row a shard and its place there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import decontam, langid, minhash, mixing, sharding
from tallyspark.llm.common import materialised, read_table

MIN_SCORE = 0.5
NEAR = minhash.Params(shingle=5, percent=80, bands=20)
MIX = {"alpha": 0.5, "epochs": 1.0}
MIX_SEED = 20240601
SHARDS = 24


def _packed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all others as one struct ``row``: whatever they
    are called, no operator reads or replaces them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*[F.col(f"`{c}`") for c in names], F.struct(*(rest or [F.lit(0).alias("_")])).alias("row"))


def _unpacked(df: DataFrame, docs: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") if c in names else F.col("row")[c].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps rows with a predicted language.  A null or empty text, and one
    without a letter, goes.  Every row is judged by its own text, so null and
    repeated ids and equal rows are no special case; all columns come back as
    they were.  Without any labelled row nothing can be told and every row
    with a letter stays.  An empty table gives no row."""
    model = langid.train(docs.where(~langid.held_out()))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(_packed(docs, "text"), model).where(F.col("score") >= MIN_SCORE)
    return _unpacked(found, docs, "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: that of the smallest
    id, a null id after all others; under one id the text of the smallest
    digest; of equal ids and texts any one.  So null and repeated ids are
    decided like others.  Rows without words are no duplicates and stay.  An
    empty table gives no row."""
    found = minhash.components(docs, NEAR, carry=(F.md5("text").alias("digest"),))
    found = materialised(found.select("doc_id", "digest", "component"), "dedup-found")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("f"), F.count("*").alias("k"))
    kept = first.select(F.col("f.doc_id").alias("i"), F.col("f.digest").alias("d"))
    same = F.col("doc_id").eqNullSafe(F.col("i")) & F.md5("text").eqNullSafe(F.col("d"))
    plain = found.where("component IS NULL").select(F.col("doc_id").alias("i"), F.col("digest").alias("d")).distinct()
    rows = docs.join(kept.union(plain), same, "left_semi")
    # equal ids and texts: one row is left of those in a group
    again = found.where("component IS NOT NULL").groupBy("doc_id", "digest").agg(F.count("*").alias("k")).where("k > 1")
    again = materialised(again.select(F.col("doc_id").alias("i"), F.col("digest").alias("d")), "dedup-repeated")
    if again.isEmpty():
        return rows
    packed = _packed(rows.join(again, same, "left_semi"), "doc_id", "text")
    once = packed.groupBy("doc_id", "text").agg(F.first("row").alias("row"))
    return rows.join(again, same, "left_anti").union(_unpacked(once, docs, "doc_id", "text"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that hold a window of a benchmark item.  The row itself
    is carried through the operator, so repeated and null ids are told apart
    and equal rows are judged each; a null or empty text holds nothing and
    stays.  An empty table gives no row."""
    found = decontam.contamination(_packed(docs, "text"), read_table(spark, sf_dir, "benchmark"), id_col="row").where("n_hit = 0")
    return _unpacked(found, docs, "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated by their Poisson draws, in a global shuffle; all columns
    come back as they were.  Rows that repeat an id draw the same count, a
    null id draws as the text ``null``, a null source is a source, null and
    empty texts weigh nothing.  An empty table gives no row."""
    rates = mixing.source_rates(docs, **MIX)
    return _unpacked(mixing.mix_sources(_packed(docs, "doc_id", "source"), rates, seed=MIX_SEED), docs, "doc_id", "source")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot; shards are of near-equal bytes.
    Repeated rows and ids get places of their own, a null id comes first, a
    null text has no bytes.  An empty table gives no row."""
    return sharding.assign_shards(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: naive Bayes, MinHash and the hashed draws of their results have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
