"""Mixing sources to target weights by Poisson replication (DataFrame only).

Each source has a mean repetition rate: its target bytes over its bytes.  Each
document draws its count of copies by inverting that Poisson distribution at a
uniform value hashed from a seed and the document's id, is exploded by the
count, and the copies are ordered globally by a second hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import materialised, shuffle_partitions

#: a rate above this is drawn as a sum of equal independent parts (Poisson
#: counts add), so one table of probabilities of fixed length serves any rate
MAX_RATE = 16.0
#: P(X > TERMS) at MAX_RATE is below 2^-53, the step of the uniform values
TERMS = 80
#: sources with at most this many rate rows are broadcast (about 0.7 KB each)
BROADCAST_SOURCES = 20_000


def hashed(*parts: Column) -> Column:
    """52 bits of an MD5 of the parts, as a long."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def source_rates(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = 0.5,
    epochs: float = 1.0,
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """One row per source: bytes, target ``weight``, mean repetition ``rate``.

    Without ``weights`` the target of a source is its share of bytes to the
    power ``alpha``, normalised.  A source that ``weights`` does not name has
    weight 0.  ``epochs`` scales the whole mix.  A source without bytes has no
    share to reach: rate 0 under given weights, else ``epochs``.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long")
    stats = df.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.sum(size).alias("bytes"), F.count("*").alias("docs"))
    if weights is None:
        raw = F.when(F.col("bytes") > 0, F.pow(F.col("bytes").cast("double"), F.lit(float(alpha)))).otherwise(F.lit(0.0))
    else:
        raw = F.lit(0.0)
        for name, w in weights.items():
            raw = F.when(F.col("source") == name, F.lit(float(w))).otherwise(raw)
    # a written table of one row per source: its totals are two numbers
    stats = materialised(stats.withColumn("raw", raw), "mix-sources")
    whole = stats.agg(F.sum("bytes").alias("bytes"), F.sum("raw").alias("raw")).first()
    all_bytes, all_raw = float(whole["bytes"] or 0), float(whole["raw"] or 0.0)
    empty = F.lit(0.0) if weights is not None else F.lit(float(epochs))
    weight = F.col("raw") / F.lit(all_raw) if all_raw > 0 else F.lit(0.0)
    rate = F.col("weight") * F.lit(all_bytes * float(epochs)) / F.col("bytes")
    return (
        stats.withColumn("weight", weight)
        .withColumn("rate", F.when(F.col("bytes") > 0, rate).otherwise(empty))
        .select("source", "bytes", "docs", "weight", "rate")
    )


def with_cdf(rates: DataFrame) -> DataFrame:
    """Adds ``parts`` and ``cdf``: the probabilities of at most 0, 1, 2, …
    copies at rate / parts, added up term by term."""
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_RATE)).cast("long"))
    step = f"""
        aggregate(sequence(1, {TERMS}),
            named_struct('p', exp(-rate / parts), 'c', exp(-rate / parts), 'a', array(exp(-rate / parts))),
            (s, k) -> named_struct('p', s.p * (rate / parts) / k, 'c', s.c + s.p * (rate / parts) / k,
                                   'a', concat(s.a, array(s.c + s.p * (rate / parts) / k))),
            s -> s.a)
    """
    return rates.withColumn("cdf", F.expr(step))


def mix_sources(
    df: DataFrame,
    rates: DataFrame,
    seed: int = 20240601,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """``df``'s rows repeated by their draws, in global order of ``mix_key``.

    Adds ``copy_no`` (128 x part + number within the part; gapless from 0 for
    rates up to MAX_RATE) and ``mix_key``.  A row whose draw is 0 is not in the
    mix: that is how rates below 1 thin a source.  Rows with equal ids
    (repeated rows) draw the same count; a null id draws as the text ``null``,
    a null source is a source of its own.  Input columns with a computed name
    are replaced.  An empty table gives no row.
    """
    table = with_cdf(rates).select(F.col("source").alias("_source"), F.col("parts").alias("_parts"), F.col("cdf").alias("_cdf"))
    if rates.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("copy_no", "mix_key")]
    key = F.col(f"`{id_col}`")
    uniform = hashed(F.lit(seed), key, F.col("_part")) / F.lit(float(2**52))
    drawn = (
        df.join(table, F.col(f"`{source_col}`").eqNullSafe(F.col("_source")))
        .select(*kept, "_cdf", F.explode(F.expr("sequence(0L, _parts - 1)")).alias("_part"))
        .withColumn("_u", uniform)
        .withColumn("_n", F.size(F.filter("_cdf", lambda c: c <= F.col("_u"))))
        .where("_n > 0")
    )
    n = shuffle_partitions(df.sparkSession)
    copies = drawn.select(*kept, "_part", F.explode(F.expr("sequence(0, _n - 1)")).alias("_copy"))
    return (
        copies.withColumn("copy_no", F.col("_part") * 128 + F.col("_copy"))
        .withColumn("mix_key", hashed(F.lit(f"order{seed}"), key, F.col("copy_no")))
        .drop("_part", "_copy")
        # the key is uniform: its ranges are known without a sample of the rows
        .withColumn("_range", F.least(F.floor(F.col("mix_key") / F.lit(float(2**52)) * n), F.lit(n - 1)).cast("int"))
        .repartitionById(n, "_range")
        .sortWithinPartitions("mix_key")
        .drop("_range")
    )


def draw_count(rate: float, u: float) -> int:
    """The count that a uniform value gives at a rate of at most MAX_RATE
    (plain form of the inversion, for checks)."""
    p = c = math.exp(-rate)
    k = 0
    while c <= u and k <= TERMS:
        k += 1
        p *= rate / k
        c += p
    return k
