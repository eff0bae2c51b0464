"""How document filters act together: who removes what, in every order.

Filters A to D judge a text by itself.  E fails a document whose text an
earlier one (smaller doc_id) has: an existential self-join, left-semi on hash,
exact text and smaller id.  E's ids and the ids that fail A to D are united
and aggregated to one bit combination per document; the combinations are
counted per part, and all counts of all orders follow from those (32 at most a
part) without another look at the documents.

Copies: the right side of the self-join holds each text once, with its
smallest id, and a hash that more than ``GROUP_ROWS`` rows share (or a share
of all rows) is dealt over as many salts as it needs.  Texts move only where a hash is shared.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import hot_rows, materialised, release

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
MIN_WORDS = 200
MIN_DISTINCT = 50  # percent of the words
MAX_CAPITALS = 2  # percent of the code points
SIGNS = "[#$%&*|]"
#: fixed values: ASCII white space
WHITE = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: rows of one hash that a task gets at least
GROUP_ROWS = 10_000


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, h, mask): the bits of the filters A to D that each
    document fails; a null text is empty, a null part the empty string."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    words = F.split(F.btrim("text", F.lit(WHITE)), r"[\x20\x09-\x0D]+")
    # the split of an empty text holds one empty word
    counted = slim.withColumn("words", words).select(
        "doc_id",
        "part",
        F.md5("text").alias("h"),
        F.when(F.get("words", F.lit(0)) == "", 0).otherwise(F.size("words")).cast("long").alias("n"),
        F.size(F.array_distinct("words")).cast("long").alias("distinct"),
        F.length("text").cast("long").alias("points"),
        (F.length("text") - F.length(F.translate("text", CAPITALS, ""))).cast("long").alias("capitals"),
        F.col("text").rlike(SIGNS).alias("signs"),
    )
    fails = {
        "A": F.col("n") < MIN_WORDS,
        "B": (F.col("n") > 0) & (100 * F.col("distinct") < MIN_DISTINCT * F.col("n")),
        "C": 100 * F.col("capitals") > MAX_CAPITALS * F.col("points"),
        "D": F.col("signs"),
    }
    mask = sum((F.when(c, BIT[f]).otherwise(0) for f, c in fails.items()), F.lit(0))
    return counted.select("doc_id", "part", "h", mask.cast("int").alias("mask"))


def repeated(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, h) of the documents whose exact text a smaller doc_id
    has; ``rows`` are those of ``failures``.  A null id is neither."""
    keys = rows.where("doc_id IS NOT NULL").groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    most = hot_rows(rows.count(), GROUP_ROWS, rows.sparkSession)
    keys = materialised(keys.withColumn("salts", F.ceil(F.col("k") / most).cast("int")).select("h", "salts"), "audit-shared")
    # at most 20 hashes a partition
    hot = keys.where("salts > 1").select(F.col("h").alias("hot"), F.col("salts").alias("own_salts"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))

    def salted(df: DataFrame) -> DataFrame:
        dealt = F.pmod(F.xxhash64("doc_id"), F.col("own_salts")).cast("int")
        return df.join(F.broadcast(hot), F.col("h") == F.col("hot"), "left").withColumn("salt", F.coalesce(dealt, F.lit(0))).drop("hot", "own_salts")

    wide = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("h", "salt")
    left = salted(slim.where("doc_id IS NOT NULL").withColumn("h", F.md5("text")))
    left = materialised(left.join(wide, ["h", "salt"], "left_semi"), "audit-candidates")
    first = left.groupBy("h", "text").agg(F.min("doc_id").alias("first_id"))
    right = first.join(F.broadcast(hot), F.col("h") == F.col("hot"), "left")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("own_salts", F.lit(1)) - 1))).select("h", "salt", "text", "first_id")
    same = (left["h"] == right["h"]) & (left["salt"] == right["salt"]) & (left["text"] == right["text"]) & (right["first_id"] < left["doc_id"])
    found = materialised(left.join(right, same, "left_semi").select("doc_id", "part", "h"), "audit-repeated")
    release(keys, left)
    return found


def combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each bit combination."""
    rows = materialised(failures(docs, id_col, text_col, part_col), "audit-failures")
    again = repeated(docs, rows, id_col, text_col, part_col)
    united = rows.select("doc_id", "part", "h", "mask", F.lit(1).alias("n")).unionByName(
        again.select("doc_id", "part", "h", F.lit(BIT["E"]).alias("mask"), F.lit(0).alias("n"))
    )
    whole = united.groupBy("doc_id", "part", "h").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    whole = whole.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    known = labels.groupBy(F.col("doc_id").alias("of")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad")
    )
    told = whole.join(known, F.col("doc_id") == F.col("of"), "left")
    return told.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("toxic"),
    )


def _orders() -> Column:
    """One struct per order and step: its filter's bit and the bits before."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step).alias("step"), F.lit(BIT[f]).alias("bit"), F.lit(before).alias("before")))
            before |= BIT[f]
    return F.array(*rows)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step.

    ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley`` (the removals of the step's filter summed
    over all orders: 120 / m for a document that fails m filters).

    A null or empty text has no words, so it fails A only, and E behind a
    smaller id.  A null part and an empty one are the same part.  A null id is
    counted, has no label and takes no part in E; rows that repeat an id count
    each, and equal texts under one id do not fail E by each other.  Several
    labels of an id: it is good or toxic if one of them says so.  Other
    columns are not read.  No document gives no row.
    """
    cells = combinations(docs, labels, id_col, text_col, part_col)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = parts.withColumn("o", F.explode(_orders())).select("part", "cells", "o.*")
    bit, before = F.col("bit"), F.col("before")

    def total(of: str, holds) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(holds(c["mask"]), c[of]).otherwise(0))

    fails = lambda m: m.bitwiseAND(bit) != 0
    early = lambda m: m.bitwiseAND(before) != 0
    gone = lambda m: fails(m) & ~early(m)
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: ~fails(m) & ~early(m)).alias("kept"),
        total("n", gone).alias("removed"),
        total("n", lambda m: fails(m) & early(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", gone).alias("good_lost"),
        total("toxic", gone).alias("toxic_lost"),
        F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.when(fails(c["mask"]), c["n"] * F.lit(120) / F.bit_count(c["mask"])).otherwise(0.0).cast("long")).alias("shapley"),
    )
