"""Queries of the operators over the driver's tables, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import decontam, embeddings, filter_audit, html, html_labels, langid, minhash, mixing, prefix_trie, sharding, substrings, tokens, toxicity, warc
from tallyspark.llm.common import read_table
from tallyspark.session import scratch_path

#: production parameters
SHARDS = 24
CONTEXT_TOKENS = 1024
MIX = {"alpha": 0.5, "epochs": 1.0}
MIX_SEED = 20240601


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


NEAR = minhash.Params(shingle=3, percent=85)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), NEAR)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"), SHARDS, keep=["doc_id"])


def op5_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), with_text=False)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = html.train(html_labels.labelled_pages())
    out = html.extract(read_table(spark, sf_dir, "pages"), model)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix itself: whole documents, repeated and globally shuffled."""
    docs = read_table(spark, sf_dir, "documents")
    rates = mixing.source_rates(docs, **MIX)
    return mixing.mix_sources(docs, rates, seed=MIX_SEED)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draws and the order of ``op8_mix_documents``, which have an SQL form."""
    return op8_mix_documents(spark, sf_dir).select("doc_id", "source", "copy_no", "mix_key")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    page = r"^urn:page:(-?\d+)$"
    return warc.read_bundles(index).select(
        F.regexp_extract("record_id", page, 1).try_cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.regexp_extract("refers_to", page, 1).try_cast("long").alias("refers_to"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.9)
    return found.select("vec_id", "n_links", "component_id", "kept")


#: a document is predicted toxic from this score on
TOXIC_FROM = 0.3


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs.select("doc_id", "text"), model)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def lender(conv_id: int) -> tuple[int, int]:
    """The conversation whose first turns replace those of ``conv_id``, and
    how many; of a negative id the next smaller multiple of five."""
    return conv_id - conv_id % 5, zlib.crc32(str(conv_id).encode()) % 9


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), lender)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


_MIX_SQL = f"""
WITH stats AS (
  SELECT source, CAST(sum(coalesce(octet_length(encode(text)), 0)) AS BIGINT) AS bytes FROM documents GROUP BY source),
raw AS (SELECT *, CASE WHEN bytes > 0 THEN pow(CAST(bytes AS DOUBLE), {MIX["alpha"]}) ELSE 0.0 END AS raw FROM stats),
rates AS (
  SELECT source, CASE WHEN bytes > 0 THEN raw / sum(raw) OVER () * (CAST(sum(bytes) OVER () AS DOUBLE) * {MIX["epochs"]}) / bytes
                      ELSE {MIX["epochs"]} END AS rate FROM raw),
parts AS (SELECT *, greatest(1, CAST(ceil(rate / {mixing.MAX_RATE}) AS BIGINT)) AS parts FROM rates),
terms AS (SELECT unnest(range(0, {mixing.TERMS} + 1)) AS k),
cdf AS (
  SELECT source, k, parts,
    sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS c
  FROM parts, terms WHERE rate > 0),
tables AS (SELECT source, any_value(parts) AS parts, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source),
drawn AS (
  SELECT d.*, p.part, t.cdf,
    CAST(('0x' || substr(md5('{MIX_SEED}|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || '|' || p.part), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source, LATERAL (SELECT unnest(range(0, t.parts)) AS part) p),
counted AS (SELECT *, len(list_filter(cdf, lambda c: c <= u)) AS n FROM drawn),
copies AS (SELECT * EXCLUDE (cdf, part, u, n), part * 128 + unnest(range(0, n)) AS copy_no FROM counted WHERE n > 0),
mixed AS (
  SELECT * REPLACE (CAST(copy_no AS BIGINT) AS copy_no),
    CAST(('0x' || substr(md5('order{MIX_SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || copy_no), 1, 13)) AS BIGINT) AS mix_key
  FROM copies)
"""

def _components_sql(links: str, ids: str) -> str:
    """CTE ``reach``: every id of ``ids(i)`` with the smallest it reaches over
    the symmetric ``links(a, b)``."""
    return f"""
walk(i, j) AS (SELECT i, i FROM {ids} UNION SELECT w.i, l.b FROM walk w JOIN {links} l ON l.a = w.j),
reach AS (SELECT i, min(j) AS least FROM walk GROUP BY i)"""


OP1_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {NEAR.shingle} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {NEAR.shingle} + 2), lambda k: array_to_string(w[k:k + {NEAR.shingle - 1}], ' '))) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS g FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS inter
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM shared WHERE 100 * inter >= {NEAR.percent} * (na + nb - inter)),
ids AS (SELECT doc_id AS i FROM documents),
{_components_sql("links", "ids")}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least AS component_id, least = doc_id AS kept FROM sets JOIN reach ON i = doc_id
"""

OP4_SQL = f"""
WITH steps AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x // 2, 3988292384 * (x % 2))) ORDER BY n) AS tab FROM range(0, 256) r(n)),
raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
crc AS (
  SELECT doc_id, CAST(len(h) // 2 + {sharding.ROW_OVERHEAD} AS BIGINT) AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c // 256, tab[1 + xor(c % 256, b)])), 4294967295) AS text_crc32 FROM raw, steps),
run AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER () AS total FROM crc),
cut AS (SELECT *, CAST(least(before * {SHARDS} // total, {SHARDS - 1}) AS INT) AS shard FROM run)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM cut
"""

OP6_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM item WHERE len(w) > 0)),
places AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.k, p.n, v.item_id FROM places p JOIN windows v ON p.n = v.n AND p.win = v.win),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM hits) GROUP BY doc_id),
owners AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (WHERE item_id IS NOT NULL)) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN owners o ON o.doc_id = d.doc_id
"""

OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT body, max(page_id) AS last FROM p GROUP BY body)
SELECT page_id, CAST(strlen(p.body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) % 32 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN last ON p.body = last.body
"""

OP10_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
ids AS (SELECT vec_id AS i FROM embeddings),
{_components_sql("links", "ids")},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least AS component_id, least = vec_id AS kept
FROM embeddings JOIN reach ON i = vec_id LEFT JOIN n ON a = vec_id
"""

OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY text),
known AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
flags AS (
  SELECT d.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
    CAST(len(words) < 200 AS INT)
    + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
    + 4 * CAST(100 * len(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 2 * len(d.text) AS INT)
    + 8 * CAST(regexp_matches(d.text, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(f.least < d.doc_id, false) AS INT) AS mask
  FROM docs d JOIN firsts f ON d.text = f.text LEFT JOIN known k ON d.doc_id = k.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
  SELECT filter_order, s.step AS step, bits[s.step] AS bit, coalesce(list_sum(bits[1:s.step - 1]), 0) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY part, mask),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN (mask & bit) = 0 AND (mask & before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

OP13_SQL = """
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(unicode(ch) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x // 2, 3988292384 * (x % 2)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
built AS (
  SELECT c.conv_id, 0 AS seg, o.pos, o.t, o.size FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, o.t, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
lists AS (SELECT conv_id, list(t ORDER BY seg, pos) AS ts, list(size ORDER BY seg, pos) AS sizes FROM built GROUP BY conv_id),
full_ AS (SELECT c.conv_id, coalesce(l.ts, []) AS ts, coalesce(l.sizes, []) AS sizes FROM convs c LEFT JOIN lists l ON c.conv_id = l.conv_id),
paths AS (
  SELECT conv_id, d.d AS depth, array_to_string(ts[1:d.d], '/') AS prefix, CASE WHEN d.d > 0 THEN array_to_string(ts[1:d.d - 1], '/') END AS parent,
    CASE WHEN d.d > 0 THEN sizes[d.d] ELSE 0 END AS size, d.d = len(ts) AS last
  FROM full_, LATERAL (SELECT unnest(range(0, len(ts) + 1)) AS d) d),
nodes AS (
  SELECT prefix, depth, any_value(parent) AS parent, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN last THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths GROUP BY prefix, depth),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS k FROM nodes WHERE depth > 0 GROUP BY parent, depth),
told AS (SELECT n.*, coalesce(k.k, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.parent = n.prefix AND k.depth = n.depth),
above AS (
  SELECT p.prefix AS top, p.depth AS top_depth, n.prefix, n.depth FROM told n JOIN paths q ON q.conv_id = n.conv_id AND q.depth = n.depth
  JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
sums AS (
  SELECT a.top, a.top_depth, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved
  FROM above a JOIN told n ON n.prefix = a.prefix AND n.depth = a.depth GROUP BY a.top, a.top_depth)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM told n JOIN sums s ON s.top = n.prefix AND s.top_depth = n.depth
LEFT JOIN told p ON n.depth > 0 AND p.prefix = n.parent AND p.depth = n.depth - 1
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_sharding": op4_sharding,
    "op5_repeated_substrings": op5_repeated_substrings,
    "op6_decontamination": op6_decontamination,
    "op7_html_text": op7_html_text,
    "op8_mix_documents": op8_mix_documents,
    "op8_mix_sources": op8_mix_sources,
    "op9_warc": op9_warc,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_filter_audit": op12_filter_audit,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": OP1_SQL,
    "op4_sharding": OP4_SQL,
    "op6_decontamination": OP6_SQL,
    "op9_warc": OP9_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op8_mix_documents": _MIX_SQL + "SELECT * FROM mixed",
    "op8_mix_sources": _MIX_SQL + "SELECT doc_id, source, copy_no, mix_key FROM mixed",
    "op12_filter_audit": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
