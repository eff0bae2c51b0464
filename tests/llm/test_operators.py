"""Edge rows of every operator, each against a plain brute-force version."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pytest

from tallyspark.llm.graph import connected_components
from tallyspark.llm import decontam, embeddings, html, html_labels, langid, minhash, mixing, sharding, substrings, tokens, warc
from tallyspark.llm.queries import tokenizer_path

LONG = " ".join(f"word{i} tail{i % 7}" for i in range(3000))
NEAR = " ".join(f"near{i}" for i in range(120))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away today", "en"),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away today", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \t\n ", "en"),
    (6, "ab", "en"),
    (6, "ab", "en"),
    (7, LONG, "en"),
    (8, LONG + " more", None),
    (9, "El perro corre por la calle con el gato negro", "es"),
    (None, "El perro corre por la calle con el gato negro", "es"),
    (10, "12 34 \u2014 <|endoftext|> caf\u00e9 \u4f60\u597d\u0085x\x00y", None),
    (11, NEAR, "en"),
    (12, NEAR + " end", "en"),
    (13, "x" * 99 + "y" * 150 + "x" * 101, "en"),
]
SCHEMA = "doc_id long, text string, lang string, source string, size int, score int, spans int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, x, "s" if k % 3 else None, 1, 2, 3) for k, (i, t, x) in enumerate(TEXTS)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_minhash(docs, empty):
    p = minhash.Params(3, 85)
    out = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, p).collect()}
    by = {}
    for (i, _), v in out.items():
        by.setdefault(i, v)
    assert by[2] == (1, False) and by[8] == (7, False) and by[12] == (11, False)
    assert by[3] == (3, True) and by[4] == (4, True) and by[5] == (5, True)
    assert by[9] == (9, True) and by[None] == (9, False)
    assert minhash.near_duplicates(docs, p).count() == len(TEXTS)
    assert minhash.near_duplicates(empty, p).isEmpty()


def test_common_sizes():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (5, 700, 3000, 1)]
    got = minhash.common_sizes(sets, sets[::-1])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[::-1]] for a in sets]


def test_tokens(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    out = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in tokens.count_tokens(docs, tokenizer_path(), block_bytes=200).collect())
    assert out == sorted((i or -1, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in TEXTS)
    assert tokens.count_tokens(empty, tokenizer_path()).isEmpty()


def test_language(docs, empty):
    model = langid.train(docs)
    assert model.langs == ["en", "es"]
    rows = langid.identify(docs, model)
    assert rows.columns.count("score") == 1
    by = {r["text"]: (r["lang_pred"], r["score"]) for r in rows.collect()}
    assert by[None] == by[""] == by[" \t\n "] == ("und", 0.0)
    assert by["El perro corre por la calle con el gato negro"][0] == "es" and 0 <= by["ab"][1] <= 1
    assert langid.identify(docs, langid.train(empty)).where("lang_pred <> 'und'").isEmpty()
    assert langid.identify(empty, model).isEmpty()


def test_sharding(docs, empty):
    rows = sharding.assign_shards(docs, 4).collect()
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, _ in TEXTS)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == want
    for s in range(4):
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))
    order = [r["doc_id"] or -1 for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)
    assert sharding.assign_shards(empty, 4).isEmpty()


def test_mixing(spark, docs, empty):
    rates = mixing.source_rates(docs, weights={"s": 1.0}, epochs=3.0)
    by = {r["source"]: r["rate"] for r in rates.collect()}
    assert by[None] == 0.0 and by["s"] > 3.0
    out = mixing.mix_sources(docs, rates).collect()
    assert [r["mix_key"] for r in out] == sorted(r["mix_key"] for r in out)  # in order over all partitions
    assert {r["source"] for r in out} == {"s"}
    # the counts are the inverse of the distribution at the hashed values
    ours = [x for k, x in enumerate(TEXTS) if k % 3]
    for i, t, _ in ours:
        u = int(hashlib.md5(f"20240601|{'null' if i is None else i}|0".encode()).hexdigest()[:13], 16) / 2**52
        assert sum(r["doc_id"] == i and r["text"] == t for r in out) == mixing.draw_count(by["s"], u) * sum((j, x) == (i, t) for j, x, _ in ours)
    many = spark.range(400).selectExpr("id AS doc_id", "'a' AS text", "'q' AS source")
    total = mixing.mix_sources(many, mixing.source_rates(many, epochs=40.0)).count()
    assert abs(total - 16_000) < 6 * 16_000**0.5
    assert mixing.mix_sources(empty, mixing.source_rates(empty)).isEmpty()


def test_mix_returns_whole_documents(spark, docs, tmp_path):
    from tallyspark.llm.queries import QUERIES

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    whole = QUERIES["op8_mix_documents"](spark, str(tmp_path))
    assert whole.columns == [*docs.columns, "copy_no", "mix_key"]
    rows = whole.collect()
    given = {tuple(r) for r in docs.collect()}
    assert rows and {tuple(r)[:-2] for r in rows} <= given
    drawn = QUERIES["op8_mix_sources"](spark, str(tmp_path)).collect()
    assert sorted(map(str, drawn)) == sorted(str(r) for r in whole.select("doc_id", "source", "copy_no", "mix_key").collect())
    assert [r["mix_key"] for r in rows] == sorted(r["mix_key"] for r in rows)


def test_substrings(docs, empty, spark):
    rng = np.random.default_rng(5)
    base = "".join(chr(97 + c) for c in rng.integers(0, 4, 900))
    rows = [(k, base[a:b] + str(k) * n + base[c:d]) for k, (a, b, n, c, d) in enumerate([(0, 900, 0, 0, 0), (10, 200, 5, 150, 420), (0, 99, 1, 300, 399), (5, 105, 0, 0, 0), (700, 900, 3, 0, 101)])]
    rows += [(k + 10, t) for k, t in [(0, "ab" * 300), (1, "ab" * 80), (2, ""), (3, base)]]
    out = {r["doc_id"]: r for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen = set()
    for i, t in rows:
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        assert bytes(out[i]["kept"]) == kept and out[i]["n_removed"] == sum(gone)
        assert out[i]["n_spans"] == len(re.findall(b"\1+", bytes(gone)))
    mixed = substrings.remove_repeats(docs).collect()  # repeated and null ids
    assert len(mixed) == len(TEXTS)
    assert [r["n_removed"] for r in mixed if r["doc_id"] == 8] == [len(LONG)]
    assert substrings.remove_repeats(empty).isEmpty()


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog and runs"), (1, "ab"), (2, None), (3, ""), (None, "gato NEGRO"), (10, "brown fox jumps over the lazy dog and runs away today"), (2, "absent words")],
        "item_id long, text string",
    )
    for block in (200_000, 2):
        by = {(r["doc_id"], r["text"]): (r["n_words"], r["n_hit"], r["items"]) for r in decontam.contamination(docs, items, block_windows=block).collect()}
        assert by[(1, TEXTS[0][1])] == by[(2, TEXTS[1][1])] == (13, 12, ["1", "10"])
        assert by[(6, "ab")] == (1, 1, ["1"]) and by[(9, TEXTS[9][1])] == (10, 2, [])
        assert by[(3, None)] == by[(4, "")] == (0, 0, [])
    assert decontam.contamination(docs, items.where("false")).where("n_hit > 0").isEmpty()
    assert decontam.contamination(empty, items).isEmpty()


def test_html(spark):
    model = html.train(html_labels.labelled_pages())
    pages = html_labels.labelled_pages(100, seed=9)
    wrong = total = 0
    for p in pages:
        html._features(p)
        for n, b in zip(p.nodes, model.beliefs(p.nodes), strict=True):
            total += n.chars > 0
            wrong += n.chars > 0 and (b >= 0.5) != n.gold
    assert wrong < 0.03 * total
    page = "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Head &amp; line</h1><p>One  two<br>three.<p>Four <b>five</b>.</p></article><footer>&copy; x</footer></body></html>"
    rows = spark.createDataFrame([(1, "u", page, 1), (2, None, None, 1), (3, "u", "", 1), (None, "u", "<<p a='", 1)], "page_id long, url string, html string, text int")
    by = {r["page_id"]: r["text"] for r in html.extract(rows, model).collect()}
    assert by[1] == "Head & line\nOne two three.\nFour five." and by[2] == by[3] == ""
    assert html.extract(rows.where("false"), model).isEmpty()


def test_beliefs_are_exact():
    """Sum-product equals the enumeration of all labellings."""
    import itertools
    import math

    model = html.train(html_labels.labelled_pages(20), rounds=5)
    page = html.parse("<body><div class=ad><p>x</p></div><article><p>a b c</p><ul><li>q</li></ul></article></body>")
    html._features(page)
    n = len(page.nodes)
    total, on = 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n):
        s = sum(model.node.get(f, 0.0) for i, x in enumerate(page.nodes) if labels[i] for f in x.features)
        s += sum(model.edge.get((html._kind(x), labels[x.parent], labels[i]), 0.0) for i, x in enumerate(page.nodes) if i)
        total += math.exp(s)
        for i in range(n):
            on[i] += math.exp(s) * labels[i]
    assert np.allclose([v / total for v in on], model.beliefs(page.nodes))


def test_warc(spark, tmp_path):
    rows = [(1, "http://a", "x"), (2, "http://b c", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", "\u00e9\r\n\r\nWARC/1.1" * 500), (None, "u", "x"), (None, "u", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    index = warc.archive(pages, str(tmp_path))
    out = warc.read_bundles(index).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert sorted((r["payload_bytes"], r["payload_digest"]) for r in out) == sorted((len((t or "").encode()), digest(t)) for _, _, t in rows)
    kinds = sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in out if not r["record_id"].startswith("urn:page:null"))
    assert kinds == [("urn:page:1", "revisit", "urn:page:2"), ("urn:page:2", "response", None), ("urn:page:2", "response", None), ("urn:page:3", "revisit", "urn:page:4"), ("urn:page:4", "response", None), ("urn:page:5", "response", None)]
    r = index.where("record_id = 'urn:page:5'").first()
    head, block = warc.read_record(r["bundle"], r["frame_offset"], r["frame_bytes"], r["record_offset"])
    assert head["WARC-Record-ID"] == "<urn:page:5>" and block.endswith(rows[5][2].encode())
    assert warc.archive(pages.where("false"), str(tmp_path)).isEmpty()


@pytest.mark.parametrize("few", [embeddings.FEW, 1])
def test_embeddings(spark, monkeypatch, few):
    monkeypatch.setattr(embeddings, "FEW", few)  # 1: an index for every dimension
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in v + 0.05 * rng.normal(size=8)]) for i, v in enumerate(base[:20])]
    rows += [(200, rows[0][1]), (None, rows[1][1]), (201, None), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [1.0, None] + [0.0] * 6), (205, []), (206, [1.0, 2.0]), (207, [2.0, 4.0])]
    if few > 1:  # ragged vectors: any number of dimensions
        rows += [(300 + 2 * d + k, [float(x) for x in np.arange(d) + 1.0]) for d in range(9, 25) for k in (0, 1)]
    out = embeddings.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int")).collect()
    assert len(out) == len(rows)
    got = {r["vec_id"]: r["n_links"] for r in out}
    good = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    for i, v in good:
        want = sum(len(v) == len(w) and v @ w >= 0.9 * np.linalg.norm(v) * np.linalg.norm(w) for _, w in good) - 1
        assert got[i] == want, i
    for i in (201, 202, 203, 204, 205):
        assert got[i] == 0
    assert all((r["recall"] is None) == (r["vec_id"] in (201, 202, 203, 204, 205)) and (r["recall"] or 1) >= 0.999 for r in out)
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>")).isEmpty()


def test_embeddings_with_rare_links(spark, monkeypatch):
    """One pair that lies across cells, none in the first block of queries:
    blocks are drawn until the pair is met."""
    rng = np.random.default_rng(11)
    monkeypatch.setattr(embeddings, "QUERIES", 16)
    base = rng.normal(size=(3000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    noise = rng.normal(size=(4, 32))
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    rows += [(9000 + i, (base[i] + 0.46 * noise[i]).tolist()) for i in range(4)]
    out = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("n_links > 0").collect()
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = {rows[i][0]: int(n) for i, n in enumerate((x @ x.T >= 0.9).sum(1) - 1) if n}
    assert want and {r["vec_id"]: r["n_links"] for r in out} == want

    units = embeddings.unit_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding", "vec_id").withColumnRenamed("id", "node")
    books = embeddings.fit(embeddings._sample(units, 4096, 7)[1])
    n, share, linked = embeddings.cells_to_visit(units, books, 0.9, 0.999)
    assert linked == len(want) and share >= 0.999


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline as P

    spark.createDataFrame([(1, "El perro corre por la calle con el gato negro")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = P.language_id(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 6, 7, 8, 9, None, 10, 11, 12, 13}
    kept = P.near_dedup(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 9, 10, 11, 13]
    kept = P.decontaminate(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - 2
    assert P.mix_sources(spark, docs, str(tmp_path)).columns == docs.columns
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).isEmpty()


def test_components(spark):
    """A long path, a hub, a cycle and random edges over many partitions
    against a walk over the graph; nulls and self-loops name no node."""
    import random

    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)]
    edges += [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    edges += [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(160)]
    rng.shuffle(edges)
    near: dict = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want, seen = {}, set()
    for n in sorted(near):
        todo = [n] if n not in seen else []
        while todo:
            m = todo.pop()
            if m not in seen:
                seen.add(m)
                want[m] = n
                todo.extend(near[m])
    rows = [*edges, (None, 1), (5, None), (7, 7)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(7)
    got = connected_components(df).collect()
    assert len(got) == len(want) and {r["node"]: r["component"] for r in got} == want
    assert connected_components(df.where("a < 0")).count() == 0
