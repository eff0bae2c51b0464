"""Operators 1, 3, 4, 6 and 9 and the pipeline against brute force, with very
long and hostile texts among the rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tallyspark.llm import decontam, graph, langid, minhash, mixing, sharding, warc
from tallyspark.llm.queries import MIX, MIX_SEED, NEAR
from tests.conftest import SF001

VOCABULARY = [f"w{i}" for i in range(400)]
HOSTILE = ["<a 'x " * 350_000, "\x00" * 50_000, "́" * 60_000 + " ퟿ end", '"' * 99_999, "word " * 450_000]


def _near_texts(seed=2, n=160):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.6:
            words = (rng.choice(texts) or "x").split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rng.choice(VOCABULARY) for _ in range(rng.choice([1, 2, 3, 30, 90]))))
    return [*texts, None, "", " \n", "A b C", "a B c", *HOSTILE, HOSTILE[4] + "end"]


def _shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def _components(ids, sets, percent):
    """Row -> root row, from all pairs."""
    up = list(range(len(ids)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    return [root(k) for k in range(len(ids))]


@pytest.mark.parametrize("held", [graph.HELD_EDGES, 25])
def test_minhash_equals_all_pairs(spark, monkeypatch, held):
    monkeypatch.setattr(graph, "HELD_EDGES", held)  # 25: several rounds of components
    monkeypatch.setattr(graph, "HUB_EDGES", 3)
    monkeypatch.setattr(minhash, "GROUP_PAIRS", 2)
    if held == 25:
        monkeypatch.setattr(minhash, "BLOCK_SETS", 3)  # many blocks a family
    texts = _near_texts()
    rows = list(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), NEAR).collect()
    sets = [_shingles(t, 3) for t in texts]
    roots = _components(range(len(texts)), sets, 85)
    least = {r: min(k for k, x in enumerate(roots) if x == r) for r in roots}
    want = sorted((k, len(sets[k]), least[roots[k]], least[roots[k]] == k) for k in range(len(texts)))
    assert sorted(map(tuple, got)) == want


def test_components_in_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "HELD_EDGES", 20)
    monkeypatch.setattr(graph, "HUB_EDGES", 4)
    edges = [(i, i + 1) for i in range(150)] + [(5000, 5000 + i) for i in range(1, 90)] + [(k, 9000 + k % 3) for k in range(7000, 7100)]
    random.Random(1).shuffle(edges)
    got = dict(map(tuple, graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(151)} | {5000 + i: 5000 for i in range(90)} | {k: 7000 + (k - 7000) % 3 for k in range(7000, 7100)}
    want |= {9000 + r: min(k for k in range(7000, 7100) if k % 3 == r) for r in range(3)}
    want |= {k: min(j for j in range(7000, 7100) if j % 3 == k % 3) for k in range(7000, 7100)}
    assert got == want


def _plain_posterior(train, text):
    """Naive Bayes of one text, from counts per n-gram bucket of each."""
    sums, docs = {}, Counter()
    for t, lang in train:
        c = langid.bucket_counts(t)
        if lang is not None and c is not None and c.any():
            sums[lang] = sums.get(lang, 0) + c
            docs[lang] += 1
    own = langid.bucket_counts(text)
    if own is None or not own.any():
        return "und", 0.0
    logit = {}
    for lang, c in sums.items():
        p = (c + langid.SMOOTHING) / (c.sum() + langid.SMOOTHING * langid.DIM)
        logit[lang] = float(own @ np.log(p)) + np.log(docs[lang] / sum(docs.values()))
    best = min((-v, k) for k, v in logit.items())
    return best[1], 1 / sum(np.exp(v + best[0]) for v in logit.values())


@pytest.mark.parametrize("block", [langid.BLOCK_LANGS, 2])
def test_language_scores_equal_text_by_text(spark, monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK_LANGS", block)
    words = {"en": "the of and house river", "de": "der die und haus fluss", "es": "el la y casa rio", "fr": "le les et maison fleuve", "it": "il lo e casa fiume"}
    rng = random.Random(3)
    train = [(" ".join(rng.choice(v.split()) for _ in range(12)), k) for k, v in words.items() for _ in range(6)] + [(None, "en"), ("12 !", "de"), ("abc", None)]
    texts = ["the house", "der fluss und", "", None, "1 2 3", "la casa e il fiume", "a", HOSTILE[0], HOSTILE[4], "x" + " " * 300_000 + "le"]
    model = langid.train(spark.createDataFrame(train, "text string, lang string").repartition(4))
    got = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        lang, score = _plain_posterior(train, r["text"])
        assert (r["lang_pred"], r["score"]) == (lang, pytest.approx(score, rel=1e-6))


def test_six_hundred_languages(spark):
    rows = [(f"{chr(97 + k % 26)}{chr(97 + k // 26)}q {chr(97 + k // 26)}{chr(97 + k % 26)}z", f"l{k:03d}") for k in range(600)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    got = langid.identify(spark.createDataFrame(rows[::37], "text string, lang string"), model).collect()
    assert len(model.langs) == 600 and all(r["lang"] == r["lang_pred"] for r in got)


def test_shards_are_cut_at_equal_bytes(spark):
    rows = [(k if k % 9 else None if k % 2 else 4, t) for k, t in enumerate(_near_texts(5, 300))]
    rows += rows[:20]
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 24).collect()
    size = lambda t: len((t or "").encode()) + 8
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), size(r[1])))
    total, run, want, slots = sum(size(t) for _, t in rows), 0, [], Counter()
    for i, t in ordered:
        s = min(23, run * 24 // total)
        want.append((i, size(t), zlib.crc32((t or "").encode()), s, slots[s]))
        slots[s] += 1
        run += size(t)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got) == Counter(want)


def _hits(text, items, window):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    hit, owners = set(), set()
    for item, t in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        for k in range(max(1, len(own) - window + 1) if own else 0):
            win = own[k : k + window]
            for p in places.get(win[0], ()):
                if words[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    owners.add(item)
    return len(words), len(hit), sorted(x for x in owners if x is not None)


@pytest.mark.parametrize("block", [decontam.BLOCK_WINDOWS, 7])
def test_decontamination_equals_all_windows(spark, block):
    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice(VOCABULARY[:60]) for _ in range(n))
    items = [(f"i{k}", say(n)) for k, n in enumerate([14, 25, 10, 9, 2, 1, 12])] + [("none", None), ("empty", "--"), (None, "lonely words here"), ("i0", say(11)), ("ü", "Über Straße, 2 cafés")]
    docs = []
    for k in range(80):
        words = say(rng.randint(0, 60)).split()
        item = rng.choice(items)[1] or ""
        at = rng.randint(0, len(words))
        part = item.split()[rng.randint(0, 2) : rng.randint(3, 30)] if k % 3 else item.upper().split()
        docs.append((k, ",".join([*words[:at], *part, *words[at:]])))
    docs += [(100, None), (101, ""), (102, "Über straße-2 CAFés lonely words here"), (102, "x"), (None, say(5)), *((200 + k, t) for k, t in enumerate(HOSTILE)), (300, "pad " * 600_000 + items[1][1] + " pad" * 10)]
    found = decontam.contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id string, text string"), block_windows=block, with_text=True
    ).collect()
    assert len(found) == len(docs)
    for r in found:
        assert (r["n_words"], r["n_hit"], r["items"]) == _hits(r["text"], items, decontam.WINDOW)


def test_archive_equals_plain_grouping(spark, tmp_path):
    rng = random.Random(6)
    pages = [(k, f"http://h{k % 3}/{k}", rng.choice(["<p>a</p>", "", None, "<p>b</p>", f"<i>{k}</i>"])) for k in range(60)] + [(99, "u", HOSTILE[0]), (98, "u", HOSTILE[0])]
    index = warc.archive(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5), str(tmp_path / "w"))
    got = {r["record_id"]: r for r in warc.read_bundles(index).collect()}
    assert len(got) == len(pages)
    first = {}
    for k, _, h in pages:
        first[h or ""] = max(k, first.get(h or "", -1))
    for k, _, h in pages:
        r, body = got[f"urn:page:{k}"], (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        own = first[h or ""] == k
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"]) == (len(body), digest, "response" if own else "revisit")
        assert r["refers_to"] == (None if own else f"urn:page:{first[h or '']}")


COLUMNS = "doc_id long, text string, lang string, source string, score double, lang_pred string, copy_no long, mix_key long, row string, digest string, component string"


def test_pipeline_stages_keep_columns_and_decide_every_row(spark, tmp_path):
    """Null and repeated ids are decided like others; no input column is
    replaced, whatever it is called."""
    spark.createDataFrame([(1, "benchmark words " * 6)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    long, other = " ".join(f"ene{i}" for i in range(60)), " ".join(f"dva{i}" for i in range(60))
    texts = [(5, long), (None, long), (None, long), (None, other), (None, other), (7, other + " more"), (8, "solo uno"), (8, long), (8, other), (9, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 77.0 + k, "kept", k, -k, f"r{k}", "d", "c") for k, (i, t) in enumerate(texts)], COLUMNS)
    before = {r["copy_no"]: tuple(r) for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path)).collect()
        assert all(tuple(r) == before[r["copy_no"]] for r in out), name
    kept = [tuple(r)[:2] for r in P.near_dedup(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted([(5, long), (7, other + " more"), (8, "solo uno"), (9, ""), (9, None)], key=str)
    twice = docs.where("copy_no IN (0, 6)").union(docs.where("copy_no = 6"))
    assert P.near_dedup(spark, twice, str(tmp_path)).count() == 2


def test_pipeline_equals_brute_force(spark):
    """All stages over sf0.001, each recomputed from its own input."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    train = [(r["text"], r["lang"]) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    told = [_plain_posterior(train, r["text"])[1] for r in rows]
    rows = [r for r, s in zip(rows, told, strict=True) if s >= P.MIN_SCORE]
    sets = [_shingles(r["text"], 5) for r in rows]
    roots = _components(rows, sets, 80)
    best = {}
    for r, g in zip(rows, roots, strict=True):
        best[g] = min(r["doc_id"], best.get(g, r["doc_id"]))
    rows = [r for r, g, s in zip(rows, roots, sets, strict=True) if not s or best[g] == r["doc_id"]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = [r for r in rows if _hits(r["text"], items, decontam.WINDOW)[1] == 0]
    size = lambda r: len((r["text"] or "").encode())
    by = Counter()
    for r in rows:
        by[r["source"]] += size(r)
    raw = {s: b ** MIX["alpha"] for s, b in by.items()}
    mixed = []
    for r in rows:
        s = r["source"]
        rate = raw[s] / sum(raw.values()) * sum(by.values()) * MIX["epochs"] / by[s]
        parts = max(1, -(-rate // mixing.MAX_RATE))
        for part in range(int(parts)):
            u = int(hashlib.md5(f"{MIX_SEED}|{r['doc_id']}|{part}".encode()).hexdigest()[:13], 16) / 2**52
            mixed += [r] * mixing.draw_count(rate / parts, u)
    mixed.sort(key=lambda r: (r["doc_id"], zlib.crc32(r["text"].encode())))
    total, run, want = sum(size(r) + 8 for r in mixed), 0, Counter()
    for r in mixed:
        want[r["doc_id"], min(P.SHARDS - 1, run * P.SHARDS // total)] += 1
        run += size(r) + 8
    got = P.run(spark, SF001).collect()
    assert Counter((r["doc_id"], r["shard"]) for r in got) == want
