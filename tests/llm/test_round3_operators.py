"""Operators 11 to 13 on edge rows, each against a plain brute-force version."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import filter_audit, prefix_trie, toxicity
from tallyspark.llm.queries import lender

# --- 11: toxicity -----------------------------------------------------------

PLAIN = "the river ran past old mills where people sold bread and rope under wide trees near roads".split()


def _labelled():
    rng = random.Random(5)
    rows = []
    for k in range(400):
        words = [rng.choice(PLAIN) for _ in range(rng.randint(5, 60))]
        bad = k % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["Idiot!", "zorgel" + rng.choice(["ish", "en", "ung", "aire"]), "m0r0n"])
        elif k % 7 == 0:
            words.insert(rng.randrange(len(words)), "class clown")
        if bad and k % 8 == 0:
            words[0] = "clown"
        rows.append((k, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = _labelled()
    rows += [(1000, None, 1), (1001, "", 0), (1002, "no label", None), (1003, rows[0][1], 1), (1004, rows[1][1], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))


def _brute_sum(model, text):
    """Largest weight per place, outside exception phrases, by plain search."""
    folded = toxicity.fold(text)
    places = {}
    for entry, w in model.weights.items():
        for at in range(len(folded)):
            if folded.startswith(entry, at):
                places[at] = max(w, places.get(at, 0.0))
    for p in model.exceptions:
        for at in range(len(folded)):
            if folded.startswith(p, at):
                places = {k: v for k, v in places.items() if not at <= k < at + len(p) - 1}
    return sum(places.values()) / np.log(np.e + len(folded.split())) if places else 0.0


def test_toxicity_folds_lookalikes_and_digits():
    assert toxicity.fold("An \u0406D10T,\u200b m0r\u043en\u2014\uff33cum!") == " an idiot moron scum "
    assert toxicity.fold(None) == toxicity.fold(" \t--") == " "


def test_toxicity_scores_equal_plain_search(spark, lexicon):
    texts = [
        (1, "you ID10T"),
        (1, "you ID10T"),
        (2, "z0rgelhaft und sonst nichts"),
        (3, "the class clown sold bread"),
        (4, "clown and class clown"),
        (5, None),
        (6, ""),
        (7, "river mills"),
        (None, "m\u043er\u043en"),
        (8, "bread rope " * 150_000 + "idiot moron idiot"),
        (9, "<a 'x " * 20_000),
    ]
    docs = spark.createDataFrame([(i, t, 9.0, "x") for i, t in texts], "doc_id long, text string, score double, hits string")
    found = toxicity.score(docs, lexicon).collect()
    assert found[0].__fields__ == ["doc_id", "text", "hits", "score"] and len(found) == len(texts)
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in found) == sorted((str(i), t or "") for i, t in texts)
    for r in found:
        want = 1 / (1 + np.exp(-np.clip(lexicon.intercept + lexicon.slope * _brute_sum(lexicon, r["text"]), -30, 30)))
        assert r["score"] == pytest.approx(want, abs=1e-12)
    told = {r["doc_id"]: r["score"] >= 0.3 for r in found}
    assert [told[k] for k in (1, 2, 4, None)] == [True] * 4
    assert [told[k] for k in (3, 5, 6, 7, 9)] == [False] * 5


def test_toxicity_of_unseen_texts(spark, lexicon):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice(PLAIN) for _ in range(40)) + (" zorgeloid" if k % 3 == 0 else ""), k % 3 == 0) for k in range(90)]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, bad boolean"), lexicon)
    assert got.where((F.col("score") >= 0.3) != F.col("bad")).count() == 0


def test_toxicity_without_examples(spark):
    schema = "doc_id long, text string, toxic int"
    for rows in ([], [(1, "clean words", 0)], [(1, "bad words", 1), (2, None, 0)]):
        df = spark.createDataFrame(rows, schema)
        model = toxicity.train(df, df)
        got = toxicity.score(spark.createDataFrame([(1, "what an idiot", 0), (2, "bread", 0)], schema), model).orderBy("doc_id").collect()
        assert 0 <= got[1]["score"] < 0.3 <= got[0]["score"] <= 1
    assert toxicity.score(spark.createDataFrame([], schema), model).count() == 0


# --- 12: filter audit -------------------------------------------------------


def _audit_rows():
    rng = random.Random(3)
    many = " ".join(f"w{i}" for i in range(250))
    texts = [many, many.upper(), "a a a a", "", None, "x $ y", many + " #", " \t\n", "\u00c9T\u00c9 caf\u00e9", "q\u00a0r s", many + " " + "long " * 60_000, "A"]
    rows = [(k, rng.choice(texts), rng.choice(["s1", "s2", "", None])) for k in range(120)]
    return rows + [(5, many, "s1"), (5, many, "s1"), (None, many, "s1"), (None, "a a a a", None), (-1, many, "s9"), (7, "x $ y", "s2")]


def _brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    docs = []
    for d, text, part in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        e = d is not None and any(o is not None and o < d and (u or "") == t for o, u, _ in rows)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": e}
        docs.append((part or "", {f for f, x in fails.items() if x}, d in good, d in bad))
    out = {}
    for part in {p for p, *_ in docs}:
        own = [x for x in docs if x[0] == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [x for x in own if f in x[1] and not x[1] & before]
                out[part, "".join(order), k + 1] = [
                    sum(not x[1] & (before | {f}) for x in own), len(gone), sum(f in x[1] and bool(x[1] & before) for x in own),
                    sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone),
                ]
    for part in {p for p, *_ in docs}:
        share = dict.fromkeys("ABCDE", 0)
        for (p, order, k), v in out.items():
            if p == part:
                share[order[k - 1]] += v[1]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(share[order[k - 1]])
    return out


@pytest.mark.parametrize("group_rows", [10_000, 3])
def test_filter_audit_equals_brute_force(spark, monkeypatch, group_rows):
    monkeypatch.setattr(filter_audit, "GROUP_ROWS", group_rows)  # 3: copies are salted
    rows = _audit_rows()
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 120, 3)] + [(6, 1, 0), (6, None, None), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, 2, "h") for r in rows], "doc_id long, text string, source string, mask int, n int, h string").repartition(5)
    got = filter_audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got} == _brute_audit(rows, labels)
    assert len(got) == 4 * 600


def test_filter_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.filter_audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# --- 13: prefix trie --------------------------------------------------------


def _conversations():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 60), 1_000_003, -7, -10]:
        if c % 5 == 0 and c % 3 == 0:
            continue  # the lender is absent
        for t in range(rng.randint(1, 11)):
            said = "hello" if t == 0 and c % 2 else rng.choice(["yes", "no", "caf\u00e9", None, ""])
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]) if t else "user", said))
    for c in range(200, 240):  # copies
        rows += [(c, 0, "system", "same"), (c, 1, "user", "same"), (c, 2, "user", "b" * (c % 2))]
    rows += [(300, k, "user", f"turn {k}") for k in range(3000)]  # a long one
    rows += [(None, 0, "user", "nobody"), (301, 5, "user", "tie"), (301, 5, "user", "tie"), (301, 5, "user", "another tie")]
    return rows + [(305, 0, "user", "x" * 2_500_000)]


def _turn_key(role, text):
    r, t = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(r)).encode() + b":" + r + t).digest()[:16]


def _brute_trie(rows, graft):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, _turn_key(role, text), len((text or "").encode())))
    own = {c: [(k, n) for *_, k, n in sorted(v)] for c, v in own.items()}
    # nodes are numbers: 0 is the root, others by (parent, turn)
    number, parents, depths, size, members, ends = {}, {0: None}, {0: 0}, {0: 0}, {0: []}, {}
    for c, turns in own.items():
        base, h = graft(c)
        at = 0
        members[0].append(c)
        for key, n in turns if base == c else own.get(base, [])[:h] + turns[h:]:
            up, at = at, number.setdefault((at, key), len(number) + 1)
            parents[at], depths[at], size[at] = up, depths[up] + 1, n
            members.setdefault(at, []).append(c)
        ends.setdefault(at, []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(parents[p], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=lambda p: -depths[p]):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) or 1
        saved[p] = sum(saved[k] for k in below) + (len(members[p]) - 1) * size[p]
    return sorted(
        (min(m), depths[p], -(10**9) if not p else min(members[parents[p]]), len(m), len(kids.get(p, [])), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    )


@pytest.mark.parametrize("limit", [None, 40, 3])
def test_prefix_trie_equals_brute_force(spark, limit):
    rows = _conversations()
    conv = spark.createDataFrame([(*r, 1, "p") for r in rows], "conv_id long, turn int, role string, text string, depth int, prefix string").repartition(4)
    for graft in (lender, prefix_trie.no_graft):
        got = prefix_trie.prefix_trie(conv, graft, limit).drop("prefix").na.fill(-(10**9), ["parent_conv_id"]).collect()
        assert sorted(map(tuple, got)) == _brute_trie(rows, graft)


def test_prefix_trie_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema), lender).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], schema), lender).count() == 0


def test_prefix_trie_of_a_conversation_without_turns(spark):
    c = next(c for c in range(1, 500, 5) if zlib.crc32(str(c).encode()) % 9 >= 2)
    got = prefix_trie.prefix_trie(spark.createDataFrame([(c, 0, "user", "x")], "conv_id long, turn long, role string, text string"), lender).collect()
    assert [(r["conv_id"], r["depth"], r["n_convs"], r["n_leaves"]) for r in got] == [(c, 0, 1, 1)]
    assert got[0]["ends_sha256"] == hashlib.sha256(str(c).encode()).hexdigest()


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = prefix_trie._distinct(rng.integers(0, 2**63, (5000, 2), dtype=np.uint64))
    slots = prefix_trie.Slots(keys)
    assert sorted(slots.find(keys).tolist()) == list(range(len(keys)))
    assert (slots.find(rng.integers(0, 2**63, (1000, 2), dtype=np.uint64)) == -1).all()


def test_spread_ends_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN_IDS", 7)
    ids = list(range(-20, 500))
    rows = [(b"a" * 16, c) for c in ids] + [(b"b" * 16, 3)]
    got = prefix_trie._streamed_ends(spark.createDataFrame(rows, "prefix binary, conv_id long").repartition(6)).collect()
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert {bytes(k): v for k, v in got} == {b"a" * 16: want, b"b" * 16: hashlib.sha256(b"3").hexdigest()}
