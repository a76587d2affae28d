"""Ranked search, decontamination and token alignment against plain versions, and their edge cases."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest

from annolake.llm import alignment, decontamination, queries, ranked_search

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
vocabularies = pytest.mark.skipif(not os.path.exists(alignment.BYTE_MODEL), reason="no vocabularies")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@tables
@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_decontamination"])
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    found = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(found.fetchall())


def ranking(docs, items, k):
    held = [(i, Counter(words_of(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item in sorted({i for i, _ in items}):
        terms = {w for i, t in items if i == item for w in words_of(t)}
        scores = []
        for i, c in held:
            m = 50 + (50 * sum(c.values()) * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("k", [1, 7])
def test_search_is_that_of_scoring_all(spark, k, monkeypatch):
    rng = random.Random(k)
    said = [f"w{x}" for x in range(60)]
    pick = lambda n: " ".join(said[min(int(rng.expovariate(0.08)), 59)] for _ in range(n))
    docs = [(i, pick(rng.choice([1, 3, 40, 400]))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)]  # ties beyond k
    docs += [(2000, None), (2001, ""), (2002, "?!"), (2003, "Äß W1 w1 W1"), (2004, "w2 " * 70_000)]
    items = [(i, pick(rng.choice([1, 2, 9, 60]))) for i in range(12)] + [(12, None), (13, ""), (14, "äß"), (15, "Äß w1"), (0, "w1 w2"), (0, "w1")]
    monkeypatch.setattr(ranked_search, "BLOCK", 4000)  # workers keep theirs; the driver's plan does not depend on it
    d = spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in docs], "doc_id long, text string, block int, `query` string, `a.b` double").repartition(5)
    q = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, term int")
    got = [tuple(r) for r in ranked_search.search(d, q, k=k).select("query", "rank", "id", "score").collect()]
    assert sorted(got) == sorted(ranking(docs, items, k))
    for few, chunk in ((0, 1000), (10**6, 3)):  # shuffled joins; several chunks of queries
        monkeypatch.setattr(ranked_search, "FEW_TERMS", few)
        monkeypatch.setattr(ranked_search, "CHUNK", chunk)
        again = [tuple(r) for r in ranked_search.search(d, q, k=k).select("query", "rank", "id", "score").collect()]
        assert sorted(again) == sorted(got)


def test_search_without_rows(spark):
    d, q = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert ranked_search.search(d, q).collect() == []
    assert ranked_search.search(some, q.where("item_id < 0")).collect() == []
    assert ranked_search.search(some.where("doc_id = 2"), q).collect() == []
    assert ranked_search.search(some, spark.createDataFrame([(1, "zz")], "item_id long, text string")).collect() == []


def hits(docs, items, width):
    windows = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        n = min(len(w), width)
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, covered, found = words_of(text), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    covered |= set(range(a, a + n))
                    found |= windows[tuple(w[a : a + n])]
        spans = [(a, min(b for b in range(a, len(w) + 1) if b not in covered)) for a in sorted(covered) if a - 1 not in covered]
        out.append((i, len(w), len(covered), sorted(found), spans))
    return out


@pytest.mark.parametrize("width", [10, 4])
def test_every_shared_window_is_found(spark, width, monkeypatch):
    rng = random.Random(width)
    pick = lambda n: [rng.choice("abcde") for _ in range(n)]
    items = [(i, " ".join(pick(rng.choice([1, 2, 3, 9, 10, 11, 30])))) for i in range(4, 30)] + [(90, None), (91, ""), (92, "..."), (93, "Über-Maß 7")]
    items = [(i, t) for i, t in items if i >= 90 or len(t) > 4 or i % 9 == 0]
    docs = [(i, " ".join(pick(rng.choice([1, 5, 30, 200])))) for i in range(60)] + [(60, None), (61, ""), (62, "--"), (63, "ÜBER maß 7 Über\nMaß  7"), (64, "z " * 50_000 + items[0][1])]
    docs += [(65 + i, f"x, {t.upper()}. y") for i, t in items if t] + [(7, docs[7][1]), (None, docs[7][1])]
    d = spark.createDataFrame([(i, t, 1, "y", 2) for i, t in docs], "doc_id long, text string, row int, words string, `a.b` int").repartition(3)
    q = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, hits int")
    expected = hits(docs, items, width)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    for few in (10**6, 0):
        monkeypatch.setattr(decontamination, "FEW_WINDOWS", few)
        got = decontamination.contaminated(d, q, width=width).select("id", "n_words", "n_hit", "items", "spans").collect()
        got = [(r.id, r.n_words, r.n_hit, list(r["items"]), [tuple(s) for s in r.spans]) for r in got]
        assert sorted(got, key=key) == sorted(expected, key=key)


def test_decontamination_without_rows(spark):
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id string, text string")
    assert [tuple(r)[:3] for r in decontamination.contaminated(some, none).orderBy("id").collect()] == [(1, 2, 0), (2, 0, 0)]
    assert decontamination.contaminated(some.where("doc_id > 9"), none).collect() == []


def alignment_of(texts):
    import sentencepiece
    import tokenizers

    a_model = tokenizers.Tokenizer.from_file(alignment.BYTE_MODEL)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)
    _, a_bytes = alignment.byte_level(alignment.BYTE_MODEL)
    rows = []
    for text in texts:
        a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        spell_a = [a_bytes[i] for i in a]
        spell_b = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_model.id_to_piece(i)]]
        if not text or not b"".join(spell_a) == b"".join(spell_b) == f" {text}".encode():
            rows.append(([], [], []))
            continue
        groups, at = [], [0, 0]
        ga, gb = [], []
        i = j = 0
        while i < len(a) or j < len(b):
            if at[0] <= at[1]:
                ga.append(a[i])
                at[0] += len(spell_a[i])
                i += 1
            else:
                gb.append(b[j])
                at[1] += len(spell_b[j])
                j += 1
            if at[0] == at[1]:
                groups.append((ga, gb))
                ga, gb = [], []
        rows.append((a, b, groups))
    held = Counter(p for _, _, groups in rows for p in {(x, y) for ga, gb in groups for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for a, b, groups in rows:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@tables
@vocabularies
def test_alignment_of_all_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op13_alignment(spark, DATA).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in docs]
    assert [tuple(r[c] for c in FIELDS) for r in got] == alignment_of([r.text for r in docs])


@vocabularies
def test_alignment_of_odd_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    texts = [None, "", " ", "   a  b", "\n\n x\t", "</s><s><|endoftext|>", "a▁b", "日本語 ñandú 🙂🙂", "naïve\x00z", "a" * 3000, "ab " * 20_000, "same", "same", "​﻿", "don't 'll"]
    texts += ["".join(rng.choice("ab  \n.,é'9▁🙂") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], "doc_id long, text string, row int, links string, `a.b` int").repartition(3)
    expected = alignment_of(texts)
    for few in (10**6, 0):
        monkeypatch.setattr(alignment, "FEW_PAIRS", few)
        got = alignment.aligned(d, digest=lambda t: F.sha2(t, 256)).orderBy("id").collect()
        assert [tuple(r[c] for c in [*FIELDS[:-1], "groups"]) for r in got] == expected
    assert alignment.aligned(d.where("doc_id < 0")).collect() == []
    assert alignment.aligned(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")).count() == 2


@vocabularies
def test_byte_level_ids_are_those_of_the_model():
    import tokenizers

    model = tokenizers.Tokenizer.from_file(alignment.BYTE_MODEL)
    model.encode_special_tokens = True
    encode, spelled = alignment.byte_level(alignment.BYTE_MODEL)
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 127), 10, 32, 32, rng.randrange(0xA0, 0x250), rng.randrange(0x3040, 0x30FF), 0x1F600])) for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += ["<|endoftext|>", "x" * 500, " " * 300 + "y", base64.b64encode(bytes(range(256)) * 8).decode()]
    assert [x.tolist() for x in encode(texts)] == [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
    assert all(b"".join(spelled[i] for i in x.tolist()) == t.encode() for x, t in zip(encode(texts), texts, strict=True))


@vocabularies
def test_alignment_of_one_wide_group():
    """The links of a group of many tokens are counted, not made one by one."""
    import numpy as np
    import pyarrow as pa

    n = 20_000
    a, b = np.arange(n) % 3, np.arange(2 * n) % 5
    ends_a, ends_b = np.arange(1, n + 1) * 8 - 1, np.arange(1, 2 * n + 1) * 4
    ends_a[-1] = ends_b[-1]
    block = alignment.Block(pa.array([7]), (a, b), (ends_a, ends_b), (np.array([0, n]), np.array([0, 2 * n])))
    text, end_a, end_b = alignment.cuts(block)
    assert (text.tolist(), end_a.tolist(), end_b.tolist()) == ([0], [n], [2 * n])
    own, pair, times = alignment.link_counts(block, text, end_a, end_b)
    expected = {x << 32 | y: p * q for x, p in Counter(a.tolist()).items() for y, q in Counter(b.tolist()).items()}
    assert own.tolist() == [0] * 15 and dict(zip(pair.tolist(), times.tolist(), strict=True)) == expected
