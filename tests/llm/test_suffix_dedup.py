"""Removal of repeated strings against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from annolake.llm import suffix_dedup


def brute(rows, length):
    """{id: (bytes, removed, runs, kept)} by counting every string of ``length`` bytes."""
    texts = {i: (t or "").encode() for i, t in rows}
    seen = Counter(t[k : k + length] for t in texts.values() for k in range(len(t) - length + 1))
    out = {}
    for i, t in texts.items():
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone, strict=True) if not g))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line, whole = text(60), text(12), text(150)
    rows = [(0, None), (1, ""), (2, "x" * 900), (3, whole), (4, whole), (5, passage + whole[:100])]
    for i in range(6, 60):
        rows.append((i, text(rng.randint(1, 60)) + (passage if i % 3 else line) + text(rng.randint(0, 60))))
    rows.append((60, passage + text(5) + passage))
    return rows


def held(spark, rows, length):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = defaultdict(list)
    for r in suffix_dedup.without_repeats(df, length=length).collect():
        removed = sum(s.stop - s.start for s in r.spans)
        found[r.id].append((r.n_bytes, removed, len(r.spans), bytes(r.kept)))
    return found


@pytest.mark.parametrize("hot", [2000, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)  # 3: most buckets are settled apart
    monkeypatch.setattr(suffix_dedup, "MANY", hot)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 14)  # a text longer than what is hashed at a time
    rows = corpus(hot)
    rows.append((61, "".join(random.Random(1).choice("abcd ") for _ in range(40_000)) + rows[60][1]))
    expected = brute(rows, 200)
    assert any(x[1] for x in expected.values())
    assert {i: x[0] for i, x in held(spark, rows, 200).items()} == expected


def test_repeated_rows_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "q" * 150, 9), (1, "q" * 150, 9), (None, "q" * 300, 9)], "doc_id long, text string, gram int")
    out = suffix_dedup.without_repeats(df).collect()
    assert [(r.id, len(r.spans)) for r in out] == [(1, 0), (1, 0)]
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


def test_hashing_holds_little_and_forgets_bases():
    import tracemalloc

    import pyarrow as pa

    from annolake.llm import common

    texts = pa.record_batch([pa.array(range(40)), pa.array([" ".join(f"{i * k % 9973}" for k in range(10_000)) for i in range(1, 41)])], ["id", "text"])
    data, offsets = common.text_buffers(texts.column(1))
    tracemalloc.start()
    for _ in range(4):  # every run draws bases of its own
        bases = suffix_dedup.new_bases()
        for a, b in common.slices(offsets, suffix_dedup.CHUNK):
            suffix_dedup.pointers(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], 200, bases)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 64 << 20
    assert len(common._powers) <= common.BASES
