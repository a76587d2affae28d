"""The text and media operators against brute force, round trips and their stated edge cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from annolake.llm import chat, exact_dedup, media, mixing, ngram_jaccard, quality, sharding, sp_viterbi, toxicity

DOCS = "doc_id long, text string, lang string, source string"


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = ["w%d" % k for k in range(300)]
    base = [rng.choices(words, k=rng.randint(20, 80)) for _ in range(12)]
    rows = [(0, None, None, "a"), (1, "", "en", None), (2, " \t", "en", "a"), (3, "One two", "en", "a"), (4, "one TWO", "en", "a")]
    for i in range(5, n):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i, " ".join(own), rng.choice(["en", "de"]), rng.choice("aaab")))
    return rows


def components(rows):
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def word_sets(rows):
    out = {}
    for i, text, *_ in rows:
        w = (text or "").lower().split()
        out[i] = frozenset({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


@pytest.mark.parametrize("limit", [8, 1])
def test_near_duplicates(spark, limit):
    rows = corpus(7, 200)
    sets = word_sets(rows)
    linked = {s: sum(1 for q in set(sets.values()) if q and s and q != s and 100 * len(q & s) >= 75 * len(q | s)) for s in set(sets.values())}
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS + ", cls int, key int")
    found = ngram_jaccard.near_duplicates(df, group_limit=limit, count_links=True).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in found} == components(rows)
    assert {r.id: r.n_links for r in found} == {i: linked[s] for i, s in sets.items()}


def test_near_duplicates_of_odd_tables(spark):
    assert ngram_jaccard.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    rng = random.Random(3)
    long = [f"w{rng.randrange(3000)}" for _ in range(30_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long, "end"])), (2, " ".join([*long, "end"])), (None, " ".join(long)), (3, None)]
    found = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id, r.component_id) for r in found) == [(1, 1), (2, 1), (2, 1), (3, 3)]


def test_a_large_group_of_near_copies_is_not_squared(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(3000):
        own = list(base)
        for k in rng.sample(range(120), rng.choice([1, 3, 5])):
            own[k] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r.id: (r.component_id, r.n_links) for r in ngram_jaccard.near_duplicates(df, count_links=True).collect()}
    sets = word_sets(rows)
    some = rng.sample(range(3000), 20)
    for i in some:
        others = {j for j in range(3000) if sets[j] != sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
        assert found[i][1] == len({sets[j] for j in others}) and all(found[j][0] == found[i][0] for j in others)


def test_exact_duplicates(spark):
    rows = [(1, "a", "x", 1), (2, "a", "x", 1), (3, None, "x", 1), (4, "", "x", 1), (5, "b", "x", 1), (5, "b", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, row int")
    for digest in (exact_dedup.sha256_of, lambda t: exact_dedup.sha256_of(t.substr(1, 0))):  # the second one always collides
        out = exact_dedup.exact_duplicates(df, digest=digest).collect()
        assert sorted((r.id, r.keep_id, r.group_size, r.kept) for r in out) == [(1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 2, False), (5, 5, 2, True)]
    assert exact_dedup.exact_duplicates(df.limit(0)).count() == 0
    assert sorted(r.doc_id for r in exact_dedup.without_duplicates(df).collect()) == [2, 4, 5]


def test_mixing_budgets_and_epochs(spark):
    leaves = spark.createDataFrame([("d", "en", "a", 100, 10), ("d", "en", "b", 1000, 10), ("e", "de", "a", 10, 1)], "domain string, lang string, source string, tokens long, docs long")
    out = {(r.domain, r.source): r.budget for r in mixing.leaf_budgets(leaves, 400.0, 1, weights=lambda n: n.isNotNull().cast("double")).collect()}
    assert out == {("e", "a"): 10, ("d", "a"): 100, ("d", "b"): 290}
    draws, budgets = mixing.mixed(spark.createDataFrame(corpus(), DOCS))
    drawn = Counter()
    for r in draws.collect():
        drawn[r.domain, r.lang, r.source] += r.n_tokens * r.copies
    assert drawn and all(drawn[r.domain, r.lang, r.source] <= r.budget for r in budgets.collect())
    assert mixing.drawn_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_copies_of_pictures(spark):
    rng = np.random.default_rng(3)
    pictures = [media.picture(v) for v in rng.normal(size=(24, 64)).astype(np.float32)]
    rows = [(2 * i, media.to_pgm(x), 1) for i, x in enumerate(pictures)] + [(2 * i + 1, media.to_pgm(media.edited(x, i % 4)), 1) for i, x in enumerate(pictures)]
    rows += [(100, media.to_pgm(pictures[0]), 1), (101, None, 1), (102, b"no picture", 1), (103, media.to_pgm(np.full((40, 40), 7)), 1)]
    brute = {r[0]: media.describe(media.from_pgm(r[1])) for r in rows[:48]}
    links = {(a, b) for a in brute for b in brute if a < b and media.agreeing(*brute[a], *brute[b]) >= 4}
    assert links == {(2 * i, 2 * i + 1) for i in range(24)}
    df = spark.createDataFrame(rows, "media_id long, media binary, cls int")
    found = {r.id: (r.class_id, r.component_id) for r in media.edited_copies(df).collect()}
    assert all(found[2 * i + 1][1] == found[2 * i][1] == 2 * i for i in range(24))
    assert found[100] == (0, 0) and all(found[k] == (k, k) for k in (101, 102, 103))
    assert media.edited_copies(df.limit(0)).count() == 0


def test_small_crops_of_large_pictures():
    pictures = [media.picture(v, 288) for v in np.random.default_rng(11).normal(size=(20, 64)).astype(np.float32)]
    both = [(media.describe(x), media.describe(x[101:181, 90:170])) for x in pictures]
    assert sum(media.agreeing(*a, *b) >= 4 for a, b in both) >= 18
    assert all(media.agreeing(*a, *both[k - 1][1]) < 4 for k, (a, _) in enumerate(both))


@pytest.mark.parametrize("limit", [8, 1])
def test_many_edits_of_one_picture_are_one_component(spark, limit):
    rng = np.random.default_rng(6)
    rows = []
    for base in (0, 100):
        x = media.picture(rng.normal(size=64).astype(np.float32)).astype(int)
        rows += [(base + i, media.to_pgm(np.clip(x + 2 * i, 0, 255))) for i in range(12)]
    df = spark.createDataFrame(rows + [rows[3], (None, rows[0][1])], "media_id long, media binary")
    found = media.edited_copies(df, group_limit=limit).collect()
    assert sorted((r.id, r.component_id) for r in found) == [(i, i // 100 * 100) for i, _ in rows]


def test_recall_of_planted_edits_on_the_tables(spark):
    found = media.edited_copies(media.rendered(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))).collect()
    root = {r.id: r.component_id for r in found}
    copies = [i for i in root if i % 2]
    assert len(copies) >= 60
    for kind in range(4):
        own = [root[i] == root[i - 1] for i in copies if i // 16 % 4 == kind]
        assert sum(own) >= 0.9 * len(own)
    assert sum(root[i] not in (i, i - 1) and root[i] != i + 0 for i in root) <= 0.02 * len(root)


def test_tables_of_descriptors_are_read_as_written(spark):
    rng = np.random.default_rng(8)
    words = rng.integers(0, 1 << 63, (20, 4), dtype=np.uint64)
    words[7, 2] = words[3, 2]
    rows = [(i, 1, w.tobytes()) for i, w in enumerate(words)]
    blocks = media._tables(spark.createDataFrame(rows, "cls long, n int, bits binary"), 3, 8)
    assert [tuple(r) for r in ngram_jaccard.candidates(blocks, 0.75, 8).where("kind = 0").select("a", "b").collect()] == [(3, 7)]


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "a|b", 0.0), (1, 2, 1, "assistant", "x\\", 1.0), (1, 3, 1, "assistant", "<|end|>", 3.0), (1, 4, 3, None, None, 0.0), (2, 9, 77, "user", "q", 0.0), (3, 1, 2, "user", "", 0.0), (3, 2, 1, "user", "", 0.0)]
    out = chat.conversations(spark.createDataFrame(rows, "conv long, msg long, parent long, role string, text string, score double"))
    out = out.select("conv", "leaf", "branch", chat.turns_of(out.formatted).alias("turns"), chat.loss_text(out.formatted, out.loss).alias("said"))
    found = {(r.conv, r.leaf): (r.branch, [tuple(t) for t in r.turns], r.said) for r in out.collect()}
    assert found == {
        (1, 4): (1, [("user", "a|b"), ("assistant", "<|end|>"), ("", "")], "<|end|>"),
        (1, 2): (2, [("user", "a|b"), ("assistant", "x\\")], "x\\"),
        (2, 9): (1, [("user", "q")], ""),
    }


def test_messages_without_conversation_id_are_one_conversation(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, 0, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.conversations(chat.linear(df, "conv_id", "turn", "role", "text"))
    found = {r.conv: [tuple(t) for t in r.turns] for r in out.select("conv", chat.turns_of(out.formatted).alias("turns")).collect()}
    assert found == {None: [("user", "a"), ("assistant", "b")], 1: [("user", "c")]}


def best_score(word, pieces, unknown):
    top = [0.0] + [-1e18] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            s = pieces.get(word[i:j], unknown if j == i + 1 else None)
            if s is not None:
                top[j] = max(top[j], top[i] + s)
    return top[-1]


def test_whole_texts_get_the_best_score_and_words_stay_whole(spark):
    v = sp_viterbi.Vocabulary.load()
    pieces, score_of = {t: s for t, s, _ in v.pieces}, {i: s for _, s, i in v.pieces}
    texts = ["the theory of everything", "Several members expressed reservations about the plan.", "un deux trois\nquatre"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] * 2, "doc_id long, text string, ids int")
    for r in sp_viterbi.encode(df).collect():
        text = " " + texts[r.doc_id]
        best = sum(best_score(w, pieces, v.unknown_score) for w in sp_viterbi._WORDS.findall(text))
        assert sum(score_of.get(i, v.unknown_score) for i in r.ids) == pytest.approx(best)  # a line break is a byte
    (_, ids), = sp_viterbi.segmented([" theory"], v, v.trie())
    assert len(ids) == 1
    assert sp_viterbi.encode(df.limit(0)).count() == 0


def test_encoding(spark):
    v = sp_viterbi.Vocabulary.load()
    texts = [None, "", " ", "a  b\n\nc ", "Étion dans 日本 ▁x", "the theory of thermal therapy", "x" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: (r.ids, r.decoded) for r in sp_viterbi.decode(sp_viterbi.encode(df)).collect()}
    assert [out[k][1] for k in range(len(texts))] == texts
    pieces, score_of = {t: s for t, s, _ in v.pieces}, {i: (t, s) for t, s, i in v.pieces}
    word = " thermodynamics"
    (_, ids), = sp_viterbi.segmented([word], v, v.trie())
    assert "".join(score_of[i][0] for i in ids) == word
    assert sum(score_of[i][1] for i in ids) == pytest.approx(best_score(word, pieces, v.unknown_score))


def test_shards(spark):
    rows = corpus(n=400) + [(9, "same", None, "a")] * 3
    out = sharding.sharded(spark.createDataFrame(rows, DOCS), 8).collect()
    assert sorted(r.id for r in out) == sorted(r[0] for r in rows)
    sizes, slots = Counter(), {}
    for r in out:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(sizes.values()) == sum(len((t or "").encode()) + 1 for _, t, *_ in rows)
    assert max(sizes.values()) - min(sizes.values()) < 0.2 * sum(sizes.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded(spark.createDataFrame([], DOCS), 8).count() == 0


def test_classifiers_without_labels_and_on_empty_tables(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        out = scores(df, labels).collect()
        assert len(out) == df.count() and all(0 <= r.score <= 1 for r in out)
        assert scores(df.limit(0), labels).count() == 0


def test_classifiers_find_held_out_labels(spark):
    rng, rows, marks = random.Random(4), [], []
    for i in range(400):
        toxic, good = i % 5 == 0, i % 3 != 0
        body = [" ".join(rng.choice("abcdefgh") * rng.randint(2, 6) for _ in range(8)) for _ in range(4)] if good else ["@@ ## 12 99"] * 4
        if toxic:
            body[rng.randrange(4)] += " vilewords here"
        rows.append((i, ". ".join(body), "en", "a"))
        marks.append((i, int(good), int(toxic)))
    df, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    for scores, k in ((quality.quality_scores, 1), (toxicity.toxicity_scores, 2)):
        held = [r for r in scores(df, labels).collect() if r.held_out]
        assert held and sum((r.score >= 0.3) == bool(marks[r.id][k]) for r in held) >= 0.95 * len(held)


def test_long_clean_texts_are_not_toxic(spark):
    rng, rows, marks = random.Random(5), [], []
    for i in range(300):
        body = [" ".join(rng.choice(["calm", "day", "tree", "river", "stone"]) for _ in range(8)) for _ in range(5)]
        if i % 5 == 0:
            body[i % 4] += " vilewords"
        rows.append((i, ". ".join(body)))
        marks.append((i, int(i % 5 == 0)))
    long = ". ".join(["calm day tree river stone"] * 4000)  # 20,000 words
    rows += [(1000, "calm day"), (1001, long), (1002, long + ". vilewords")]
    df, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    found = {r.id: r.score for r in toxicity.toxicity_scores(df, labels).collect()}
    assert found[1001] == pytest.approx(found[1000], abs=1e-6) and found[1001] < 0.1 and found[1002] > 0.3
    doc, owner, place, label = np.arange(40), np.arange(20), np.zeros(20, np.int64), np.repeat([1, 0, 1], [20, 18, 2])
    model = toxicity.fit(doc, owner, place, np.array([5], np.uint64), label, np.ones(40))
    assert 0.05 < 1 / (1 + np.exp(-model.bias)) < 0.2  # 2 of 20 documents without the feature are toxic


def test_toxicity_learns_when_labels_are_plentiful(spark):
    rng, rows, marks = random.Random(6), [], []
    for i in range(400):
        body = [" ".join(rng.choice(["calm", "day", "tree", "river", "stone"]) for _ in range(8)) for _ in range(3)]
        if i % 2:
            body[1] += " vilewords"
        rows.append((i, ". ".join(body), 1.0, "x"))
        marks.append((i, i % 2))
    rows += [(None, "calm day", 1.0, "x"), (7, "calm day", 1.0, "x"), (500, "Calm day. All VILEWORDS here! Tree", 1.0, "x")]
    df, labels = spark.createDataFrame(rows, "doc_id long, text string, score double, sentences string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    found = toxicity.toxicity_scores(df, labels, max_labelled=40).collect()  # both classes have more
    assert len(found) == len(rows)
    held = [r for r in found if r.held_out and r.id is not None and r.id < 400 and r.id != 7]
    assert held and all((r.score >= 0.3) == bool(r.id % 2) for r in held)
    places = next(r.sentences for r in found if r.id == 500)
    assert [(p.start, p.end) for p in places] == [(10, 28)]


def test_noisy_or_scores_by_hand():
    model = toxicity.NoisyOr(0.5, -2.0, np.array([5, 9], np.uint64), np.array([3.0, 1.0]))
    p = model.sentence_scores(3, np.array([0, 0, 1, 2]), np.array([5, 9, 7, 9], np.uint64))
    base = 1 / (1 + np.exp(2.0))

    def beyond(z):  # a sentence's probability, less what the bias alone gives
        return 1 - (1 - 1 / (1 + np.exp(-z))) / (1 - base)

    assert p == pytest.approx([beyond(2.0), 0.0, beyond(-1.0)])
    score = model.document_scores(2, np.array([0, 0, 1]), p)
    assert score == pytest.approx([1 - (1 - base) * (1 - p[0]), 1 - (1 - base) * (1 - p[2])])


def test_quadratic_discriminant_by_densities():
    rng = np.random.default_rng(5)
    zeros, ones = rng.normal(0, 1, (200, 3)), rng.normal([1, 0, -1], [1, 2, 0.5], (300, 3))
    model = quality.fit({k: (float(len(x)), x.sum(axis=0), x.T @ x) for k, x in ((0, zeros), (1, ones))}, 0.1, 0.02)
    own = [np.cov(x.T, bias=True) for x in (zeros, ones)]
    pooled = (own[0] * 200 + own[1] * 300) / 500
    x, density = rng.normal(size=(20, 3)), []
    for data, c in zip((zeros, ones), own, strict=True):
        c = 0.88 * c + 0.1 * pooled + 0.02 * np.diag(np.diag(pooled) + 1e-6)
        d = x - data.mean(axis=0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1])
    share = 301 / 502
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(density[0] - density[1] - np.log(share / (1 - share)))))


def test_drawn_rows_of_shared_and_null_ids(spark):
    text = " ".join(["w"] * 20)
    rows = [(None, f"{text} {k}", "en", "a", k) for k in range(6)] + [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (1, text + " x", "en", "a", 9), (2, "", "en", "a", 9)]
    df = spark.createDataFrame(rows, DOCS + ", bucket int")
    draws, budgets = mixing.mixed(df)
    budget, drawn = budgets.first().budget, sum(r.n_tokens * r.copies for r in draws.collect())
    assert budget - 21 <= drawn <= budget
    out = mixing.drawn_documents(df)
    assert out.columns == df.columns
    assert sum(len(r.text.split()) for r in out.collect()) == drawn


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    left = stages["exact_dedup"](spark, docs, "/root/testdata/sf0.001")
    newest = {}
    for r in docs.collect():
        newest[hashlib.sha256((r.text or "").encode()).digest()] = max(r.doc_id, newest.get(hashlib.sha256((r.text or "").encode()).digest(), r.doc_id))
    assert sorted(r.doc_id for r in left.collect()) == sorted(newest.values()) and left.columns == docs.columns
    left = stages["near_dedup"](spark, docs, "/root/testdata/sf0.001")
    groups = components([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, (_, root) in groups.items() if i == root) and left.columns == docs.columns


def _peak(run):
    import tracemalloc

    tracemalloc.start()
    out = run()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    return out, peak


def test_shingles_hold_little_of_a_batch():
    import pyarrow as pa

    texts = pa.array([" ".join(f"{i * k % 9973}" for k in range(10_000)) for i in range(1, 101)])
    found, peak = _peak(lambda: sum(len(hashes) for _, hashes, _ in ngram_jaccard.shingle_sets(texts, 5)))
    assert found > 900_000
    assert peak < 40 << 20
    parts = [np.array([5, 7, 5], np.uint64), np.array([7, 7, 9, 5], np.uint64)]
    values, counts = ngram_jaccard._frequent(parts, 3)
    assert (values.tolist(), counts.tolist(), parts) == ([5, 7], [3, 3], [])
    assert [len(x) for x in ngram_jaccard._frequent([], 3)] == [0, 0]


def test_encoding_holds_little_of_a_batch(monkeypatch):
    import pyarrow as pa

    v = sp_viterbi.Vocabulary.load()
    root, texts = v.trie(), pa.array([" ".join(f"w{i * k % 997}" for k in range(10_000)) for i in range(1, 81)])
    ids, peak = _peak(lambda: [x.value_lengths().to_pylist() for x in sp_viterbi.encoded_batch(texts, v, root)])
    assert len(sum(ids, [])) == 80
    assert peak < 40 << 20
    some = pa.array(["a b", None, "", "the cat", "a cat", "b the"])
    whole = [x for part in sp_viterbi.encoded_batch(some, v, root) for x in part.to_pylist()]
    for known in (1, 0):
        monkeypatch.setattr(sp_viterbi, "KNOWN", known)
        monkeypatch.setattr(sp_viterbi, "BLOCK", 3)
        assert [x for part in sp_viterbi.encoded_batch(some, v, root) for x in part.to_pylist()] == whole
