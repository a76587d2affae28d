"""Columns of the user's own, with any name and type, and messages on cycles."""

from __future__ import annotations

from annolake.llm import chat, exact_dedup, mixing, ngram_jaccard, sp_viterbi

SHAPE = """doc_id long, text string, lang string, source string, _key string, _id long, _digest string, _gone boolean, key int, doc string,
  `a.b` int, tags map<string,int>, deep struct<m: array<map<string,string>>>, ids string, hash int, copies string, row string, id string, digest string"""


def rows(n=24):
    words = [f"w{k}" for k in range(400)]
    out = []
    for i in range(n):
        text = " ".join(words[(i // 3) * 20 : (i // 3) * 20 + 20]) if i % 3 else f"alone {i} " + " ".join(words[200 + i * 8 : 208 + i * 8])
        out.append((i, text, "en", "s", f"own{i}", i + 5, "d", True, i, "mine", i * 10, {"k": i}, ([{"x": "y"}],), f"ids{i}", 1, "c", "r", "z", "g"))
    return out


def by_id(found):
    return sorted(((r.doc_id, r) for r in found), key=lambda x: x[0])


def test_rows_come_back_as_they_were(spark):
    docs = spark.createDataFrame(rows(), SHAPE).repartition(3)
    own = {r.doc_id: r for r in docs.collect()}
    for stage in (exact_dedup.without_duplicates, ngram_jaccard.one_of_each_group, mixing.drawn_documents):
        out = stage(docs)
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r == own[r.doc_id] for r in got)
    assert sorted(r.doc_id for r in exact_dedup.without_duplicates(docs).collect()) == [i for i in range(24) if i % 3 != 1]
    assert sorted(r.doc_id for r in ngram_jaccard.one_of_each_group(docs).collect()) == [i for i in range(24) if i % 3 != 2]
    for empty in (docs.where("doc_id < 0"),):
        assert exact_dedup.without_duplicates(empty).collect() == ngram_jaccard.one_of_each_group(empty).collect() == mixing.drawn_documents(empty).collect() == []


def test_names_with_dots_hold_ids_and_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (None, "a b"), (None, "c")], "`my.id` long, `my.text` string")
    out = exact_dedup.without_duplicates(docs, id_col="my.id", text_col="my.text")
    assert out.columns == ["my.id", "my.text"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(2, "a b"), (None, "c")]


def test_encoding_keeps_the_users_column(spark):
    docs = spark.createDataFrame([(1, "hello there", "mine", 5)], "doc_id long, text string, ids string, `a.b` int")
    out = sp_viterbi.encode(docs)
    assert out.columns == ["doc_id", "text", "ids_before", "a.b", "ids"]
    back = sp_viterbi.decode(out).first()
    assert (back["ids_before"], back["a.b"], back["decoded"]) == ("mine", 5, "hello there")


def test_messages_that_hang_on_a_cycle_have_no_path(spark):
    shape = "conv long, msg long, parent long, role string, text string, score double, extra int"
    data = [(1, 1, 2), (1, 2, 1), (1, 3, 2), (1, 10, None), (1, 11, 10), (1, 12, 11), (1, 13, 99), (2, 1, 1), (2, 2, 1)]
    m = spark.createDataFrame([(c, i, p, "user", f"t{i}", 0.0, 1) for c, i, p in data], shape)
    got = {(r.conv, r.leaf): (r.n_turns, r.branch) for r in chat.conversations(m).collect()}
    assert got == {(1, 12): (3, 1), (1, 13): (1, 2)}
    assert chat.conversations(m.where("conv = 2")).collect() == chat.conversations(m.where("conv > 9")).collect() == []


def test_only_the_best_branches_are_formatted(spark):
    shape = "conv long, msg long, parent long, role string, text string, score double"
    m = spark.createDataFrame([(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a" * 100_000, 2.0), (1, 3, 1, "assistant", "b", 2.0), (1, 4, 1, "assistant", "c", 5.0)], shape)
    every = {r.leaf: r for r in chat.conversations(m).collect()}
    assert {k: r.branch for k, r in every.items()} == {4: 1, 2: 2, 3: 3}  # equal scores: the smaller leaf
    best = chat.conversations(m, best=2).collect()
    assert {r.leaf: r for r in best} == {k: every[k] for k in (4, 2)}
