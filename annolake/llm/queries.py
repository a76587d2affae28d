"""The thin opN queries over the driver's tables, and the SQL that says what they must return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.ngram_jaccard import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"), count_links=True)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_id", "n_links")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.suffix_dedup import without_repeats

    out = without_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.mixing import mixed

    draws, _ = mixed(table(spark, sf_dir, "documents"))
    return draws.select(F.col("id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "copies")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.toxicity import toxicity_scores

    out = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return out.select(F.col("id").alias("doc_id"), "held_out", "score", predicted, F.size("sentences").cast("long").alias("n_offending"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.quality import quality_scores

    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.media import edited_copies, rendered

    out = edited_copies(rendered(table(spark, sf_dir, "embeddings")))
    return out.select(F.col("id").alias("media_id"), "n_corners", "class_id", "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.exact_dedup import exact_duplicates

    out = exact_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm import chat

    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    formed = chat.conversations(chat.linear(rows, "conv_id", "turn", "role", "text"))
    turns = F.transform(chat.turns_of(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.loss_text(F.col("formatted"), F.col("loss"))
    return formed.select(
        F.col("conv").alias("conv_id"),
        F.size(chat.turns_of(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", turns), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.sp_viterbi import decode, encode

    out = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.length("decoded").cast("long").alias("decoded_chars"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.sharding import sharded

    out = sharded(table(spark, sf_dir, "documents"), 8)
    none = F.lit(None).cast("int").alias("grown_shard")
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.ranked_search import search

    out = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
    return out.select(F.col("query").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.decontamination import contaminated

    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.llm.alignment import aligned

    out = aligned(table(spark, sf_dir, "documents"), digest=lambda text: F.sha2(text, 256))
    return out.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_media": op6_media,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_sharding": op10_sharding,
    "op11_ranked_search": op11_ranked_search,
    "op12_decontamination": op12_decontamination,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": r"""
with named as (
  select doc_id, lang, source, md5(coalesce(text, '')) digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) n_tokens,
    'domain' || (('0x' || substr(md5(coalesce(source, '')), 1, 8))::bigint % 4) domain from documents),
rows as (select * from named where n_tokens > 0),
leaves as (
  select domain, lang, source, sum(n_tokens) tokens, 3.0::double * sum(n_tokens) cap,
    (('0x' || substr(md5(coalesce(source, '')), 1, 8))::bigint % 4 + 1)::double weight from rows group by all),
langs as (
  select domain, lang, sum(cap) cap, (('0x' || substr(md5(coalesce(lang, '')), 1, 8))::bigint % 4 + 1)::double weight from leaves group by domain, lang),
domains as (select domain, sum(cap) cap, (('0x' || substr(md5(domain), 1, 8))::bigint % 4 + 1)::double weight from langs group by domain),
top as (
  select *, (amount - coalesce(sum(cap) over w, 0)) / (sum(weight) over () - coalesce(sum(weight) over w, 0)) level
  from (select *, (select 0.5::double * sum(n_tokens) from rows) amount from domains)
  window w as (order by cap / weight, domain rows between unbounded preceding and 1 preceding)),
top_budget as (
  select t.domain, least(t.cap, coalesce((select min_by(u.level, (u.cap / u.weight, u.domain)) from top u where u.cap / u.weight > u.level) * t.weight, t.cap)) amount
  from top t),
mid as (
  select l.*, amount, (amount - coalesce(sum(cap) over w, 0)) / (sum(weight) over (partition by domain) - coalesce(sum(weight) over w, 0)) level
  from langs l join top_budget using (domain)
  window w as (partition by domain order by cap / weight, lang nulls first rows between unbounded preceding and 1 preceding)),
mid_level as (select domain, min_by(level, (cap / weight, lang)) level from mid where cap / weight > level group by domain),
mid_budget as (select m.domain, m.lang, least(m.cap, coalesce(k.level * m.weight, m.cap)) amount from mid m left join mid_level k using (domain)),
low as (
  select l.*, amount, (amount - coalesce(sum(cap) over w, 0)) / (sum(weight) over (partition by l.domain, l.lang) - coalesce(sum(weight) over w, 0)) level
  from leaves l join mid_budget b on b.domain = l.domain and b.lang is not distinct from l.lang
  window w as (partition by l.domain, l.lang order by cap / weight, source nulls first rows between unbounded preceding and 1 preceding)),
low_level as (select domain, lang, min_by(level, (cap / weight, source)) level from low where cap / weight > level group by domain, lang),
budgets as (
  select l.domain, l.lang, l.source, l.tokens, floor(least(l.cap, coalesce(k.level * l.weight, l.cap)))::bigint budget
  from low l left join low_level k on k.domain = l.domain and k.lang is not distinct from l.lang),
placed as (
  select r.*, (b.budget // b.tokens)::bigint whole, (b.budget % b.tokens)::bigint rest,
    md5('7:' || (b.budget // b.tokens)::bigint || ':' || coalesce(r.doc_id::varchar, '') || ':' || digest) place
  from rows r join budgets b on b.domain = r.domain and b.lang is not distinct from r.lang and b.source is not distinct from r.source),
drawn as (
  select *, whole + (sum(n_tokens) over (partition by domain, lang, source order by place, doc_id rows between unbounded preceding and current row) <= rest)::int copies
  from placed)
select doc_id, domain, lang, source, n_tokens::bigint n_tokens, copies::int copies from drawn where copies > 0
""",
    "op1_ngram_jaccard": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') w from documents),
grams as (
  select distinct doc_id, g from (
    select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g from words)),
sizes as (select doc_id, count(*) n from grams group by doc_id),
both_in as (select a.doc_id a, b.doc_id b, count(*) m from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (
  select a, b from both_in join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * m >= 75 * (x.n + y.n - m)),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id, doc_id r from documents
  union select reach.doc_id, both_ways.b from reach join both_ways on reach.r = both_ways.a),
class_of as (
  select doc_id, min(doc_id) over (partition by s) class_id from (select doc_id, list(g order by g) s from grams group by doc_id)),
degree as (
  select l.a doc_id, count(distinct y.class_id) n from both_ways l join class_of x on x.doc_id = l.a join class_of y on y.doc_id = l.b
  where x.class_id <> y.class_id group by l.a)
select d.doc_id, coalesce(s.n, 0)::bigint n_shingles, c.component_id, coalesce(k.class_id, d.doc_id) class_id, coalesce(l.n, 0)::bigint n_links
from documents d left join sizes s using (doc_id) left join class_of k using (doc_id) left join degree l using (doc_id)
join (select doc_id, min(r) component_id from reach group by doc_id) c using (doc_id)
""",
    "op7_exact_dedup": """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) keep_id, count(*) over (partition by coalesce(text, '')) group_size,
  doc_id = max(doc_id) over (partition by coalesce(text, '')) kept, sha256(coalesce(text, '')) text_sha256
from documents
""",
    "op8_chat_format": r"""
with c as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) loss_sha256,
  sum(23 + length(regexp_replace(role, '([\\|])', 'x\1', 'g')) + length(regexp_replace(text, '([\\|])', 'x\1', 'g')))::bigint formatted_chars
from c group by conv_id
""",
    "op11_ranked_search": r"""
with t as (
  select r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from (select row_number() over () r, * from documents)),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark),
p as (select r, doc_id, term, count(*) tf from t group by r, doc_id, term),
lengths as (select r, sum(tf)::bigint n from p group by r),
total as (select count(*) docs, sum(n)::bigint terms from lengths),
m as (select r, 50 + (50 * n * docs) // terms m from lengths, total),
weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint w
  from (select term, count(*) df from p where term in (select term from q) group by term), total),
scored as (
  select item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint score
  from q join weights using (term) join p using (term) join m using (r) group by item_id, doc_id, r),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id, r) k from scored where score > 0)
select item_id, k::int "rank", doc_id, score from ranked where k <= 50
""",
    "op12_decontamination": r"""
with d as (
  select row_number() over () row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
sized as (select item_id, w, least(len(w), 10) n from b where len(w) > 0),
windows as (
  select distinct item_id, n, t from (select item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i+n-1], ' '))) t from sized)),
widths as (select distinct n from windows),
places as (select row, n, w, unnest(range(1, len(w) - n + 2)) i from d, widths where len(w) >= n),
hits as materialized (
  select row, i, x.n, item_id from (select row, n, i, array_to_string(w[i:i+n-1], ' ') t from places) x join windows y on x.n = y.n and x.t = y.t),
covered as (select row, count(distinct p) n_hit from (select row, unnest(range(i, i + n)) p from hits) group by row),
held as (select row, count(*) n_items, string_agg(s, ',' order by s) ids from (select distinct row, item_id::varchar s from hits) group by row)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
from d left join covered using (row) left join held using (row)
""",
}
