"""Mixing sources to target weights: a token budget flows down a tree of domains, languages and sources.

Every node gets its weight's part of its parent's budget, but no more than its leaves hold in ``max_epochs`` passes.
What a full node cannot use is spread over its siblings by their weights, and only what a whole family cannot use
reaches the families beside it, one level up: shortages stay among siblings before ancestors share them. The spread is
a closed form over the siblings sorted by capacity for each unit of weight, so no level is iterated.

A leaf's budget is cut from its seeded epochs: in each epoch its documents come in the order of
md5(seed:epoch:id:md5 of the text); whole epochs are taken whole, and of the last one the longest prefix of documents that fits.
Sums over buckets of that order find the bucket in which the prefix ends, so only that bucket's rows are put in order,
however large the leaf is.

Null text has no tokens; documents without tokens are never drawn. Null language or source forms a leaf of its own.
A document is its id (null too) and its text: rows that share both are separate documents that stand next to each other
in the order. Texts of any length are counted whole. An empty table gives an empty result. ``mixed`` returns columns of
its own; extra columns come back from ``drawn_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.llm.common import named, stored, whole_row

DOMAINS = 4
ROWS_PER_BUCKET = 4096


def token_count(text: Column) -> Column:
    """Words between white space, counted by their beginnings."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]++")).cast("long")


def _number(name: Column) -> Column:
    """The first 32 bits of a name's md5 (null: of an empty name)."""
    return F.conv(F.substring(F.md5(F.coalesce(name, F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")


def domain_of(source: Column) -> Column:
    """Domain of a source: the sources are dealt over a few domains by their checksum."""
    return F.concat(F.lit("domain"), (_number(source) % DOMAINS).cast("string"))


def digest_of(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def level_weight(name: Column) -> Column:
    """Default target weight of a child, 1 to 4, by its name; callers may put any positive expression in its place."""
    return (_number(name) % 4 + 1).cast("double")


def _spread(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """budget of each child from its parent's ``amount``, its ``weight`` and its ``capacity``."""
    group = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    order = group.orderBy(F.col("capacity") / F.col("weight"), F.col(child).asc_nulls_first())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = (F.col("amount") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / (
        F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    nodes = nodes.withColumn("level", F.when(F.col("capacity") / F.col("weight") > level, level))
    nodes = nodes.withColumn("level", F.first("level", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return nodes.withColumn("budget", F.when(F.col("level").isNull(), F.col("capacity")).otherwise(F.least("capacity", F.col("level") * F.col("weight")))).drop("level")


def _under(nodes: DataFrame, parents: DataFrame, names: list[str]) -> DataFrame:
    """nodes with their parent's columns; null names match null names."""
    renamed = parents.withColumnsRenamed({n: f"p_{n}" for n in names})
    on = [F.col(n).eqNullSafe(F.col(f"p_{n}")) for n in names]
    return nodes.join(renamed, on).drop(*[f"p_{n}" for n in names])


def leaf_budgets(leaves: DataFrame, tokens: float | Column, max_epochs: int, weights=level_weight) -> DataFrame:
    """(domain, lang, source, tokens, docs, budget) for leaves (domain, lang, source, tokens, docs)."""
    leaves = leaves.withColumn("capacity", F.col("tokens").cast("double") * max_epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    domains = langs.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.lit(None).cast("double").alias("none"))
    total = tokens if isinstance(tokens, Column) else F.lit(float(tokens))
    top = _spread(domains.withColumn("weight", weights(F.col("domain"))).withColumn("amount", total), [], "domain")
    top = top.select("domain", F.col("budget").alias("amount"))
    mid = _under(langs, top, ["domain"]).withColumn("weight", weights(F.col("lang")))
    mid = _spread(mid, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("amount"))
    low = _under(leaves, mid, ["domain", "lang"])
    low = _spread(low.withColumn("weight", weights(F.col("source"))), ["domain", "lang"], "source")
    return low.select("domain", "lang", "source", "tokens", "docs", F.floor("budget").cast("long").alias("budget"))


def mixed(
    docs: DataFrame,
    *,
    share: float = 0.5,
    max_epochs: int = 3,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """(draws, budgets): draws has (id, digest, domain, lang, source, n_tokens, copies), copies the epochs a row is drawn in.

    The budget is ``share`` of all tokens of ``docs``.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        digest_of(F.col(text_col)).alias("digest"),
        domain_of(F.col(source_col)).alias("domain"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        token_count(F.col(text_col)).alias("n_tokens"),
    )
    rows = stored(rows.where("n_tokens > 0"), "tokens")
    leaves = stored(rows.groupBy("domain", "lang", "source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    budgets = stored(leaf_budgets(leaves, share * total, max_epochs), "budgets")

    leaf = ["domain", "lang", "source"]
    plan = budgets.select(
        *[F.col(c).alias(f"b_{c}") for c in leaf],
        F.floor(F.col("budget") / F.col("tokens")).alias("full"),
        (F.col("budget") % F.col("tokens")).alias("rest"),
        F.greatest(F.ceil(F.col("docs") / ROWS_PER_BUCKET), F.lit(1)).alias("buckets"),
    )
    on = (F.col("domain") == F.col("b_domain")) & F.col("lang").eqNullSafe(F.col("b_lang")) & F.col("source").eqNullSafe(F.col("b_source"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")), "digest").cast("binary"))
    drawn = rows.join(plan, on).withColumn("key", key)
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    drawn = drawn.withColumn("bucket", F.floor(place * F.col("buckets") / F.lit(1 << 32))).drop("b_domain", "b_lang", "b_source", "buckets")

    sums = drawn.groupBy(*leaf, "bucket").agg(F.sum("n_tokens").alias("m"), F.first("rest").alias("rest"))
    before = W.partitionBy(*leaf).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("m").over(before), F.lit(0)))
    # a bucket ends within the budget, or the prefix ends in it, or it comes after
    state = F.when(F.col("start") + F.col("m") <= F.col("rest"), 1).when(F.col("start") <= F.col("rest"), 0).otherwise(-1)
    sums = stored(sums.select(*leaf, "bucket", "start", state.alias("state")), "buckets")
    marks = sums.where("state >= 0").select(*[F.col(c).alias(f"m_{c}") for c in [*leaf, "bucket"]], "start", "state")
    same = (
        (F.col("domain") == F.col("m_domain"))
        & F.col("lang").eqNullSafe(F.col("m_lang"))
        & F.col("source").eqNullSafe(F.col("m_source"))
        & (F.col("bucket") == F.col("m_bucket"))
    )
    marked = drawn.join(marks, same, "left")
    # only rows of the bucket in which a prefix ends are put in order
    edge = marked.where("state = 0")
    order = W.partitionBy(*leaf, "bucket").orderBy("key", F.col("id").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = edge.withColumn("inside", (F.col("start") + F.sum("n_tokens").over(order)) <= F.col("rest"))
    plain = marked.where("state is null or state = 1").withColumn("inside", F.coalesce(F.col("state"), F.lit(0)) == 1)
    both = plain.unionByName(edge)
    copies = (F.col("full") + F.col("inside").cast("int")).cast("int")
    return both.select("id", "digest", *leaf, "n_tokens", copies.alias("copies")).where("copies > 0"), budgets


def drawn_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as often as the mix draws each of them, with its own columns."""
    draws, _ = mixed(docs, id_col=id_col, text_col=text_col, **options)
    # rows of one id and text are alike but for other columns: the k-th of them takes the k-th draw
    of_draws = W.partitionBy("id", "digest").orderBy(F.desc("copies"))
    drawn = draws.select(F.struct("id", "digest", F.row_number().over(of_draws).alias("nr")).alias("_row"), F.col("copies").alias("_copies"))
    # maps have no hash: their JSON stands for them
    hashed = [F.to_json(F.struct(named(c))) if "map<" in docs.schema[c].dataType.simpleString() else named(c) for c in docs.columns]
    rows = docs.select(whole_row(docs).alias("doc"), named(id_col).cast("long").alias("id"), digest_of(named(text_col)).alias("digest"), F.xxhash64(*hashed).alias("hash"))
    nr = F.row_number().over(W.partitionBy("id", "digest").orderBy("hash"))
    rows = rows.select("doc", F.struct("id", "digest", nr.alias("nr")).alias("_row"))
    return rows.join(drawn, "_row").select("doc", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("doc.*")
