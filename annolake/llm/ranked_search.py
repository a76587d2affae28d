"""Ranked lexical search over a two-level quantised index.

The index has a row for each term of each block of documents: the documents that hold it (ordinals within the block),
on the first level a byte for each, the term's share of a document's score in units of STEP rounded upward, on the
second level the occurrences. A row without a term lists the block's documents and their length terms. Every document
with a term is indexed, its whole text, whatever will be asked.

A query sums weight * byte over its terms, the upper bound of each document's score; one unit less for each term gives
the lower bound. The lower bounds of each block's best documents are counted by their leading bits over all blocks, and
the value that ``k`` of them reach bounds the k-th score from below. Each block then scores exactly, in 64-bit integers,
every document whose upper bound reaches that value, and hands on its own k best. The result is that of scoring all.

Scores: a term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), N the documents with terms and df those that hold
it; a document adds weight * (10**9 tf div (1000 tf + 20 m)), m = 50 + (50 n N) div L, n its terms and L all terms.

Queries are joined with the index by term, so neither side goes through the driver; more than CHUNK queries are split,
and each block answers each chunk by itself. Repeated rows are documents of their own; queries of one id are one query
and ask each term once. Null and empty texts hold no term and are never found; a query without terms finds nothing.
Equal scores go by ascending id, null ids last. Extra columns are ignored, whatever their names. Empty tables: no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.llm.common import stored
from annolake.llm.words import blocks

BLOCK = 1 << 23  # bytes of text in a block
STEP = 3922  # 255 * STEP is no less than the largest share, 10**6
CHUNK = 1000  # queries that a block answers in one group
FEW_TERMS = 200_000  # up to so many (query, term) pairs are broadcast
LEADING = 12  # bits of lower bounds that are told apart


def totals(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with terms, all their terms)."""

    def run(batches):
        for batch in batches:
            for _, _, words in blocks(batch.column(0), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([np.count_nonzero(words.counts)], pa.int64()), pa.array([words.counts.sum()], pa.int64())], ["docs", "terms"])

    found = docs.select(F.col(text_col)).mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


def _binaries(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """values[edges[k] : edges[k + 1]] as one binary for each k."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def index(docs: DataFrame, n_docs: int, n_terms: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, term, docs, impacts, tfs, ids, m): the postings, and with a null term the documents of each block."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, end, words in blocks(batch.column(1), BLOCK):
                if not len(words.starts):
                    continue
                m = 50 + (50 * words.counts.astype(np.int64) * n_docs) // n_terms
                hashes, rows = words.hashes(), words.rows()
                order = np.argsort(hashes, kind="stable")  # words stand row by row, so rows ascend within a term
                h, r = hashes[order], rows[order]
                new_term = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                posting = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
                tf, at = np.diff(np.r_[posting, len(h)]), r[posting]
                edges = np.r_[np.searchsorted(posting, new_term), len(posting)]
                impacts = -(-share(tf, m[at]) // STEP)
                a, b = words.starts[order[new_term]], words.ends[order[new_term]]
                names = np.r_[0, np.cumsum(b - a)]
                letters = words.data[np.arange(names[-1]) + np.repeat(a - names[:-1], b - a)]
                terms = pa.Array.from_buffers(pa.string(), len(a), [None, pa.py_buffer(names.astype(np.int32)), pa.py_buffer(letters)])
                none = lambda t, n=len(a): pa.nulls(n, t)
                whole = batch.column(0).slice(first, end - first)
                kinds = [pa.list_(whole.type), pa.list_(pa.int64())]
                size = np.uint8 if tf.max() < 1 << 8 else np.uint16 if tf.max() < 1 << 16 else np.uint32
                names_of = ["block", "term", "docs", "impacts", "tfs", "ids", "m"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(a), block)), terms, _binaries(at.astype(np.uint16), edges), _binaries(impacts.astype(np.uint8), edges),
                        _binaries(tf.astype(size), edges), none(kinds[0]), none(kinds[1]),
                    ],
                    names_of,
                )
                one = lambda v, t: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v).cast(t)
                blank = [pa.nulls(1, t) for t in (pa.string(), pa.binary(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([block]), *blank, one(whole, kinds[0]), one(pa.array(m), kinds[1])], names_of)
                block += 1

    shape = f"block long, term string, docs binary, impacts binary, tfs binary, ids array<{kind}>, m array<long>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, shape)


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(query, term), each pair once."""

    def run(batches):
        for batch in batches:
            for first, _, words in blocks(batch.column(1), BLOCK):
                terms = pa.array([words.text(k, k + 1) for k in range(len(words.starts))], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + words.rows())), terms], ["query", "term"])

    kind = queries.schema[id_col].dataType.simpleString()
    return queries.select(F.col(id_col).alias("query"), F.col(text_col).alias("text")).mapInArrow(run, f"query {kind}, term string").distinct()


def _by_query(table: pa.Table) -> dict:
    """query -> rows of ``table`` that hold one of its terms."""
    out = defaultdict(list)
    for row, queries in enumerate(table.column("queries").to_pylist()):
        for q in queries or ():
            out[q["query"], q["least"]].append(row)
    return out


def _ordinals(table: pa.Table) -> tuple[list, list, list[int]]:
    docs = [np.frombuffer(x, np.uint16) for x in table.column("docs").to_pylist() if x is not None]
    impacts = [np.frombuffer(x, np.uint8).astype(np.int64) for x in table.column("impacts").to_pylist() if x is not None]
    return docs, impacts, table.column("w").to_pylist()


def _low_bounds(k: int, kind: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        docs, impacts, w = _ordinals(table)
        n = 1 + max(int(d.max()) for d in docs)
        queries, lows, counts = [], [], []
        for (query, _), rows in _by_query(table).items():
            low = np.zeros(n, np.int64)
            for r in rows:
                low[docs[r]] += (w[r] * STEP) * np.maximum(impacts[r] - 1, 0)
            low = low[low > 0]
            if len(low) > k:
                low = np.partition(low, len(low) - k)[-k:]
            drop = np.maximum(np.frexp(low.astype(np.float64))[1] - LEADING, 0)
            values, c = np.unique((low >> drop) << drop, return_counts=True)
            queries += [query] * len(values)
            lows.append(values)
            counts.append(c)
        flat = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
        return pa.table({"query": pa.array(queries, kind), "low": flat(lows), "n": flat(counts)})

    return run


def _exact(k: int, kind: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        ids = table.filter(pc.is_valid(table.column("m")))
        block, m, names = ids.column("block")[0].as_py(), np.array(ids.column("m")[0].as_py(), np.int64), ids.column("ids").combine_chunks().flatten()
        table = table.filter(pc.is_valid(table.column("docs")))
        docs, impacts, w = _ordinals(table)
        tfs = [np.frombuffer(x, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(x) // len(d)]) for x, d in zip(table.column("tfs").to_pylist(), docs, strict=True)]
        queries, found, scores = [], [], []
        for (query, least), rows in _by_query(table).items():
            high = np.zeros(len(m), np.int64)
            for r in rows:
                high[docs[r]] += (w[r] * STEP) * impacts[r]
            wanted = high >= max(least or 0, 1)
            score = np.zeros(len(m), np.int64)
            for r in rows:
                hit = wanted[docs[r]]
                d = docs[r][hit]
                score[d] += w[r] * share(tfs[r][hit], m[d])
            at = np.flatnonzero(wanted & (score > 0))
            if len(at) > k:
                at = at[score[at] >= np.partition(score[at], len(at) - k)[-k]]
                keys = names.take(pa.array(at)).to_pylist()
                at = at[sorted(range(len(at)), key=lambda x: (-score[at[x]], keys[x] is None, keys[x], at[x]))[:k]]
            queries += [query] * len(at)
            found.append(at)
            scores.append(score[at])
        at, flat = np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0, np.int64), *scores])
        out = {"query": pa.array(queries, kind), "id": names.take(pa.array(at)), "score": flat, "block": np.full(len(at), block), "row": at}
        return pa.table(out)

    return run


def search(
    docs: DataFrame, queries: DataFrame, *, k: int = 50, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text_col: str = "text"
) -> DataFrame:
    """(query, rank, id, score): for each query its ``k`` best documents with a score above 0."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    n_docs, n_terms = totals(docs, text_col)
    kinds = [f"{t.dataType.simpleString()}" for t in (queries.schema[query_col], docs.schema[id_col])]
    if not n_docs:
        return spark.createDataFrame([], f"query {kinds[0]}, rank int, id {kinds[1]}, score long")
    postings = stored(index(docs, n_docs, n_terms, id_col=id_col, text_col=text_col), "postings")
    asked = stored(query_terms(queries, query_col, query_text_col), "query-terms")
    pairs, n_queries = asked.agg(F.count("*"), F.countDistinct("query")).first()
    chunks = max(1, -(-n_queries // CHUNK))
    small = F.broadcast if pairs <= FEW_TERMS else lambda df: df

    held = postings.where("term is not null").select("term", (F.length("docs") / 2).cast("long").alias("n")).join(small(asked.select("term").distinct()), "term")
    ratio = F.lit(2.0 * n_docs + 2.0) / (F.sum("n") * 2 + 1).cast("double")
    weights = stored(held.groupBy("term").agg(F.floor(F.log(ratio) * 1000).cast("long").alias("w")).where("w > 0"), "weights")
    weighted = asked.join(weights, "term").withColumn("chunk", F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int"))

    def entries(df: DataFrame) -> DataFrame:
        return small(df.groupBy("chunk", "term").agg(F.first("w").alias("w"), F.collect_list(F.struct("query", "least")).alias("queries")))

    kind = to_arrow_type(queries.schema[query_col].dataType)
    first = postings.select("block", "term", "docs", "impacts").join(entries(weighted.withColumn("least", F.lit(None).cast("long"))), "term")
    lows = first.groupBy("chunk", "block").applyInArrow(_low_bounds(k, kind), f"query {kinds[0]}, low long, n long")
    lows = lows.groupBy("query", "low").agg(F.sum("n").alias("n"))
    reached = F.sum("n").over(W.partitionBy("query").orderBy(F.desc("low")))
    least = stored(lows.withColumn("reached", reached).where(F.col("reached") >= k).groupBy("query").agg(F.max("low").alias("least")), "least")

    second = postings.select("block", "term", "docs", "impacts", "tfs").join(entries(weighted.join(least, "query", "left")), "term")
    second = second.select("chunk", "block", "w", "queries", "docs", "impacts", "tfs", F.lit(None).cast(postings.schema["ids"].dataType).alias("ids"), F.lit(None).cast("array<long>").alias("m"))
    none = [F.lit(None).cast(second.schema[c].dataType).alias(c) for c in ("w", "queries", "docs", "impacts", "tfs")]
    heads = postings.where("term is null").select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "block", *none, "ids", "m")
    shape = f"query {kinds[0]}, id {kinds[1]}, score long, block long, row long"
    scored = second.union(heads).groupBy("chunk", "block").applyInArrow(_exact(k, kind), shape)
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "block", "row"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "id", "score")
