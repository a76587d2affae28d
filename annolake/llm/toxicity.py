"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's score is a logistic regression over the words in it and their beginnings, less what the bias alone gives:
a sentence without a known feature scores 0. A document's score joins its sentences' and, once, the bias's by noisy-or,
1 - (1 - p0) prod(1 - p), so that sentences in which nothing was found add nothing, however many they are. The weights
and the bias are trained through the noisy-or from document labels alone, on a bounded sample of labelled rows
(``max_labelled`` of each class, drawn by hash). Scoring reads every sentence of every text and gives the offending
ones with their places.

Null and empty texts have no sentence: their score is that of a document in which nothing was found. Without both
classes among the labels the score is the smoothed share of ones. Repeated rows score alike, rows with a null id are
scored but never train, extra columns are ignored and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import crc32_text, prefix_hashes, slices, span_hash, stored, text_buffers

CHUNK = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)  # bytes of a word's beginning

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """(doc, start, end) of each sentence that has a word, and (sentence, feature) pairs, each once."""
    low = _LOWER[data]
    inside = _WORD[low]
    cut = np.zeros(len(data), np.int64)
    stops = np.flatnonzero(_STOP[data]) + 1
    cut[stops[stops < len(data)]] = 1
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    cut[edges] = 1
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    piece = np.cumsum(cut)[start]
    new = np.concatenate([[True], piece[1:] != piece[:-1]])
    sent = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    begins, ends = start[at], end[np.append(at[1:], len(start)) - 1]
    doc = np.searchsorted(offsets, begins, side="right") - 1
    prefix = prefix_hashes(low)
    hashes, owner = [span_hash(prefix, start, end)], [sent]
    for size in PREFIXES:
        long = end - start > size
        hashes.append(span_hash(prefix, start[long], start[long] + size) ^ np.uint64(0x9FB21C651E98DF25))
        owner.append(sent[long])
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    return doc, begins - offsets[doc], ends - offsets[doc], owner, hashes


def matched(features: np.ndarray, owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, place in the sorted ``features``) of each feature that a sentence holds, once."""
    if not len(features) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
    hit = features[at] == hashes
    both = np.unique(owner[hit] * len(features) + at[hit])
    return both // len(features), both % len(features)


@dataclass(frozen=True)
class NoisyOr:
    """Weights of known features (sorted by hash) and the bias, which a document bears once."""

    share: float
    bias: float = 0.0
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def sentence_scores(self, count: int, owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        owner, place = matched(self.features, owner, hashes)
        z = self.bias + np.bincount(owner, self.weights[place], minlength=count)
        return -np.expm1(-_beyond(z, self.bias))

    def document_scores(self, count: int, doc: np.ndarray, p: np.ndarray) -> np.ndarray:
        return -np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=count) - np.logaddexp(0, self.bias))


def _beyond(z: np.ndarray, bias: float) -> np.ndarray:
    """-log(1 - p) of sentences: what their features add to the bias, 0 without any or with mild ones only."""
    return np.maximum(np.logaddexp(0, np.clip(z, -50, 50)) - np.logaddexp(0, bias), 0)


def fit(doc_of, owner, place, features, label, weight, *, rounds: int = 200, rate: float = 1.0, l1: float = 1e-4, bias: float = -7.0) -> NoisyOr:
    """Weights of ``features`` and the bias, from ``bias`` on, by proximal gradient steps through the noisy-or.

    doc_of: document of each sentence; (owner, place): sentence and feature of each occurrence, each once; label and
    weight: of each document.
    """
    n = len(label)
    weight = weight / max(weight.sum(), 1e-9)
    share = float(np.clip((weight * label).sum(), 1 / (n + 2), 1 - 1 / (n + 2))) if n else 0.5
    if not n or label.min() == label.max():
        return NoisyOr(share)
    count, m = len(doc_of), len(features)
    w, squares, bias_squares = np.zeros(m), np.full(m, 1e-12), 1e-12
    for _ in range(rounds):
        z = np.clip(bias + np.bincount(owner, w[place], minlength=count), -30, 30)
        clean = np.exp(np.bincount(doc_of, -_beyond(z, bias), minlength=n) - np.logaddexp(0, bias))  # (1 - p0) prod(1 - p)
        slope = np.where(label == 1, -clean / np.clip(1 - clean, 1e-9, 1), 1.0) * weight
        rise, base = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
        rise[z < bias] = 0  # at the bias itself the weights must be able to start
        step = np.bincount(place, (rise * slope[doc_of])[owner], minlength=m)
        bias_step = float(base * slope.sum() + (np.where(z > bias, rise - base, 0) * slope[doc_of]).sum())
        bias_squares += bias_step**2
        squares += step**2
        pace = rate / np.sqrt(squares)
        w = w - pace * step
        w = np.sign(w) * np.maximum(np.abs(w) - pace * l1, 0)
        bias = float(np.clip(bias - rate / np.sqrt(bias_squares) * bias_step, -30, 30))
    used = np.abs(w) > 1e-6
    return NoisyOr(share, bias, features[used], w[used])


def _sample(docs, labels, id_col, text_col, label_col, held_out, max_labelled):
    """(text, label, weight): up to ``max_labelled`` training rows of each class, weighted back to the class shares."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.pmod(crc32_text("id"), F.lit(held_out[0])) != held_out[1]).groupBy("id").agg(F.max("label").alias("label"))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [
        known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(max_labelled).withColumn("weight", F.lit(max(1.0, counts.get(y, 0) / max_labelled)))
        for y in (0, 1)
    ]
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    drawn = text.join(F.broadcast(picked[0].union(picked[1])), "id")  # at most 2 * max_labelled small rows
    return stored(drawn.select("text", "label", "weight"), "labelled")


def _screened(sample: DataFrame, least: int, lift: float) -> np.ndarray:
    """Features of at least ``least`` toxic documents whose odds of a toxic document are ``lift`` times those of all.

    Odds are of weighted documents, so they are those of all labelled rows, and smoothed by one document of either
    class; as odds have no upper end, ``lift`` can be met whatever the share of toxic documents.
    """

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            label, weight = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
            for a, b in slices(offsets, CHUNK):
                doc, _, _, owner, hashes = sentences(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                values, index = np.unique(hashes, return_inverse=True)
                held = np.unique(index * (b - a) + doc[owner])
                place, of = held // (b - a), a + held % (b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values.view(np.int64)),
                        pa.array(np.bincount(place, label[of], minlength=len(values)).astype(np.int64)),
                        pa.array(np.bincount(place, label[of] * weight[of], minlength=len(values))),
                        pa.array(np.bincount(place, (1 - label[of]) * weight[of], minlength=len(values))),
                    ],
                    ["feature", "toxic", "ones", "zeros"],
                )

    every = sample.agg(F.sum(F.col("label") * F.col("weight")), F.sum((1 - F.col("label")) * F.col("weight"))).first()
    odds = ((every[0] or 0.0) + 1) / ((every[1] or 0.0) + 1)
    counted = sample.mapInArrow(run, "feature long, toxic long, ones double, zeros double").groupBy("feature")
    counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    chosen = counted.where((F.col("toxic") >= least) & (F.col("ones") + 1 >= F.lit(lift * odds) * (F.col("zeros") + 1)))
    return np.sort(np.array([r.feature for r in chosen.select("feature").collect()], np.int64).view(np.uint64))


def train(docs, labels, *, id_col, text_col, label_col, held_out, max_labelled) -> NoisyOr:
    """The model of a bounded sample; its features are no more than the sample has words and beginnings of words."""
    sample = _sample(docs, labels, id_col, text_col, label_col, held_out, max_labelled)
    features = _screened(sample, least=3, lift=4.0)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in slices(offsets, CHUNK):
                doc, _, _, owner, hashes = sentences(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                owner, place = matched(features, owner, hashes)
                parts = (batch.column("label").slice(a, b - a).to_numpy(), batch.column("weight").slice(a, b - a).to_numpy(), doc, owner, place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in zip(parts, ("i4", "f8", "i4", "i4", "i4"), strict=True)], ["label", "weight", "doc", "owner", "place"]
                )

    label, weight, doc, owner, place, docs_before, sents_before = [], [], [], [], [], 0, 0
    for r in sample.mapInArrow(run, "label binary, weight binary, doc binary, owner binary, place binary").collect():
        own, in_doc = np.frombuffer(r.label, "i4"), np.frombuffer(r.doc, "i4")
        label.append(own)
        weight.append(np.frombuffer(r.weight, "f8"))
        doc.append(in_doc + docs_before)
        owner.append(np.frombuffer(r.owner, "i4") + sents_before)
        place.append(np.frombuffer(r.place, "i4"))
        docs_before, sents_before = docs_before + len(own), sents_before + len(in_doc)
    if not label:
        return NoisyOr(0.5)
    return fit(np.concatenate(doc), np.concatenate(owner), np.concatenate(place), features, np.concatenate(label), np.concatenate(weight))


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out: tuple[int, int] = (4, 2),
    max_labelled: int = 3000,
    offending: float = 0.3,
) -> DataFrame:
    """(id, held_out, score, sentences) for every row.

    sentences: array of (start, end, score) in bytes of the UTF-8 text, those that score ``offending`` or more.
    Rows with crc32(id as text) mod held_out[0] = held_out[1] never train.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, held_out=held_out, max_labelled=max_labelled)
    flat = not len(model.features)

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets, CHUNK):
                n = b - a
                doc, start, end, owner, hashes = sentences(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                p = model.sentence_scores(len(doc), owner, hashes)
                score = model.document_scores(n, doc, p) if not flat else np.full(n, model.share)
                worst = np.flatnonzero(p >= offending) if not flat else np.zeros(0, np.int64)
                cuts = np.searchsorted(doc[worst], np.arange(n + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(start[worst]), pa.array(end[worst]), pa.array(p[worst])], ["start", "end", "score"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(score), pa.ListArray.from_arrays(pa.array(cuts), spans).cast(kind)], ["id", "score", "sentences"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(run, "id long, score double, sentences array<struct<start: long, end: long, score: double>>")
    out = F.coalesce(F.pmod(crc32_text("id"), F.lit(held_out[0])) == held_out[1], F.lit(False))
    return scored.select("id", out.alias("held_out"), "score", "sentences")
