"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian over a dozen statistics of the text. The moments of the classes are summed over all labelled
training rows in Spark; the driver sees only sums. A class covariance is shrunk towards the pooled one and towards a
multiple of the identity, its Cholesky factor is inverted once and kept with the model, and a score is the logistic of
the difference of the two log densities (Mahalanobis distances, log determinants and class shares).

Null text counts as empty; an empty text has all statistics zero and gets a score like any other. With labels of one
class only, or none, the score is the smoothed share of ones. Repeated rows get equal scores, rows with a null id are
scored but never train, extra columns are ignored and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import crc32_text, slices, stored, text_buffers
from annolake.llm.ngram_jaccard import CHUNK, word_hashes

STATISTICS = ("words", "word_length", "symbols", "upper", "digits", "marks", "lines", "vocabulary", "repeats", "trigrams", "longest", "spread")

_KIND = np.zeros(256, np.int8)  # 0 other symbols
_KIND[97:123] = _KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in ".,;:?'\"()-"]] = 5


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    kinds = _KIND[data]
    words, at = word_hashes(data, offsets)
    for r in range(n):
        a, b, size = offsets[r], offsets[r + 1], offsets[r + 1] - offsets[r]
        w = words[at[r] : at[r + 1]]
        if not size or not len(w):
            continue
        count = np.bincount(kinds[a:b], minlength=6)
        share = count / size
        values, times = np.unique(w, return_counts=True)
        grams = len(w)
        if len(w) >= 3:
            three = w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(5) + w[2:] * np.uint64(7)
            grams = len(np.unique(three)) * len(w) / len(three)
        lines = np.count_nonzero(data[a:b] == 10)
        out[r] = (
            np.log1p(len(w)),
            np.log((size - count[4]) / len(w)),
            np.sqrt(share[0]),
            np.sqrt(share[2]),
            np.sqrt(share[3]),
            np.sqrt(share[5]),
            np.sqrt(lines / len(w)),
            np.log(len(values) / len(w)),
            np.sqrt(np.count_nonzero(w[1:] == w[:-1]) / len(w)),
            np.log(grams / len(w)),
            np.log(times.max() / len(w)),
            np.sqrt(count[2] / (count[1] + 1.0)),
        )
    return out


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): the statistics of every whole text."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets, CHUNK):
                x = statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), rows], ["id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverted Cholesky factors of class covariances, and the constant of the log-density difference."""

    share: float
    means: np.ndarray | None = None
    whiten: np.ndarray | None = None
    constant: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        far = [(((x - m) @ w.T) ** 2).sum(axis=1) for m, w in zip(self.means, self.whiten, strict=True)]
        return 1 / (1 + np.exp(-np.clip(self.constant + (far[0] - far[1]) / 2, -500, 500)))


def moments(rows: DataFrame, size: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """{label: (rows, sums, sums of products)} of (label, x), added up in Spark."""
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(size)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i, j in pairs]
    found = {}
    for r in rows.groupBy("label").agg(F.count("*").alias("rows"), *sums, *products).collect():
        p = np.zeros((size, size))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        found[r.label] = (float(r["rows"]), np.array([r[f"s{i}"] for i in range(size)]), p)
    return found


def fit(found: dict, to_pooled: float = 0.1, to_identity: float = 0.02) -> Discriminant:
    ones, zeros = (found[k][0] if k in found else 0.0 for k in (1, 0))
    share = (ones + 1) / (ones + zeros + 2)
    if min(ones, zeros) < 2:
        return Discriminant(share)
    means, own = {}, {}
    for k in (0, 1):
        n, s, p = found[k]
        means[k] = s / n
        own[k] = p / n - np.outer(means[k], means[k])
    pooled = (own[0] * zeros + own[1] * ones) / (ones + zeros)
    scale = np.diag(np.diag(pooled) + 1e-6)
    whiten, constant = [], np.log(share / (1 - share))
    for k in (0, 1):
        c = (1 - to_pooled - to_identity) * own[k] + to_pooled * pooled + to_identity * scale
        factor = np.linalg.cholesky(c)
        whiten.append(np.linalg.inv(factor))
        constant += (1 if k == 0 else -1) * np.log(np.diag(factor)).sum()
    return Discriminant(share, np.stack([means[0], means[1]]), np.stack(whiten), float(constant))


def train(x: DataFrame, labels: DataFrame, *, id_col: str, label_col: str, held_out: tuple[int, int]) -> Discriminant:
    """The model of all labelled rows of (id, x) whose crc32(id as text) mod held_out[0] is not held_out[1]."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.pmod(crc32_text("id"), F.lit(held_out[0])) != held_out[1]).dropDuplicates()
    return fit(moments(x.join(known, "id"), len(STATISTICS)))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    held_out: tuple[int, int] = (5, 0),
) -> DataFrame:
    """(id, held_out, score) for every row; rows with crc32(id as text) mod held_out[0] = held_out[1] never train."""
    x = stored(described(docs, id_col, text_col), "statistics")
    model = train(x, labels, id_col=id_col, label_col=label_col, held_out=held_out)

    def run(batches):
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(values))], ["id", "score"])

    out = F.pmod(crc32_text("id"), F.lit(held_out[0])) == held_out[1]
    return x.mapInArrow(run, "id long, score double").select("id", F.coalesce(out, F.lit(False)).alias("held_out"), "score")


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    *,
    least: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    held_out: tuple[int, int] = (5, 0),
) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose score is ``least`` or more."""
    x = stored(described(docs, id_col, text_col), "statistics")
    model = train(x, labels, id_col=id_col, label_col=label_col, held_out=held_out)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(at))
            for a, b in slices(offsets, CHUNK):
                x = statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield batch.slice(a, b - a).filter(pa.array(model.scores(x) >= least))

    return docs.mapInArrow(run, docs.schema)
