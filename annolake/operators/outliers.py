"""Isolation forest: trees over seeded subsamples, one group each, and scores by path length where the rows lie.

Each tree takes its own subsample without replacement, drawn by rank (``sampling``), so what is shuffled is trees times
sample size, whatever the table. The forest is then at most trees * (2 * sample - 1) nodes, a size fixed by the
parameters, and goes to the tasks that score. The threshold for a share of outliers is an order statistic: scores are
counted by ranges, and only the range in which it falls is sorted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.operators.sampling import directory, distinct_numbers

EULER = 0.5772156649015329
RANGES = 1 << 16
NODES = "tree int, node int, feature int, cut double, left int, right int, depth double"


def usual_path(n: int) -> float:
    """Mean depth at which a search among n rows ends."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def grown(rows: np.ndarray, most: int, rng: np.random.Generator) -> list[tuple]:
    """(node, feature, cut, left, right, depth) of one tree; a leaf has feature -1, and the depth that its rows count for."""
    out, todo, made = [], [(0, np.arange(len(rows)), 0)], 1
    while todo:
        node, own, depth = todo.pop()
        low, high = rows[own].min(axis=0), rows[own].max(axis=0)
        wide = np.flatnonzero(high > low)
        if depth >= most or len(own) <= 1 or not len(wide):
            out.append((node, -1, 0.0, -1, -1, depth + usual_path(len(own))))
            continue
        f = int(rng.choice(wide))
        cut = float(rng.uniform(low[f], high[f]))
        below = rows[own, f] <= cut
        out.append((node, f, cut, made, made + 1, 0.0))
        todo += [(made, own[below], depth + 1), (made + 1, own[~below], depth + 1)]
        made += 2
    return sorted(out)


def forest(vectors: DataFrame, trees: int, sample: int, seed: int, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """NODES of ``trees`` trees, each grown on ``sample`` rows (all, if there are fewer)."""
    rows = vectors.where(F.col(vector).isNotNull()).select(key, F.col(vector).alias("v"))
    ranks = directory(rows, key, seed=seed).select(key, "rank", "n")
    n = ranks.agg(F.max("n")).first()[0] or 0
    most = max(1, math.ceil(math.log2(max(min(sample, n), 2))))
    drawn = vectors.sparkSession.range(trees).select(F.col("id").cast("int").alias("tree"), F.explode(distinct_numbers(seed, F.col("id"), F.lit(n).cast("long"), sample)).alias("rank"))
    chosen = drawn.join(ranks.select(key, "rank"), "rank").join(rows, key)

    def run(table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        own = table.sort_by("rank").column("v").combine_chunks()
        nodes = grown(own.flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1), most, np.random.default_rng([seed, tree]))
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]
        columns = [pa.array([tree] * len(nodes), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*nodes, strict=True), kinds, strict=True))]
        return pa.table(columns, names=[f.split()[0] for f in NODES.split(", ")])

    return chosen.groupBy("tree").applyInArrow(run, NODES)


def paths(rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The depth that each row counts for in one tree."""
    at = np.zeros(len(rows), np.int64)
    going = np.flatnonzero(feature[at] >= 0)
    while len(going):
        node = at[going]
        at[going] = np.where(rows[going, feature[node]] <= cut[node], left[node], right[node])
        going = going[feature[at[going]] >= 0]
    return depth[at]


def scored(vectors: DataFrame, nodes: DataFrame, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """(key, path): the mean depth that each row counts for over all trees; rows without a vector are left out."""
    whole = nodes.orderBy("tree", "node").toArrow()
    columns = [whole.column(c).to_numpy() for c in ("feature", "cut", "left", "right", "depth")]
    starts = np.flatnonzero(whole.column("node").to_numpy() == 0).tolist() if whole.num_rows else []
    shared = vectors.sparkSession.sparkContext.broadcast((columns, [*starts, whole.num_rows]))

    def run(batches):
        columns, edges = shared.value
        for batch in batches:
            v = batch.column(1)
            rows = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1) if len(v) else np.zeros((0, 1))
            total = np.zeros(len(rows))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                total += paths(rows, *(c[a:b] for c in columns))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total / max(len(edges) - 1, 1))], ["key", "path"])

    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key), F.col(vector))
    return rows.mapInArrow(run, f"key {vectors.schema[key].dataType.simpleString()}, path double").select(F.col("key").alias(key), "path")


def value_at(rows: DataFrame, column: str, share: float) -> float | None:
    """The quantile of a column of values from 0 to 1, between the two nearest order statistics in proportion; None without rows."""
    spans = rows.where(F.col(column).isNotNull()).groupBy(F.floor(F.col(column) * RANGES).alias("span")).agg(F.count("*").alias("n"))
    upto = W.orderBy("span").rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = spans.select("span", "n", F.sum("n").over(upto).alias("upto")).persist()
    try:
        n = spans.agg(F.max("upto")).first()[0]
        if n is None:
            return None
        place = share * (n - 1)
        found = []
        for k in (math.floor(place), math.ceil(place)):
            span, upto = spans.where(F.col("upto") > k).agg(F.min(F.struct("span", "upto", "n")).alias("s")).select("s.span", F.col("s.upto") - F.col("s.n")).first()
            own = rows.where(F.floor(F.col(column) * RANGES) == span)
            counts = own.groupBy(column).agg(F.count("*").alias("n"))
            reached = F.sum("n").over(W.orderBy(column).rowsBetween(W.unboundedPreceding, W.currentRow))
            found.append(counts.select(column, (reached + upto).alias("r")).where(F.col("r") > k).agg(F.min(column)).first()[0])
        return found[0] + (found[1] - found[0]) * (place - math.floor(place))
    finally:
        spans.unpersist()


def outliers(vectors: DataFrame, keep, *, trees: int = 500, sample: int = 256, contamination: float = 0.002, seed: int = 0, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """(key, score, outlier): the share ``contamination`` of rows with the highest scores. ``keep`` stores a DataFrame and reads it again."""
    n = vectors.where(F.col(vector).isNotNull()).count()
    usual = usual_path(min(sample, n))
    paths_of = scored(vectors, forest(vectors, trees, sample, seed, key, vector), key, vector)
    rows = keep(paths_of.select(key, (F.pow(F.lit(2.0), -F.col("path") / usual) if usual else F.lit(0.5)).alias("score")))
    edge = value_at(rows, "score", 1 - contamination)
    return rows.withColumn("outlier", F.col("score") > F.lit(edge))
