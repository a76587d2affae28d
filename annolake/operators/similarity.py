"""Vectors: nearest neighbours, near-duplicate components, core sets, fingerprints and weighted density clusters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.functions.vectors import dot, normalised, squared_distance

BLOCK = 4096  # vectors to a block, as long as there are few blocks
LARGE = 65536  # vectors to a block at most
BLOCKS = 12  # blocks that many vectors are dealt into; each vector is shuffled once for each block


def _blocks(n: int) -> int:
    """Blocks for all pairs of ``n`` vectors: BLOCKS while these hold BLOCK to LARGE vectors, so that what is shuffled
    grows as the vectors do; only beyond BLOCKS * LARGE vectors are there more, so that a task stays bounded."""
    return max(1, min(-(-n // BLOCK), BLOCKS), -(-n // LARGE))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def similar_pairs(vectors: DataFrame, least: float, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """(a, b, sim), a < b: all pairs of unit vectors with an inner product of ``least`` or more.

    Vectors are dealt into blocks; each pair of blocks is one group and one matrix product, so a task holds two blocks
    and only pairs that pass are ever rows. Rows without a vector are left out.
    """
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    blocks = _blocks(rows.count())
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select(F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id", "v")

    def run(table: pa.Table) -> pa.Table:
        ids, side, v = table.column("id").to_numpy(), table.column("own").to_numpy(), _matrix(table.column("v"))
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        left, right = np.flatnonzero(side == x), np.flatnonzero(side == y)
        found = []
        others = v[right].T
        for k in range(0, len(left), 256):
            sims = v[left[k : k + 256]] @ others
            i, j = np.nonzero(sims >= least - 1e-9)
            found.append((ids[left[k + i]], ids[right[j]], sims[i, j]))
        a, b, s = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        keep = (a < b) if x == y else (a != b)
        return pa.table({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep], "sim": s[keep]})

    near = dealt.groupBy("x", "y").applyInArrow(run, "a long, b long, sim double")
    return near.where(F.round("sim", 9) >= least)


def nearest(queries: DataFrame, vectors: DataFrame, k: int, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """(query, id, sim, rank): the k vectors of highest inner product for each query, itself included; ties by id.

    Queries go in blocks against all vectors where these lie; each batch gives its best k, and only those are ranked.
    """
    spark = vectors.sparkSession
    q = queries.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    blocks = max(1, -(-q.count() // BLOCK))
    q = q.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none
        ids, qs = right.column("id").to_numpy(), left.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, sims = ids[order], np.round(_matrix(left.column("v")) @ _matrix(right.column("v"))[order].T, 9)
        top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
        return pa.table({"query": np.repeat(qs, top.shape[1]), "id": ids[top.ravel()], "sim": np.take_along_axis(sims, top, 1).ravel()})

    found = q.groupBy("block", "part").cogroup(rows.groupBy("block", "part")).applyInArrow(run, "query long, id long, sim double")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("sim"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def components(edges: DataFrame, keep) -> DataFrame:
    """(node, root) of undirected (a, b): each node points at the smallest node it can reach.

    ``keep`` stores a DataFrame and reads it again. Every round takes over the smallest root among a node's neighbours
    and then the root's own root, so long chains shorten by half.
    """
    both = keep(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    roots = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    while True:
        seen = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        joined = roots.join(seen, "node").select("node", F.least("root", "near").alias("r"), F.col("root").alias("old"))
        jump = joined.select(F.col("node").alias("r"), F.col("r").alias("further"))
        step = keep(joined.join(jump, "r").select("node", F.least("r", "further").alias("root"), "old"))
        roots = step.select("node", "root")
        if step.where("root <> old").isEmpty():
            return roots


def mean_vector(vectors: DataFrame, by: str, size: int, vector: str = "v") -> DataFrame:
    """(by, n, mean): the unit mean vector of each group."""
    mean = F.array(*[F.avg(F.col(vector)[k]) for k in range(size)])
    return vectors.where(F.col(vector).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), mean.alias("m")).select(by, "n", normalised(F.col("m")).alias("mean"))


def fingerprints(members: DataFrame, key: str, cluster: str) -> DataFrame:
    """(key, fingerprint): the set of clusters that an image's crops fall in."""
    return members.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(cluster)).cast("array<string>"), ",").alias("fingerprint"))


def first_of_each(marks: DataFrame, key: str, images: DataFrame | None = None) -> DataFrame:
    """(key) of the first image for each fingerprint; with ``images`` those without a fingerprint stay too."""
    kept = marks.groupBy("fingerprint").agg(F.min(key).alias(key)).select(key)
    return kept if images is None else kept.union(images.select(key).join(marks, key, "left_anti"))


def nearest_to_centre(vectors: DataFrame, centres: DataFrame, cluster: str, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """(cluster, key): the member closest to its cluster's ``centre``; of equals the smallest key."""
    far = F.round(squared_distance(F.col(vector), F.col("centre")), 9)
    joined = vectors.join(centres, cluster)
    return joined.groupBy(cluster).agg(F.min_by(key, F.struct(far, key)).alias(key))


def core_set(vectors: DataFrame, target: int, seed: int = 0, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """(cluster, key): one representative for each of at most ``target`` k-means clusters."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.where(F.col(vector).isNotNull()).withColumn("features", array_to_vector(F.col(vector)))
    model = KMeans(k=target, seed=seed, maxIter=10, predictionCol="cluster").fit(rows)
    centres = vectors.sparkSession.createDataFrame([(k, [float(x) for x in c]) for k, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    return nearest_to_centre(model.transform(rows).withColumn(vector, vector_to_array("features")), centres, "cluster", key, vector)


def pairwise_percent(vectors: DataFrame, by: str, key: str = "vec_id", vector: str = "v") -> DataFrame:
    """(by, a, b, percent): whole-number similarity of all pairs within a small group, a < b."""
    left = vectors.select(by, F.col(key).alias("a"), F.col(vector).alias("va"))
    right = vectors.select(by, F.col(key).alias("b"), F.col(vector).alias("vb"))
    sim = F.round(dot(F.col("va"), F.col("vb")), 9)
    return left.join(right, by).where("a < b").select(by, "a", "b", (sim * 100).cast("int").alias("percent"))


def density_clusters(items: DataFrame, pairs: DataFrame, least_weight: float, keep, key: str = "id", weight: Column | None = None) -> DataFrame:
    """(key, cluster): items whose neighbourhood weighs ``least_weight`` are cores; cores in reach share a cluster, other
    items join the lowest cluster in reach, and those without any are noise and left out. ``pairs``: neighbours (a, b)."""
    w = items.select(F.col(key).alias("a"), (weight if weight is not None else F.col("weight")).alias("w"))
    both = pairs.select("a", "b").union(pairs.select("b", "a")).union(w.select("a", F.col("a").alias("b"))).distinct()
    both = keep(both)
    mass = both.join(w.select(F.col("a").alias("b"), "w"), "b").groupBy("a").agg(F.sum("w").alias("mass"))
    cores = keep(mass.where(F.col("mass") >= least_weight).select("a"))
    linked = both.join(cores, "a").join(cores.select(F.col("a").alias("b")), "b").select("a", "b")
    roots = components(linked.where("a <= b"), keep)  # which adds the other direction itself
    reach = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("cluster"))
    return reach.select(F.col("a").alias(key), "cluster")
