"""Isolation forest: the same trees walked plainly, thresholds, and rows that stand apart."""

from __future__ import annotations

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolake.operators import outliers, sampling

DATA = "/root/testdata/sf0.001"


def walked(trees, row):
    total = 0.0
    for nodes in trees.values():
        at = 0
        while nodes[at].feature >= 0:
            at = nodes[at].left if row[nodes[at].feature] <= nodes[at].cut else nodes[at].right
        total += nodes[at].depth
    return total / len(trees)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_scores_are_those_of_the_same_trees(spark):
    v = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    nodes = outliers.forest(v, 12, 64, 3)
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r.tree, {})[r.node] = r
    assert len(trees) == 12 and all(len(t) <= 127 for t in trees.values())
    got = {r.vec_id: r.path for r in outliers.scored(v, nodes).collect()}
    rows = {r.vec_id: r.v for r in v.collect()}
    assert got.keys() == rows.keys() and all(got[k] == pytest.approx(walked(trees, rows[k])) for k in rows)
    again = {(r.tree, r.node): r for r in outliers.forest(v.repartition(7), 12, 64, 3).collect()}
    assert again == {(r.tree, r.node): r for r in nodes.collect()}  # whatever the partitions


def test_leaves_count_the_rows_below(spark):
    rows = np.array([[0.0, 5.0], [1.0, 5.0], [9.0, 5.0], [9.0, 5.0]])
    for seed in range(20):
        nodes = outliers.grown(rows, 2, np.random.default_rng(seed))
        assert all(n[1] in (-1, 0) for n in nodes)  # the second column never parts rows
        assert sum(n[1] < 0 for n in nodes) == sum(n[1] >= 0 for n in nodes) + 1
    assert outliers.grown(rows[2:], 8, np.random.default_rng(0)) == [(0, -1, 0.0, -1, -1, outliers.usual_path(2))]
    assert outliers.usual_path(1) == 0 and outliers.usual_path(2) == 1
    assert outliers.usual_path(256) == pytest.approx(2 * (math.log(255) + outliers.EULER) - 2 * 255 / 256)


def test_what_stands_apart_is_found(spark):
    rng = random.Random(5)
    data = [(i, [rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(400)] + [(1000 + i, [9.0 + i, -9.0, 9.0]) for i in range(4)] + [(2000, None)]
    v = spark.createDataFrame(data, "vec_id long, v array<double>")
    out = outliers.outliers(v, lambda df: df, trees=60, contamination=0.01).collect()
    assert len(out) == 404 and {r.vec_id for r in out if r.outlier} >= {1000, 1001, 1002, 1003} and sum(r.outlier for r in out) <= 5
    assert all(0 < r.score < 1 for r in out)
    assert outliers.outliers(v.where("vec_id = 2000"), lambda df: df).collect() == []


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.98, 1.0])
def test_quantiles_without_a_sort(spark, share):
    rng = random.Random(1)
    values = [rng.choice([0.25, 0.25000001, rng.random()]) for _ in range(501)]
    rows = spark.createDataFrame([(x,) for x in values] + [(None,)], "x double")
    assert outliers.value_at(rows, "x", share) == pytest.approx(float(np.quantile(values, share)), abs=1e-12)


def test_directories_number_each_group(spark):
    pool = spark.createDataFrame([(i, i % 3) for i in range(100)], "id long, g int")
    rows = sampling.directory(pool, "id", "g", seed=2, ranges=4).collect()
    for g in range(3):
        own = [r for r in rows if r.group == g]
        assert sorted(r["rank"] for r in own) == list(range(len(own))) and {r.n for r in own} == {len(own)}


def test_draws_are_each_rows_own(spark):
    pool = spark.range(30).withColumnRenamed("id", "item")
    wanted = spark.range(25, 60).withColumnRenamed("id", "row")
    got = {}
    for r in sampling.others_drawn(wanted, pool, "row", "item", 5, seed=1).collect():
        got.setdefault(r.row, []).append(r.item)
    assert len(got) == 35 and all(len(set(x)) == 5 and k not in x for k, x in got.items())
    assert len({tuple(sorted(x)) for x in got.values()}) > 30
    every = sampling.others_drawn(wanted, pool, "row", "item", 99, seed=1).groupBy("row").agg(F.count_distinct("item").alias("n")).collect()
    assert all(r.n == (29 if r.row < 30 else 30) for r in every)
    again = sampling.others_drawn(wanted, pool.limit(2), "row", "item", 9, seed=1, replace=True).groupBy("row").count().collect()
    assert all(r["count"] == 9 for r in again)
    assert sampling.others_drawn(wanted, pool.limit(0), "row", "item", 3).collect() == []
    counts = [r["count"] for r in sampling.others_drawn(spark.range(100, 3100).withColumnRenamed("id", "row"), pool, "row", "item", 3).groupBy("item").count().collect()]
    assert len(counts) == 30 and min(counts) > 200 and max(counts) < 400  # 300 each, if all are as likely


def test_pairs_of_alike_and_of_different(spark):
    pool = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(31)] + [(99, "alone"), (98, None)], "id long, g string")
    group = {r.id: r.g for r in pool.collect()}
    rows = sampling.pairs_drawn(spark.range(400).withColumnRenamed("id", "k"), pool, "k", "id", "g").collect()
    assert all(r.first != r.second and (group[r.first] == group[r.second]) == (r.k % 2 == 0) == bool(r.alike) for r in rows)
    assert {r.k for r in rows if r.k % 2} == set(range(1, 400, 2))  # only a class of one has no pair of its own
    assert {group[r.first] for r in rows} == {"a", "b", "c", "alone"}
    one = spark.createDataFrame([(1, "a"), (2, "a")], "id long, g string")
    assert {r.k % 2 for r in sampling.pairs_drawn(spark.range(40).withColumnRenamed("id", "k"), one, "k", "id", "g").collect()} == {0}
