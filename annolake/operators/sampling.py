"""Draws from a pool, each row's its own, by rank: a directory numbers the pool, a draw is one equi join with it.

The directory puts the pool in hashed order without a window over all of it: rows are counted by ranges of their hash,
the running sums over the ranges (at most ``ranges`` for each group) say where each range starts, and a window within a
range does the rest. What is drawn follows from the seed and the row's key alone, whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.operators.curation import hashed

FEW_GROUPS = 100_000


def _number(seed: int, *parts: Column) -> Column:
    """A number below 2 ** 32 by seed and parts, the same in every engine that has md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def directory(pool: DataFrame, key: str, group: str | None = None, seed: int = 0, ranges: int = 4096) -> DataFrame:
    """(group, key, rank, n): each row's place, from 0, in the hashed order of its group of ``n``; without ``group`` all are one."""
    rows = pool.select((F.col(group) if group else F.lit(0)).alias("group"), key, hashed(seed, key).alias("h"))
    rows = rows.withColumn("range", F.shiftright(F.col("h") * ranges, 32))
    counts = rows.groupBy("group", "range").agg(F.count("*").alias("m"))
    own = W.partitionBy("group")
    before = F.coalesce(F.sum("m").over(own.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("group", "range", before.alias("before"), F.sum("m").over(own).alias("n"))
    within = F.row_number().over(W.partitionBy("group", "range").orderBy("h", key)) - 1
    return rows.withColumn("within", within).join(counts, ["group", "range"]).select("group", key, (F.col("before") + F.col("within")).alias("rank"), "n")


def distinct_numbers(seed: int, key: Column, below: Column, n: int) -> Column:
    """array of ``n`` different numbers from 0 up to ``below``, all of them if there are fewer; each set is as likely.

    One number is drawn for each place; where it was drawn before, the highest one that the place may hold stands in.
    """
    k = F.least(F.lit(n).cast("long"), below)

    def place(drawn: Column, j: Column) -> Column:
        top = below - k + j
        t = _number(seed, key, j) % (top + 1)
        return F.concat(drawn, F.array(F.when(F.array_contains(drawn, t), top).otherwise(t)))

    none = F.array().cast("array<long>")
    return F.when(k > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), k - 1), none, place)).otherwise(none)


def others_drawn(wanted: DataFrame, pool: DataFrame, without: str, key: str, n: int, seed: int = 0, replace: bool = False) -> DataFrame:
    """(without, draw, key): for each row of ``wanted`` its own ``n`` draws from ``pool``, itself left out.

    Without ``replace`` the draws of a row differ, and a pool of fewer gives all of it; with it they may repeat. An
    empty pool gives no rows.
    """
    ranks = directory(pool, key, seed=seed)
    size = ranks.agg(F.max("n").alias("n")).first()["n"] or 0
    own = wanted.select(without).join(ranks.select(F.col(key).alias(without), F.col("rank").alias("own")), without, "left")
    below = F.lit(size).cast("long") - F.col("own").isNotNull().cast("long")
    if replace:
        drawn = F.when(below > 0, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: _number(seed, F.col(without), j) % below))
    else:
        drawn = distinct_numbers(seed, F.col(without), below, n)
    draws = own.select(without, "own", F.posexplode(drawn).alias("draw", "t"))
    draws = draws.select(without, "draw", (F.col("t") + F.coalesce((F.col("t") >= F.col("own")).cast("long"), F.lit(0))).alias("rank"))
    return draws.join(ranks.select("rank", key), "rank").select(without, "draw", key)


def pairs_drawn(wanted: DataFrame, pool: DataFrame, index: str, key: str, group: str, seed: int = 0) -> DataFrame:
    """(index, first, second, alike): a pair of ``pool`` for each row of ``wanted``, two of one group for an even index, of two for an odd one.

    The group is drawn first, each as likely, then the member. Where there is no second member or no second group, the
    index gives no pair.
    """
    members = directory(pool.where(F.col(group).isNotNull()), key, group, seed)
    groups = members.groupBy("group").agg(F.max("n").alias("n"))
    n_groups = groups.count()
    places = directory(groups.select(F.col("group").alias("g")), "g", seed=seed).select(F.col("g").alias("group"), F.col("rank").alias("at"))
    groups = groups.join(places, "group")
    if n_groups <= FEW_GROUPS:
        groups = F.broadcast(groups)
    i = F.col(index)
    alike = i % 2 == 0
    chosen = wanted.select(index).where(F.lit(n_groups) > F.when(alike, 0).otherwise(1)).withColumn("at", _number(seed, i, F.lit("group")) % max(n_groups, 1))
    first = chosen.join(groups, "at").withColumn("a", _number(seed, i, F.lit("first")) % F.col("n"))
    step = _number(seed, i, F.lit("other")) % max(n_groups - 1, 1)
    other = F.when(alike, F.col("at")).otherwise(step + (step >= F.col("at")).cast("long"))
    second = first.select(index, F.col("group").alias("group_a"), "a", F.col("n").alias("n_a"), other.alias("at")).join(groups, "at")
    left = F.when(alike, F.col("n") - 1).otherwise(F.col("n"))
    t = _number(seed, i, F.lit("second")) % F.greatest(left, F.lit(1))
    b = F.when(alike, t + (t >= F.col("a")).cast("long")).otherwise(t)
    placed = second.where(left > 0).select(index, "group_a", "a", F.col("group").alias("group_b"), b.alias("b"), alike.cast("int").alias("alike"))
    side = lambda g, r, name: members.select(F.col("group").alias(g), F.col("rank").alias(r), F.col(key).alias(name))
    return placed.join(side("group_a", "a", "first"), ["group_a", "a"]).join(side("group_b", "b", "second"), ["group_b", "b"]).select(index, "first", "second", "alike")
