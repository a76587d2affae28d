"""Composition of datasets: sampling, splitting, merging, quotas and clean-up.

Random choices are orders by a hash of a seed and the key, so they can be repeated and need no driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hashed(seed: int, *keys: str) -> Column:
    """A number below 2 ** 32 for a row, the same in every engine that has md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def stride_sample(rows: DataFrame, sequence: str, order: list[str], stride: int) -> DataFrame:
    """Every ``stride``-th row of each sequence, the first included."""
    at = F.row_number().over(W.partitionBy(sequence).orderBy(*order)) - 1
    return rows.withColumn("_at", at).where(F.col("_at") % stride == 0).drop("_at")


def top_n(rows: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(by).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def random_n(rows: DataFrame, by: str, key: str, n: int, seed: int = 0) -> DataFrame:
    return top_n(rows, by, [hashed(seed, key), F.col(key)], n)


def neighbours(rows: DataFrame, sequence: str, order: str, value: str) -> DataFrame:
    """(sequence, order, before, value): each row with the one before it; a first row has none."""
    out = rows.select(sequence, order, F.lag(value).over(W.partitionBy(sequence).orderBy(order)).alias("before"), F.col(value).alias("value"), F.row_number().over(W.partitionBy(sequence).orderBy(order)).alias("_r"))
    return out.where("_r > 1").drop("_r")


def merged(sources: dict[str, DataFrame], classes: DataFrame, split: str | None = None) -> DataFrame:
    """(stem, cls, source[, split]) of all sources; ``classes`` (source, cls, to) renumbers, what it lacks is dropped, and
    an image whose boxes are all dropped is gone. Stems carry their source's name. ``split`` names a column of the
    sources: test goes to valid, and rows of no known split are left out. ``classes`` is broadcast: dealt by
    class, the boxes of a frequent class would be sorted in one task."""
    every = None
    for name, rows in sources.items():
        kept = []
        if split is not None:
            rows = rows.where(F.col(split).isin("train", "valid", "test"))
            kept = [F.when(F.col(split) == "train", "train").otherwise("valid").alias("split")]
        own = rows.select(F.concat(F.lit(name + "_"), F.col("stem").cast("string")).alias("stem"), "cls", F.lit(name).alias("source"), *kept)
        every = own if every is None else every.unionByName(own)
    return every.join(F.broadcast(classes), ["source", "cls"]).select("stem", F.col("to").alias("cls"), "source", *(["split"] if split else []))


def pooled(images: dict[str, DataFrame], labels: dict[str, DataFrame]) -> DataFrame:
    """(name, source) of labelled images only, each named after its source."""
    out = None
    for source, rows in images.items():
        own = rows.join(labels[source].select("stem").distinct(), "stem", "left_semi")
        own = own.select(F.concat(F.lit(source + "_"), F.col("stem").cast("string")).alias("name"), F.lit(source).alias("source"))
        out = own if out is None else out.union(own)
    return out


def quota_fill(rows: DataFrame, key: str, category: str, quotas: list[tuple[str, int]], existing: DataFrame) -> DataFrame:
    """(key, category): for each category in turn the first free keys up to its quota, each key taken once."""
    free, chosen = rows.select(key, category).join(existing.select(key), key, "left_anti"), None
    for name, n in quotas:
        own = free.where(F.col(category) == name)
        own = own if chosen is None else own.join(chosen.select(key), key, "left_anti")
        own = own.orderBy(key).limit(n)
        chosen = own if chosen is None else chosen.union(own)
    return chosen


def split(rows: DataFrame, key: str, ratios: dict[str, float], by: str | None = None, seed: int = 0) -> DataFrame:
    """``rows`` with ``part``: each stratum in hashed order, cut at floor(n * ratio); the rest goes to the last part.

    A stratum is cut by counts over ranges of the hash first, so only the ranges in which a cut falls are put in order.
    """
    own = [by] if by else []
    h = rows.withColumn("_h", hashed(seed, key)).withColumn("_b", F.floor(F.col("_h") / (1 << 20)))
    sums = h.groupBy(*own, "_b").agg(F.count("*").alias("_m"))
    stratum = W.partitionBy(*own) if own else W.partitionBy(F.lit(0))
    sums = sums.select(*own, "_b", (F.sum("_m").over(stratum.orderBy("_b")) - F.col("_m")).alias("_before"), F.sum("_m").over(stratum).alias("_n"))
    placed = h.join(sums, [*own, "_b"]).withColumn("_r", F.col("_before") + F.row_number().over(W.partitionBy(*own, "_b").orderBy("_h", key)) - 1)
    names, part, upto = list(ratios), None, F.lit(0)
    for name in names[:-1]:
        upto = upto + F.floor(F.col("_n") * ratios[name])
        part = F.when(F.col("_r") < upto, name) if part is None else part.when(F.col("_r") < upto, name)
    return placed.withColumn("part", part.otherwise(names[-1])).select(*rows.columns, "part")


def orphans(images: DataFrame, labels: list[DataFrame], key: str) -> DataFrame:
    """Images that no label table has."""
    for rows in labels:
        images = images.join(rows.select(key).distinct(), key, "left_anti")
    return images


def in_range(value: Column, low: Column, high: Column) -> Column:
    """Inclusive; a missing bound lets everything pass."""
    return (low.isNull() | (value >= low)) & (high.isNull() | (value <= high))


def combinations(classes: DataFrame, name: str, most: int = 3) -> DataFrame:
    """(combo, r): all sets of two to ``most`` of a few classes, in order of name."""
    step = classes.select(F.col(name).alias("last"), F.col(name).alias("combo"))
    out, level = None, step
    for r in range(2, most + 1):
        level = level.join(classes.select(F.col(name).alias("next")), F.col("next") > F.col("last")).select(F.col("next").alias("last"), F.concat_ws("+", "combo", "next").alias("combo"))
        one = level.select("combo", F.lit(r).alias("r"))
        out = one if out is None else out.union(one)
    return out


def combination_members(combos: DataFrame, members: DataFrame, cls: str, key: str, pool: int, seed: int) -> DataFrame:
    """(combo, cls, key): for each class of a combination of ``combinations`` one of the first ``pool`` members of the class, by key.

    A class without members has no combination, so combinations that name one are left out.
    """
    ranked = members.select(cls, key, F.row_number().over(W.partitionBy(cls).orderBy(key)).alias("_r")).where(F.col("_r") <= pool)
    sizes = ranked.groupBy(cls).agg(F.max("_r").alias("_n"))
    parts = combos.select("combo", "r", F.explode(F.split("combo", r"\+")).alias(cls)).join(sizes, cls)
    whole = parts.withColumn("_have", F.count("*").over(W.partitionBy("combo"))).where(F.col("_have") == F.col("r"))
    drawn = whole.select("combo", cls, (hashed(seed, "combo", cls) % F.col("_n") + 1).cast("int").alias("_r"))
    return drawn.join(ranked, [cls, "_r"]).select("combo", cls, key)


def paged(rows: DataFrame, by: str, order: list[str], size: int) -> DataFrame:
    at = F.row_number().over(W.partitionBy(by).orderBy(*order)) - 1
    return rows.withColumn("page", F.floor(at / size)).withColumn("slot", (at % size).cast("long"))


def augmented(boxes: DataFrame, times: int, least_visible: float = 0.3) -> DataFrame:
    """Each box ``times`` over, shifted by a hash of its image and number, where enough of it stays in the unit square."""
    many = boxes.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("dx", (hashed(0, "image_id", "copy") % 512 - 256) / 1024)
    x1, x2 = F.greatest(F.lit(0.0), F.col("x1") + F.col("dx")), F.least(F.lit(1.0), F.col("x2") + F.col("dx"))
    seen = F.greatest(F.lit(0.0), x2 - x1) / (F.col("x2") - F.col("x1"))
    return many.where(seen >= least_visible).select("image_id", "src", "idx", "copy", x1.alias("nx1"), x2.alias("nx2"))
