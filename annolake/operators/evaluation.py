"""Detection and classification measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.functions.vectors import argmax, total
from annolake.operators.matching import greedy_match, iou_pairs


def detection_measures(boxes: DataFrame, truth: int, found: int, least: float) -> DataFrame:
    """One row: counts, recall, precision, f1, mean IoU of one-to-one matches, and how often their labels agree."""
    pairs = iou_pairs(boxes, truth, found, least)
    hits = greedy_match(pairs).join(pairs.select("image_id", "ia", "ib", (F.col("cls_a") == F.col("cls_b")).alias("same")), ["image_id", "ia", "ib"])
    sizes = boxes.agg(F.count_if(F.col("src") == truth).alias("n_gt"), F.count_if(F.col("src") == found).alias("n_det"))
    matched = hits.agg(F.count("*").alias("tp"), F.avg("iou").alias("mean_iou"), F.count_if("same").alias("label_ok"))
    recall, precision = F.col("tp") / F.greatest("n_gt", F.lit(1)), F.col("tp") / F.greatest("n_det", F.lit(1))
    f1 = F.when(recall + precision > 0, 2 * recall * precision / (recall + precision)).otherwise(F.lit(0.0))
    return sizes.join(matched).select("n_gt", "n_det", "tp", recall.alias("recall"), precision.alias("precision"), f1.alias("f1"), F.coalesce("mean_iou", F.lit(0.0)).alias("mean_iou"), "label_ok", F.col("tp").alias("label_total"))


def error_rates(items: DataFrame, truth: str, guess: str) -> DataFrame:
    """(class, n, errors, percent) for each class and, with class null, for all."""
    out = items.rollup(truth).agg(F.count("*").alias("n"), F.count_if(F.col(truth) != F.col(guess)).alias("errors"))
    return out.select(F.col(truth).alias("class"), "n", "errors", (100 * F.col("errors") / F.col("n")).alias("percent"))


def topk_accuracy(items: DataFrame, probs: str, truth: str, k: int) -> DataFrame:
    """Share of rows whose true class is among the k most likely; of equal ones the lower class comes first."""
    p, t = F.col(probs), F.col(truth)
    own = F.element_at(p, (t + 1).cast("int"))
    ahead = F.size(F.filter(p, lambda x, i: (x > own) | ((x == own) & (i < t))))
    return items.agg(F.count("*").alias("n"), F.avg((ahead < k).cast("double")).alias("accuracy"))


def weighted_vote(items: DataFrame, key: str, probs: str, weight: Column, classes: int) -> DataFrame:
    """(key, top, share): weighted mean of each key's probability vectors, and its first largest class."""
    sums = [F.sum(F.col(probs)[c] * weight) for c in range(classes)]
    voted = items.groupBy(key).agg(F.array(*sums).alias("p"), F.sum(weight).alias("w"))
    return voted.select(key, argmax(F.col("p")).alias("top"), (F.array_max("p") / F.col("w")).alias("share"))


def histogram(items: DataFrame, value: str, bins: int, low: float, high: float) -> DataFrame:
    """(bin, n) for all ``bins``, empty ones too; values outside go to the first or last bin."""
    place = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col(value) - low) * bins / (high - low)))).cast("int")
    every = items.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    counted = items.where(F.col(value).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def quantile_bin(bins: DataFrame, ratio: float) -> DataFrame:
    """The first bin whose running count exceeds ``ratio`` of all, else the last; ``bins`` is small (bin, n)."""
    run = W.orderBy("bin")
    seen = bins.select("bin", F.sum("n").over(run).alias("upto"), F.sum("n").over(W.partitionBy(F.lit(1))).alias("whole"))
    return seen.agg(F.coalesce(F.min(F.when(F.col("upto") > F.col("whole") * ratio, F.col("bin"))), F.max("bin")).alias("bin"))


def crosstab(items: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of both values together, of each alone and of all; null marks a total."""
    out = items.where(F.col(a).isNotNull() & F.col(b).isNotNull()).cube(a, b).agg(F.count("*").alias("n"))
    return out.select(F.col(a).alias("a"), F.col(b).alias("b"), "n")


def adjacent_outliers(items: DataFrame, key: str, order: str, value: str, most: float) -> DataFrame:
    """(key, pairs, rate): share of neighbours in order whose values differ by more than ``most``."""
    step = F.abs(F.col(value) - F.lag(value).over(W.partitionBy(key).orderBy(*order.split(","))))
    out = items.select(key, step.alias("step")).where("step is not null").groupBy(key)
    return out.agg(F.count("*").alias("pairs"), F.avg((F.col("step") > most).cast("double")).alias("rate"))


def soft_max(values: Column) -> Column:
    e = F.transform(values, F.exp)
    return F.transform(e, lambda x: x / total(e))
