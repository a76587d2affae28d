"""Rules by which frames, objects and results are chosen, numbered and put in order for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the annotation format.
EXCLUDED_VALUE, EXCLUDED_CONF = -2, -1.0
SHOWN_UNDER, SHOWN_OVER = 80, 100


def of_classes(cls: Column, wanted: list[int]) -> Column:
    """Whether a class is wanted; an empty list wants all."""
    return cls.isin(wanted) if wanted else F.lit(True)


def uncertain_frames(objects: DataFrame, frame: str, conf: str, most: float) -> DataFrame:
    """(frame, min_conf) of frames whose least confidence is ``most`` or less; a frame without objects counts as 1."""
    least = objects.groupBy(frame).agg(F.coalesce(F.min(conf), F.lit(1.0)).alias("min_conf"))
    return least.where(F.col("min_conf") <= most)


def excluded_if(value: Column, conf: Column, over: float) -> tuple[Column, Column]:
    """(value, conf), set to the excluded ones where ``over`` < conf <= 1."""
    sure = (conf > over) & (conf <= 1)
    return F.when(sure, EXCLUDED_VALUE).otherwise(value), F.when(sure, EXCLUDED_CONF).otherwise(conf)


def percent(conf: Column) -> Column:
    return (conf * 100).cast("int")


def percent_label(conf: Column) -> Column:
    """The percentage in brackets where it is under SHOWN_UNDER or over SHOWN_OVER, else empty."""
    c = percent(conf)
    return F.when((c < SHOWN_UNDER) | (c > SHOWN_OVER), F.concat(F.lit("("), c.cast("string"), F.lit(")"))).otherwise("")


def renumbered(objects: DataFrame, frame: str, position: str) -> DataFrame:
    """Objects with ``id`` 1..n by position within their frame, and the frame's ``next_id``."""
    own = W.partitionBy(frame)
    number = F.row_number().over(own.orderBy(position))
    return objects.withColumn("id", number).withColumn("next_id", F.count("*").over(own) + 1)


def first_present(supporters: Column, priority: list[str]) -> Column:
    """Of a map of sources, the value of the first one in ``priority`` that is there."""
    return F.coalesce(*[F.element_at(supporters, F.lit(p)) for p in priority])


def mean_boxes(rows: DataFrame, by: list[str], weight: str, least: float = 1.0) -> DataFrame:
    """Weighted mean corners of each cluster whose weights reach ``least``; conf is the sum of weights, at most 1."""
    total = F.sum(weight)
    means = [(F.sum(F.col(weight) * F.col(c)) / total).alias(c) for c in ("x1", "y1", "x2", "y2")]
    return rows.groupBy(*by).agg(total.alias("weights"), *means).where(F.col("weights") >= least).withColumn("conf", F.least("weights", F.lit(1.0)))


def padded(number: Column, digits: int = 4) -> Column:
    """A number with leading zeros, whole where it has more digits."""
    text = number.cast("string")
    return F.when(F.length(text) >= digits, text).otherwise(F.lpad(text, digits, "0"))


def numbered(rows: DataFrame, by: str, order: str) -> DataFrame:
    """Rows with ``part`` (_p0, _p1, ...) and ``serial`` (_0001, ...) by ``order`` within ``by``."""
    k = F.row_number().over(W.partitionBy(by).orderBy(order))
    return rows.withColumn("part", F.concat(F.lit("_p"), (k - 1).cast("string"))).withColumn("serial", F.concat(F.lit("_"), padded(k)))


def worst_first(results: DataFrame, truth: str, top: str, conf: str, file: str, sure: float, most: int) -> DataFrame:
    """The first ``most`` results to look at: wrong ones, surest first, then right ones under ``sure``, least sure first."""
    wrong = F.col(top) != F.col(truth)
    key = F.when(wrong, -F.col(conf)).when(F.col(conf) < sure, F.col(conf))
    return results.withColumn("key", key).where("key is not null").orderBy("key", top, file).limit(most)
