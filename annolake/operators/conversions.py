"""One object in the four forms that it is labelled in, as column expressions, and results of the older format.

The common form is a struct (id, prob_class, polygon, properties): prob_class and each property have a value and a
confidence, the polygon's corners go round from the upper left. Everything is relative to the picture's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.functions.vectors import argmax
from annolake.sources.formats import stem

# Fixed values of the formats: an object that has no number yet, and the confidence of a label without one.
NO_ID, SURE = -1, 1.0
PROPERTIES = "map<int,struct<value:int,conf:double>>"


def rectangle(x: Column, y: Column, w: Column, h: Column) -> Column:
    """The four corners of a box, from the upper left round."""
    corner = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    return F.array(corner(x, y), corner(x + w, y), corner(x + w, y + h), corner(x, y + h))


def envelope(polygon: Column) -> tuple[Column, Column, Column, Column]:
    """(x, y, w, h) around a polygon."""
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)


def labelled(id_: Column, value: Column, conf: Column, polygon: Column, properties: Column | None = None) -> Column:
    own = properties if properties is not None else F.create_map()
    prob = F.struct(value.cast("int").alias("value"), conf.cast("double").alias("conf"))
    return F.struct(id_.cast("int").alias("id"), prob.alias("prob_class"), polygon.alias("polygon"), own.cast(PROPERTIES).alias("properties"))


def of_detection(o: Column) -> Column:
    """Of a detection (id, cls, conf, rect); what it was classed as besides stays out, as ``props`` of results are for review."""
    r = o["rect"]
    return labelled(o["id"], o["cls"], o["conf"], rectangle(r["x"], r["y"], r["width"], r["height"]))


def of_result(o: Column) -> Column:
    """Of a detection with ``props``, probabilities for each property: the likeliest value of each is its property."""
    r = o["rect"]
    best = F.transform_values(o["props"], lambda _, p: F.struct(argmax(p).alias("value"), F.array_max(p).alias("conf")))
    return labelled(o["id"], o["cls"], o["conf"], rectangle(r["x"], r["y"], r["width"], r["height"]), best)


def of_darknet(class_id: Column, cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """Of a label line; ids are for the caller to give."""
    return labelled(F.lit(0), class_id, F.lit(SURE), rectangle(cx - w / 2, cy - h / 2, w, h))


def to_darknet(label: Column) -> Column:
    """(class_id, cx, cy, w, h)."""
    x, y, w, h = envelope(label["polygon"])
    values = (label["prob_class"]["value"], x + w / 2, y + h / 2, w, h)
    return F.struct(*[v.alias(n) for v, n in zip(values, ("class_id", "cx", "cy", "w", "h"), strict=True)])


def of_kitti(row: Column, names: list[str]) -> Column:
    """Of a row with ``cls``, a name, and x1, y1, x2, y2; a name that is not in ``names`` has no number, and null for one."""
    at = F.array_position(F.array(*[F.lit(n) for n in names]), row["cls"])
    return labelled(F.lit(NO_ID), F.when(at > 0, at - 1), F.lit(SURE), rectangle(row["x1"], row["y1"], row["x2"] - row["x1"], row["y2"] - row["y1"]))


def to_kitti(label: Column, names: list[str]) -> Column:
    """(cls, x1, y1, x2, y2); null for a number without a name."""
    x, y, w, h = envelope(label["polygon"])
    cls = F.get(F.array(*[F.lit(n) for n in names]), label["prob_class"]["value"])
    return F.struct(cls.alias("cls"), x.alias("x1"), y.alias("y1"), (x + w).alias("x2"), (y + h).alias("y2"))


RESULT = """struct<roi: array<struct<x: double, y: double>>, objects: array<struct<id: int, cls: int, conf: double,
  rect: struct<x: double, y: double, width: double, height: double>, props: map<string, array<double>>>>>"""


def result_of(text: Column) -> Column:
    """A result of the older format as RESULT, read through VARIANT; fields that are missing or of another kind are null, text that is no JSON too."""
    v = F.try_parse_json(text)
    points = F.try_variant_get(v, "$.roi", "array<struct<x: double, y: double>>")
    objects = F.try_variant_get(v, "$.objects", "array<variant>")
    number = lambda o, path, kind: F.try_variant_get(o, path, kind)

    def one(o: Column) -> Column:
        rect = F.struct(*[number(o, f"$.rect.{n}", "double").alias(n) for n in ("x", "y", "width", "height")])
        props = F.try_variant_get(o, "$.props", "map<string, array<double>>")
        return F.struct(number(o, "$.id", "int").alias("id"), number(o, "$.cls", "int").alias("cls"), number(o, "$.conf", "double").alias("conf"), rect.alias("rect"), props.alias("props"))

    return F.struct(points.alias("roi"), F.transform(objects, one).alias("objects"))


def results(spark: SparkSession, folder: str, meta_id: int) -> DataFrame:
    """(image, result) of ``folder/a2d_m1/*.json``, each as RESULT."""
    rows = spark.read.text(f"{folder}/a2d_m{meta_id}/*.json", wholetext=True)
    return rows.select(stem(F.col("_metadata.file_path")).alias("image"), result_of(F.col("value")).alias("result"))
