"""Readers of annotation files, each a DataFrame with one row for each object. Column ``image`` is the path's stem.

Paths may be any that Spark reads. Files are listed, read and parsed by Spark; none is opened by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.operators.labels import darknet_lines

KITTI = "cls string, truncation double, occlusion int, alpha double, x1 double, y1 double, x2 double, y2 double, height double, width double, length double, x double, y double, z double, rotation_y double"
MOT = "frame long, obj long, x double, y double, w double, h double, conf double, cls int, vis double"
COCO = """categories array<struct<id: bigint, name: string>>, images array<struct<id: bigint, file_name: string, width: double, height: double>>,
annotations array<struct<image_id: bigint, category_id: bigint, bbox: array<double>>>"""
CROWD = "ID string, gtboxes array<struct<tag: string, fbox: array<double>, head_attr: struct<ignore: int, unsure: int>>>"
PERSONS = (1, 7)  # classes of a MOT file that are people


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def darknet(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(image, line_no, class_id, x_center, y_center, width, height) of a folder of label files."""
    files = spark.read.text(path, wholetext=True).select(stem(F.col("_metadata.file_path")).alias("image"), F.col("value").alias("text"))
    return darknet_lines(files, strict=strict)


def kitti(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(KITTI).option("sep", " ").option("mode", "FAILFAST").csv(path)
    return rows.select(stem(F.col("_metadata.file_path")).alias("image"), "*")


def mot(spark: SparkSession, path: str, classes: tuple[int, ...] = PERSONS) -> DataFrame:
    """Ground truth of people; the confidence flag is not looked at."""
    return spark.read.schema(MOT).csv(path).where(F.col("cls").isin(*classes))


def coco(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, file_name, width, height, name, x, y, w, h); images without annotations have one row of nulls."""
    raw = spark.read.schema(COCO).option("multiLine", True).json(path)
    images = raw.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")
    names = raw.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), "c.name").distinct()
    found = raw.select(F.explode("annotations").alias("a")).select("a.image_id", "a.category_id", *[F.col("a.bbox")[k].alias(n) for k, n in enumerate("xywh")])
    return images.join(found.join(names, "category_id"), "image_id", "left").select("image_id", "file_name", "width", "height", "name", "x", "y", "w", "h")


def voc(spark: SparkSession, path: str, classes: list[str] | None = None) -> DataFrame:
    """(image, width, height, name, x1, y1, x2, y2); files without a size and classes not asked for are left out."""
    files = spark.read.text(path, wholetext=True).select(stem(F.col("_metadata.file_path")).alias("image"), "value")
    number = lambda p: F.xpath_double("value", F.lit(p))
    lists = {n: F.xpath("value", F.lit(f"/annotation/object/{p}/text()")) for n, p in (("name", "name"), ("x1", "bndbox/xmin"), ("y1", "bndbox/ymin"), ("x2", "bndbox/xmax"), ("y2", "bndbox/ymax"))}
    zipped = F.arrays_zip(*[v.alias(n) for n, v in lists.items()])
    rows = files.select("image", number("/annotation/size/width").alias("width"), number("/annotation/size/height").alias("height"), F.explode(zipped).alias("o"))
    rows = rows.where("width > 0 and height > 0").select("image", "width", "height", F.col("o.name").alias("name"), *[F.col(f"o.{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    return rows if classes is None else rows.where(F.col("name").isin(*classes))


def crowd(spark: SparkSession, path: str) -> DataFrame:
    """(image, x, y, w, h) of people that are not to be ignored, of newline-separated JSON."""
    rows = spark.read.schema(CROWD).json(path).select(F.col("ID").alias("image"), F.explode("gtboxes").alias("g"))
    kept = rows.where((F.col("g.tag") == "person") & (F.coalesce("g.head_attr.ignore", F.lit(0)) != 1))
    return kept.select("image", *[F.col("g.fbox")[k].alias(n) for k, n in enumerate("xywh")])


def answers(spark: SparkSession, path: str) -> DataFrame:
    """(image, label, bbox, conf, error) of grounding results, one JSON object a line; failed images keep their error."""
    shape = "image string, detections array<struct<label: string, bbox: array<double>, conf: double>>, error string"
    rows = spark.read.schema(shape).json(path)
    return rows.select("image", F.explode_outer("detections").alias("d"), "error").select("image", "d.label", "d.bbox", "d.conf", "error")
