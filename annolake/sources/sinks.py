"""Writers of annotation files; Spark writes every part, in its own file names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def exact_line(cls: pd.Series, cx: pd.Series, cy: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    """A label line with six decimals of the exact binary value, halves to even."""
    return pd.Series([f"{c} {a:.6f} {b:.6f} {d:.6f} {e:.6f}" for c, a, b, d, e in zip(cls, cx, cy, w, h, strict=True)])


def yolo_texts(boxes: DataFrame, key: str = "image", order: str = "idx") -> DataFrame:
    """(key, text): the label file of each image, for (key, order, class_id, cx, cy, w, h); classes below 0 are left out."""
    lines = boxes.where("class_id >= 0").select(key, order, exact_line("class_id", "cx", "cy", "w", "h").alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct(order, "line")))
    return lines.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def write_yolo(boxes: DataFrame, path: str, key: str = "image", order: str = "idx") -> None:
    """One row of JSON for each image; an existing folder is an error."""
    yolo_texts(boxes, key, order).write.mode("errorifexists").json(path)


def write_kitti(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").option("sep", " ").csv(path)


def write_features(rows: DataFrame, vector: str, size: int, label: str, path: str) -> None:
    """c0, c1, ... and the label, with a header."""
    rows.select(*[F.col(vector)[k].alias(f"c{k}") for k in range(size)], label).write.mode("errorifexists").option("header", True).csv(path)


@F.pandas_udf(StringType())
def short_line(cls: pd.Series, cx: pd.Series, cy: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    """A label line with six digits each and a blank at its end."""
    return pd.Series(["%g %g %g %g %g " % row for row in zip(cls, cx, cy, w, h, strict=True)])


def write_records(rows: DataFrame, path: str) -> None:
    """One JSON object a line, nulls kept; an existing folder is an error."""
    rows.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
