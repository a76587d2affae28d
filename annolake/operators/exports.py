"""Files of a data set as relations: (name, content), one row for each file, for ``annolake.sources.files.write_named``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from annolake.sources.sinks import exact_line


@F.pandas_udf(StringType())
def plain_line(cls: pd.Series, cx: pd.Series, cy: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
    """A label line with each number in the fewest digits that give it back."""
    return pd.Series([f"{c} {float(a)!r} {float(b)!r} {float(d)!r} {float(e)!r}" for c, a, b, d, e in zip(cls, cx, cy, w, h, strict=True)])


def label_files(images: DataFrame, boxes: DataFrame, key: str = "image", order: str = "idx", crop: tuple[str, str, str, str] | None = None, line=exact_line) -> DataFrame:
    """(key, name, content, n_objects): ``labels/<key>.txt`` for every row of ``images``, empty where it has no boxes.

    ``boxes``: (key, order, class_id, cx, cy, w, h); classes below 0 are no lines but count as objects. ``crop`` names
    the columns of ``images`` with the part of the picture (x, y, width, height) that the labels are to be for.
    """
    part = images.select(key, *(F.col(c).alias(f"crop_{n}") for c, n in zip(crop or (), "xywh")))
    rows = part.join(boxes.select(key, order, "class_id", "cx", "cy", "w", "h"), key, "left")
    values = [F.col(c) for c in ("cx", "cy", "w", "h")]
    if crop:
        x, y, w, h = (F.col(f"crop_{n}") for n in "xywh")
        values = [(values[0] - x) / w, (values[1] - y) / h, values[2] / w, values[3] / h]
    said = F.when(F.col("class_id") >= 0, F.struct(order, F.concat(line(F.coalesce("class_id", F.lit(-1)), *values), F.lit("\n")).alias("line")))
    lines = F.transform(F.array_sort(F.collect_list(said)), lambda s: s["line"])
    out = rows.groupBy(key).agg(F.array_join(lines, "").alias("content"), F.count("class_id").alias("n_objects"))
    return out.select(key, F.concat(F.lit("labels/"), F.col(key).cast("string"), F.lit(".txt")).alias("name"), "content", "n_objects")


def record_files(rows: DataFrame, folder: str, stem: Column, record: Column) -> DataFrame:
    """(name, content): ``folder/<stem>.json`` with one record each; nulls are kept."""
    return rows.select(F.concat(F.lit(f"{folder}/"), stem.cast("string"), F.lit(".json")).alias("name"), F.to_json(record, {"ignoreNullFields": "false"}).alias("content"))


def track_files(videos: DataFrame, tracked: DataFrame) -> DataFrame:
    """(name, content): ``<video>.json`` with its tracks, for (video, fps, duration_ms) and tracked rows with boxes.

    A track's class is that of its first frame; id 0 is no track. A video is one document, so one task puts it together.
    """
    seen = tracked.where("track_id <> 0 and not ended")
    box = F.struct(*(F.col(c) for c in ("x", "y", "width", "height")))
    frames = F.array_sort(F.collect_list(F.struct("frame_idx", "ts_ms", "conf", box.alias("rect"))))
    tracks = seen.groupBy("video", "track_id").agg(F.min_by("cls", "frame_idx").alias("cls"), frames.alias("frames"))
    ends = tracked.where("ended").select("video", "track_id", F.lit(True).alias("ended")).distinct()
    tracks = tracks.join(ends, ["video", "track_id"], "left")
    one = F.struct(F.col("track_id").alias("id"), "cls", "frames", F.coalesce("ended", F.lit(False)).alias("ended"))
    every = tracks.groupBy("video").agg(F.array_sort(F.collect_list(one)).alias("tracks"))
    rows = videos.select("video", "fps", "duration_ms").join(every, "video", "left")
    record = F.struct(F.col("video").alias("src"), "fps", "duration_ms", F.coalesce("tracks", F.array().cast(every.schema["tracks"].dataType)).alias("tracks"))
    return rows.select(F.concat(F.col("video").cast("string"), F.lit(".json")).alias("name"), F.to_json(record).alias("content"))


def mining_report(routed: DataFrame, skipped: DataFrame, settings: dict[str, object]) -> DataFrame:
    """(total, skipped, l0, l1, review, settings): one row about a routed set; ``skipped`` holds the images left out."""
    counts = [F.count_if(F.col("route") == r).alias(r) for r in ("l0", "l1", "review")]
    both = routed.select("route").union(skipped.select(F.lit("skipped").alias("route")))
    out = both.agg(F.count("*").alias("total"), F.count_if(F.col("route") == "skipped").alias("skipped"), *counts)
    said = F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in settings.items()))) if settings else F.lit("{}")
    return out.withColumn("settings", said)


def report_files(report: DataFrame, records: DataFrame, images: DataFrame) -> DataFrame:
    """(name, content) of a mining run: the report, one record for each image to review, label files of the others.

    ``records``: (image, record); ``images``: rows of ``label_files``. Records are a file each, so none gathers them all.
    """
    whole = report.select(F.lit("mining_report.json").alias("name"), F.to_json(F.struct(*report.columns)).alias("content"))
    review = record_files(records, "review", F.col("image"), F.col("record"))
    return whole.union(review).union(images.select("name", "content"))
