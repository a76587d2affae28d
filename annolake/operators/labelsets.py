"""Label sets as relations: which label an image gets, inherited values, names, paths and frames of a set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.operators.review import padded

# Fixed values of the annotation format.
COMMON, PENDING = "common", "pending"
RATIO, OVERLAP = 1.6, 0.1
GOLDEN = 0.61803398875
DIMMEST, BRIGHTEST = 0.7, 1.3


def label_records(images: DataFrame, own: DataFrame, imported: DataFrame, key: str, which: str = "all", most: float = 1.0) -> DataFrame:
    """``images`` with ``origin`` and ``min_conf`` of their labels, of those whose least confidence is ``most`` or less.

    The own label comes before the imported one; an image without any has an empty label of confidence 1. ``which`` is
    all, export (an imported label must be there) or labeled (an own one must). ``own`` and ``imported`` hold
    (key, min_conf), one row for each label.
    """
    sides = {n: t.select(key, F.coalesce("min_conf", F.lit(1.0)).alias(n)) for n, t in (("own", own), ("imported", imported))}
    rows = images.join(sides["own"], key, "left").join(sides["imported"], key, "left")
    there = {"all": F.lit(True), "export": F.col("imported").isNotNull(), "labeled": F.col("own").isNotNull()}[which]
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("imported").isNotNull(), "imported").otherwise("none")
    rows = rows.where(there).select(*images.columns, origin.alias("origin"), F.coalesce("own", "imported", F.lit(1.0)).alias("min_conf"))
    return rows.where(F.col("min_conf") <= most)


def inherited(properties: DataFrame, meta: str, position: str) -> DataFrame:
    """Properties (meta, position, name, values) led by the values of the last common property before them."""
    before = W.partitionBy(meta).orderBy(position)
    shared = F.last(F.when(F.col("name") == COMMON, F.col("values")), ignorenulls=True).over(before)
    own = F.when((F.col("name") == COMMON) | shared.isNull(), F.col("values")).otherwise(F.concat(shared, "values"))
    return properties.withColumn("values", own)


def settled(annotations: DataFrame, image: str, name: str = "name") -> DataFrame:
    """Annotations of images none of whose annotations is pending."""
    return annotations.join(annotations.where(F.col(name) == PENDING).select(image).distinct(), image, "left_anti")


def format_of(listing: DataFrame, folder: str, path: str, formats: dict[str, str]) -> DataFrame:
    """(folder, format): of ``formats`` (name: pattern of a path), the last one that a path of the folder fits; or null."""
    fits = F.array(*[F.col(path).rlike(p) for p in formats.values()])
    rank = F.max(F.array_max(F.transform(fits, lambda fit, k: F.when(fit, k + 1).otherwise(0))))
    names = F.array(*[F.lit(n) for n in formats])
    return listing.groupBy(folder).agg(rank.alias("rank")).select(folder, F.when(F.col("rank") > 0, F.get(names, F.col("rank") - 1)).alias("format"))


def label_path(image: Column, format_name: str, meta_id: int) -> Column:
    """Where the label of ``root/image/name.jpg`` is: ``root/format_m1/name.json``."""
    return F.regexp_replace(image, r"^(.*/)?[^/]+/([^/]+?)(\.[^./]*)?$", f"$1{format_name}_m{meta_id}/$2.json")


def image_of_label(label: Column, extension: str) -> Column:
    """The picture of a label file ``name_s31.lbl``: what comes before the last _, with ``extension``; null without a _."""
    return F.when(label.contains("_"), F.concat(F.regexp_extract(label, r"^(.*)_[^_]*$", 1), F.lit(extension)))


def darknet_label_path(image: Column) -> Column:
    """``root/labels/name.txt`` for ``root/images/name.jpg``."""
    return F.regexp_replace(image, r"^(.*/)?[^/]+/([^/]+?)(\.[^./]*)?$", "$1labels/$2.txt")


def union_boxes(objects: DataFrame, by: str, cls: str = "cls") -> DataFrame:
    """(by, x1, y1, x2, y2): the box around all objects of a class of 0 or more, for each image that has one."""
    return objects.where(F.col(cls) >= 0).groupBy(by).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))


def beyond_the_end(events: DataFrame, end_s: str, duration_s: str) -> DataFrame:
    """Events that end after their video; an event that ends with it is right."""
    return events.where(F.col(end_s) > F.col(duration_s))


def local_time(iso: Column, zone: str) -> Column:
    """An ISO time with its own offset (none: UTC) as ``yyyy-MM-dd HH:mm:ss`` in ``zone``; null for what is no time."""
    at = F.coalesce(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX")), F.try_to_timestamp(F.concat(iso, F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX")))
    return F.date_format(F.from_utc_timestamp(F.to_utc_timestamp(at, F.current_timezone()), zone), "yyyy-MM-dd HH:mm:ss")


def changed_on(files: DataFrame, modified: str, day: str, zone: str) -> DataFrame:
    """Files last changed on a day of ``zone``."""
    return files.where(F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(F.col(modified), F.current_timezone()), zone)) == F.lit(day).cast("date"))


def class_of_folder(path: Column) -> Column:
    """The number that the folder of a picture is named by; null where it is not a number."""
    return F.regexp_extract(path, r"/(\d+)/[^/]*$", 1).try_cast("int")


def crop_names(objects: DataFrame, image: str, position: str, value: str, prefix: str) -> DataFrame:
    """Objects of a value of 0 or more with the ``path`` of their picture, numbered within the image."""
    kept = objects.where(F.col(value) >= 0)
    number = padded(F.row_number().over(W.partitionBy(image).orderBy(position)))
    return kept.withColumn("path", F.concat(F.col(value).cast("string"), F.lit("/" + prefix), F.col(image).cast("string"), F.lit("_"), number, F.lit(".jpg")))


def pool_links(datasets: dict[str, DataFrame], labelled: DataFrame, stem: str) -> DataFrame:
    """(source, stem, image, label): names in the pool of all images that have a label, (source, stem) in ``labelled``."""
    every = None
    for name, images in datasets.items():
        one = images.select(F.lit(name).alias("source"), stem)
        every = one if every is None else every.unionByName(one)
    name = F.concat_ws("_", "source", F.col(stem).cast("string"))
    return every.join(labelled.select("source", stem).distinct(), ["source", stem], "left_semi").select("source", stem, F.concat(name, F.lit(".jpg")).alias("image"), F.concat(name, F.lit(".txt")).alias("label"))


def kept_frames(frames: Column, fps: Column, seconds: float, most: int) -> Column:
    """array of the frame numbers kept, one in ``seconds`` and ``most`` at the most (0: all); a rate of 0 or null is 25."""
    rate = F.when(fps > 0, fps).otherwise(25.0)
    step = F.greatest(F.lit(1), F.bround(rate * seconds).cast("int"))
    n = F.ceil(frames / step).cast("int")
    n = F.least(n, F.lit(most)) if most else n
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: k * step)).otherwise(F.array().cast("array<int>"))


def strips(width: Column, height: Column, w: int, h: int, n: int) -> Column:
    """array of (x, y, w, h): ``n`` (2 or more) strips along the lower edge, evenly apart, whole pixels."""
    apart = F.floor((width - w) / (n - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct((k * apart).alias("x"), (height - h).alias("y"), F.lit(w).alias("w"), F.lit(h).alias("h")))


def halves(width: Column, height: Column) -> Column:
    """array of (x1, y1, x2, y2): a long picture in two overlapping halves, any other whole."""
    box = lambda *v: F.struct(*[F.lit(x).cast("long").alias(n) if isinstance(x, int) else x.cast("long").alias(n) for x, n in zip(v, ("x1", "y1", "x2", "y2"), strict=True)])
    half_w, half_h = F.floor(width / 2), F.floor(height / 2)
    more_w, more_h = F.floor(half_w * OVERLAP), F.floor(half_h * OVERLAP)
    long = F.greatest(width, height) / F.least(width, height) > RATIO
    wide = F.array(box(0, 0, half_w + more_w, height), box(half_w - more_w, 0, width, height))
    tall = F.array(box(0, 0, width, half_h + more_h), box(0, half_h - more_h, width, height))
    return F.when(long & (width >= height), wide).when(long, tall).otherwise(F.array(box(0, 0, width, height)))


def crop_source(file: Column) -> Column:
    """The image that a crop ``name_p3.jpg`` was cut from; null for other names."""
    return F.nullif(F.regexp_extract(file, r"^(.*)_p\d+\.jpg$", 1), F.lit(""))


def sequence_frame(stem: Column) -> tuple[Column, Column]:
    """(sequence, frame) of ``sequence_0012``; nulls for other names."""
    pattern = r"^(.*)_(\d+)$"
    right = stem.rlike(pattern)
    return F.when(right, F.regexp_extract(stem, pattern, 1)), F.when(right, F.regexp_extract(stem, pattern, 2).cast("long"))


def safe_name(text: Column) -> Column:
    """A folder name: runs of all but Latin letters, digits and Han become one _; never empty."""
    name = F.regexp_replace(F.regexp_replace(text, "[^0-9A-Za-z\\x{4E00}-\\x{9FFF}]+", "_"), "^_+|_+$", "")
    return F.when(name == "", "kw").otherwise(name)


def class_list(text: Column, valid: list[int]) -> Column:
    """Sorted class numbers of a list with commas; all where it is empty, null where one is no number or not valid."""
    parts = F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")
    found = F.array_sort(F.array_distinct(F.transform(parts, lambda p: p.try_cast("int"))))
    every = F.array(*[F.lit(v) for v in sorted(valid)])
    right = F.forall(parts, lambda p: p.rlike(r"^[+-]?\d{1,5}$")) & F.forall(found, lambda v: F.array_contains(every, v))
    return F.when(F.trim(text) == "", every).when(right, found)


def wrong_fields(allowed: dict[str, list[str]]) -> Column:
    """Names of the columns whose value is null or not one of those allowed, in the order given."""
    bad = [F.when(~F.coalesce(F.col(c).isin(v), F.lit(False)), F.lit(c)) for c, v in allowed.items()]
    return F.filter(F.array(*bad), lambda c: c.isNotNull())


def hue(track: Column) -> Column:
    """A hue (0 to 1) for a track, far from that of the next."""
    return (track * F.lit(GOLDEN)) % 1


def blinks(t: Column, on: float, off: float) -> Column:
    """Whether a tag that shows for ``on`` and hides for ``off`` seconds shows at ``t``."""
    return F.pmod(t, F.lit(on + off)) < on if on > 0 and on + off > 0 else F.lit(False)


def light_factor(own: Column, around: Column) -> Column:
    """What to multiply a brightness by to match its surroundings, within fixed bounds."""
    return F.greatest(F.lit(DIMMEST), F.least(F.lit(BRIGHTEST), around / (own + 1e-3)))
