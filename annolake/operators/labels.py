"""Label formats as relations, and the scalar rules that labels are read and written by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.functions.geometry import clamped

# fixed values: the pattern of banknote denominations that stand by themselves, and bbox keys in order of preference
DENOMINATION = r"(?<!\d)(100|50|20|10|5|1)(?!\d)"
BBOX_KEYS = ("bbox", "bbox_2d", "box", "rectangle", "box_2d")


def darknet_lines(files: DataFrame, text: str = "text", strict: bool = True, more: bool = True) -> DataFrame:
    """``files`` with one row for each label line: line_no, class_id, x_center, y_center, width, height.

    Strict: five numbers or an error. Otherwise lines of five or more are read by their first five, others skipped;
    without ``more``, only lines of just five are read.
    """
    lines = files.select(*[c for c in files.columns if c != text], F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "_line"))
    lines = lines.withColumn("_f", F.split(F.trim(F.regexp_replace("_line", "\\s+", " ")), " ")).where("trim(_line) <> ''")
    number = lambda k: F.expr(f"try_cast(_f[{k}] as double)")
    right = (F.size("_f") >= 5) if more and not strict else (F.size("_f") == 5)
    for k in range(5):
        right = right & number(k).isNotNull()
    if strict:
        lines = lines.withColumn("_f", F.when(right, F.col("_f")).otherwise(F.raise_error(F.concat(F.lit("not a label line: "), "_line"))))
    else:
        lines = lines.where(right)
    kept = [c for c in files.columns if c != text]
    return lines.select(*kept, F.col("line_no").cast("int"), number(0).cast("int").alias("class_id"), *[number(k).alias(n) for k, n in enumerate(("x_center", "y_center", "width", "height"), 1)])


def yolo_text(cls: Column, box: tuple[Column, ...]) -> Column:
    """A label line. Numbers are rounded half up from their shortest form; ``sinks.exact_line`` writes them exactly."""
    return F.concat_ws(" ", cls.cast("string"), *[F.format_string("%.6f", v) for v in box])


def canonical_class(name: Column, money: bool = True) -> Column:
    """The denomination that a class name speaks of, standing by itself; with ``money`` only where yuan or rmb is named."""
    found = F.regexp_extract(F.lower(name), DENOMINATION, 1)
    right = F.lower(name).rlike("yuan|rmb") if money else F.lit(True)
    return F.when((found != "") & right, found)


def weights(text: Column) -> Column:
    """map of ``name:weight,...``; blanks and empty parts do not matter, later names win."""
    parts = F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p.contains(":"))
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("k"), F.trim(F.substring_index(p, ":", -1)).cast("double").alias("v")))
    none = F.create_map().cast("map<string,double>")
    return F.aggregate(pairs, none, lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))


def event_span(text: Column) -> Column:
    """struct(name, start_s, end_s) of ``name,start-end``; null for anything else."""
    pattern = r"^([^,]+),\s*(\d+(?:\.\d+)?)-(\d+(?:\.\d+)?)\s*$"
    name = F.trim(F.regexp_extract(text, pattern, 1))
    start, end = (F.regexp_extract(text, pattern, k).try_cast("double") for k in (2, 3))
    return F.when((name != "") & (start < end), F.struct(name.alias("name"), start.alias("start_s"), end.alias("end_s")))


def detections_of_answer(answer: Column, width: Column, height: Column) -> Column:
    """array of (label, bbox, conf) in a model's JSON answer; boxes above 1.5 are pixels, all end up in 0..1."""
    clean = F.regexp_replace(answer, r"(?s)<think>.*?</think>", "")
    body = F.regexp_extract(clean, r"(?s)\[.*\]", 0)
    boxes = ",".join(f"{k} array<double>" for k in BBOX_KEYS)
    items = F.from_json(body, f"array<struct<label string, conf double, {boxes}>>")
    best = lambda x: F.coalesce(*[x[k] for k in BBOX_KEYS])
    sized = lambda b, k: F.when(F.array_max(b) > 1.5, b[k] / (width if k % 2 == 0 else height)).otherwise(b[k])
    right = F.filter(items, lambda x: x["label"].isNotNull() & (F.size(best(x)) == 4))
    return F.transform(right, lambda x: F.struct(x["label"].alias("label"), F.array(*[clamped(sized(best(x), k)) for k in range(4)]).alias("bbox"), F.coalesce(x["conf"], F.lit(1.0)).alias("conf")))


def least_conf(cls: Column, conf: Column, props: Column) -> Column:
    """An object's confidence: the least of its class's and its properties'; 1 where it has no class."""
    low = F.array_min(F.concat(F.array(conf), F.transform(F.map_values(props), lambda p: p["conf"])))
    return F.when(cls < 0, F.lit(1.0)).otherwise(low)


def keypoints(xs: Column, ys: Column, ratio: float, least: float) -> Column:
    """(x, y, conf) by the peaks of two axis profiles; zeros at ``least`` or below."""
    mx, my = F.array_max(xs), F.array_max(ys)
    conf = (mx + my) * 0.5
    at = lambda v, m: (F.array_position(v, m) - 1) / F.lit(ratio)
    zero = F.lit(0.0)
    return F.when(conf > least, F.struct(at(xs, mx).alias("x"), at(ys, my).alias("y"), conf.alias("conf"))).otherwise(F.struct(zero.alias("x"), zero.alias("y"), zero.alias("conf")))


def tiles(width: Column, height: Column, cols: int, rows: int) -> Column:
    """array of (x, y, w, h): an even grid over a picture, whole pixels."""
    w, h = F.floor(width / cols), F.floor(height / rows)
    grid = F.sequence(F.lit(0), F.lit(cols * rows - 1))
    return F.transform(grid, lambda k: F.struct(((k % cols) * w).alias("x"), (F.floor(k / cols) * h).alias("y"), w.alias("w"), h.alias("h")))


def uniform_times(duration: Column, n: Column) -> Column:
    """n times from 0 to ``duration``; one alone is 0, and fewer are an error."""
    none = F.raise_error(F.lit("the number of timestamps must be positive")).cast("array<double>")
    return F.when(n <= 0, none).when(n == 1, F.array(F.lit(0.0))).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * duration / (n - 1)))


def frame_times(frames: Column, fps: Column, sample_fps: Column) -> Column:
    """array of (frame_idx, ts_ms) that sampling keeps; rates and times are rounded half to even."""
    stride = F.greatest(F.lit(1), F.bround(fps / sample_fps).cast("int"))
    picked = F.filter(F.sequence(F.lit(0), frames - 1), lambda i: i % stride == 0)
    return F.transform(picked, lambda i: F.struct(i.cast("long").alias("frame_idx"), F.bround(i / fps * 1000).cast("long").alias("ts_ms")))


def grid_boxes(left: Column, top: Column, right: Column, bottom: Column, cols: int, cell: int, reach: int, width: int, height: int) -> Column:
    """Boxes of a detector's grid, row by row: how far each cell's box reaches to its four sides, cut at the picture's edges."""

    def box(v: Column, k: Column) -> Column:
        cx, cy = (k % cols) * cell + 0.5, F.floor(k / cols) * cell + 0.5
        cut = lambda x, m: F.greatest(F.lit(0.0), F.least(F.lit(float(m)), x))
        side = lambda plane: F.get(plane, k) * reach
        return F.struct(cut(cx - v * reach, width).alias("x1"), cut(cy - side(top), height).alias("y1"), cut(cx + side(right), width).alias("x2"), cut(cy + side(bottom), height).alias("y2"))

    return F.transform(left, box)


def sharpness(pixels: Column, width: int) -> Column:
    """Variance of the second differences of a grey picture, row by row in ``pixels``; edges are mirrored without being doubled."""
    height = F.floor(F.size(pixels) / width).cast("int")
    mirrored = lambda k, n: F.when(k < 0, F.least(F.lit(1), n - 1)).when(k >= n, F.greatest(n - 2, F.lit(0))).otherwise(k)
    at = lambda x, y: F.get(pixels, (mirrored(y, height) * width + mirrored(x, F.lit(width))).cast("int"))

    def bend(v: Column, k: Column) -> Column:
        x, y = k % width, F.floor(k / width)
        return at(x - 1, y) + at(x + 1, y) + at(x, y - 1) + at(x, y + 1) - 4 * v

    bends = F.transform(pixels, bend)
    n = F.size(pixels)
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b) / n
    return mean(F.transform(bends, lambda b: b * b)) - mean(bends) * mean(bends)
