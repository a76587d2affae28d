"""Box geometry as column expressions: corner boxes (x1, y1, x2, y2), corner-and-size boxes (x, y, w, h), YOLO boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def corners(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2"))


def fields(box: Column) -> Box:
    return tuple(box[c] for c in ("x1", "y1", "x2", "y2"))


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union has no area."""
    none = F.lit(0.0)
    across = F.greatest(none, F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    down = F.greatest(none, F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    shared = across * down
    union = area(a) + area(b) - shared
    return F.when(union > 0, shared / union).otherwise(none)


def clamped(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def yolo_plain(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    """Centre and size as parts of the picture, whatever lies outside it."""
    return (x + w / 2) / width, (y + h / 2) / height, w / width, h / height


def yolo_clipped(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    """The same after the edges are cut at the picture's; sizes of 0 or less are for the caller to drop."""
    none = F.lit(0.0)
    x1, y1 = F.greatest(none, x), F.greatest(none, y)
    x2, y2 = F.least(width, x + w), F.least(height, y + h)
    return (x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height


def yolo_clamped(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    """Centre and size, each put into 0..1 by itself."""
    return tuple(clamped(v) for v in yolo_plain(x, y, w, h, width, height))


def yolo_of_corners(b: Box) -> Box:
    """Of a normalised corner box whose corners may be swapped; each value is put into 0..1 by itself."""
    x1, x2, y1, y2 = F.least(b[0], b[2]), F.greatest(b[0], b[2]), F.least(b[1], b[3]), F.greatest(b[1], b[3])
    return clamped((x1 + x2) / 2), clamped((y1 + y2) / 2), clamped(x2 - x1), clamped(y2 - y1)


def corners_of_yolo(cx: Column, cy: Column, w: Column, h: Column) -> Box:
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def pixel_box(b: Box, width: Column, height: Column) -> Column:
    """Whole pixels (halves to even) inside the picture; null where nothing is left."""
    x1, x2 = (F.least(width, F.greatest(F.lit(0), F.bround(v * width).cast("long"))) for v in (b[0], b[2]))
    y1, y2 = (F.least(height, F.greatest(F.lit(0), F.bround(v * height).cast("long"))) for v in (b[1], b[3]))
    box = F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return F.when((x2 > x1) & (y2 > y1), box)


def envelope(points: Column) -> Column:
    """Smallest upright box around an array of (x, y)."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def inside_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """Even-odd rule over an array of (x, y); a polygon of fewer than three points holds nothing."""
    n = F.size(polygon)

    def crosses(p: Column, k: Column) -> Column:
        q = F.element_at(polygon, F.when(k + 2 > n, 1).otherwise(k + 2))
        spans = (p["y"] > y) != (q["y"] > y)
        return F.when(spans, F.when(x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"], 1).otherwise(0)).otherwise(0)

    hits = F.aggregate(F.transform(polygon, crosses), F.lit(0), lambda a, b: a + b)
    return F.when(n < 3, F.lit(False)).otherwise(hits % 2 == 1)


def iou_of_rects(a: Box, b: Box) -> Column:
    """Intersection over union of (x, y, w, h) boxes; 0 where they do not overlap."""
    x1, y1 = F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
    x2, y2 = F.least(a[0] + a[2], b[0] + b[2]), F.least(a[1] + a[3], b[1] + b[3])
    shared = (x2 - x1) * (y2 - y1)
    return F.when((x2 <= x1) | (y2 <= y1), 0.0).otherwise(shared / (a[2] * a[3] + b[2] * b[3] - shared))


def rect_of_yolo(cx: Column, cy: Column, w: Column, h: Column) -> Box:
    """(x, y, w, h) inside the unit square; sizes of 0 or less are for the caller to drop."""
    x1, y1, x2, y2 = corners_of_yolo(cx, cy, w, h)
    x1, y1, x2, y2 = F.greatest(F.lit(0.0), x1), F.greatest(F.lit(0.0), y1), F.least(F.lit(1.0), x2), F.least(F.lit(1.0), y2)
    return x1, y1, x2 - x1, y2 - y1


def whole_corners(x: Column, y: Column, w: Column, h: Column) -> Box:
    """Corners of an (x, y, w, h) box in whole pixels, cut towards zero."""
    return x.cast("long"), y.cast("long"), (x + w).cast("long"), (y + h).cast("long")


def widened(b: Box, left: float, top: float, right: float, bottom: float) -> Box:
    """A corner box with each side moved outwards by a part of the width or height."""
    w, h = b[2] - b[0], b[3] - b[1]
    return b[0] - w * left, b[1] - h * top, b[2] + w * right, b[3] + h * bottom


def padded_in_turn(b: Box, pad: float, width: Column, height: Column) -> Box:
    """A pixel box padded at left and top, then at right and bottom by parts of the wider box, cut at the picture."""
    x1, y1 = b[0] - (b[2] - b[0]) * pad, b[1] - (b[3] - b[1]) * pad
    x2, y2 = b[2] + (b[2] - x1) * pad, b[3] + (b[3] - y1) * pad
    return F.greatest(F.lit(0.0), x1), F.greatest(F.lit(0.0), y1), F.least(width, x2), F.least(height, y2)


def padded_evenly(cx: Column, cy: Column, w: Column, h: Column, pad: float, width: Column, height: Column) -> Box:
    """A YOLO box padded alike on all sides, in pixels, cut at the picture."""
    x1, y1 = F.greatest(F.lit(0.0), (cx - w / 2 - w * pad) * width), F.greatest(F.lit(0.0), (cy - h / 2 - h * pad) * height)
    return x1, y1, F.least(width, (cx + w / 2 + w * pad) * width), F.least(height, (cy + h / 2 + h * pad) * height)


def region_window(b: Box, width: Column, height: Column, grow: int = 4, step: int = 4) -> Box:
    """Window (x, y, w, h) of a normalised region: grown by pixels, cut at the picture, sizes down to multiples of ``step``."""
    x1, y1 = F.greatest(F.lit(0.0), b[0] * width - grow), F.greatest(F.lit(0.0), b[1] * height - grow)
    x2, y2 = F.least(width, b[2] * width + grow), F.least(height, b[3] * height + grow)
    w, h = (F.floor(v.cast("long") / step) * step for v in (x2 - x1, y2 - y1))
    return x1 / width, y1 / height, w / width, h / height


def in_window(points: Column, window: Box) -> Column:
    """An array of (x, y) seen from a window (x, y, w, h)."""
    x, y, w, h = window
    return F.transform(points, lambda p: F.struct(((p["x"] - x) / w).alias("x"), ((p["y"] - y) / h).alias("y")))


def moved(points: Column, dx: Column, dy: Column) -> Column:
    return F.transform(points, lambda p: F.struct((p["x"] + dx).alias("x"), (p["y"] + dy).alias("y")))


def vertexes(b: Box) -> Column:
    """Corner points of a box, clockwise from the upper left one."""
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3]))])


def remapped(points: Column, x0: Column, y0: Column, width: Column, height: Column) -> Column:
    """Points in pixels of a crop at (x0, y0) as parts of the whole picture; null stays null."""
    return F.transform(points, lambda p: F.struct(((p["x"] + x0) / width).alias("x"), ((p["y"] + y0) / height).alias("y")))
