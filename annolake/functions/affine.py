"""Affine maps of the plane as columns: struct (a, b, c, d, e, f) sends (x, y) to (a x + b y + c, d x + e y + f)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAT = 1e-6  # a map whose triangle has no more area than this is taken for the identity
NAMES = "abcdef"


def affine(*values: Column) -> Column:
    return F.struct(*[v.cast("double").alias(n) for n, v in zip(NAMES, values, strict=True)])


def identity() -> Column:
    return affine(*[F.lit(v) for v in (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)])


def moved(m: Column, x: Column, y: Column) -> tuple[Column, Column]:
    return m["a"] * x + m["b"] * y + m["c"], m["d"] * x + m["e"] * y + m["f"]


def product(m: Column, n: Column) -> Column:
    """First ``n``, then ``m``."""
    c, f = moved(m, n["c"], n["f"])
    return affine(m["a"] * n["a"] + m["b"] * n["d"], m["a"] * n["b"] + m["b"] * n["e"], c, m["d"] * n["a"] + m["e"] * n["d"], m["d"] * n["b"] + m["e"] * n["e"], f)


def inverse(m: Column) -> Column:
    """The way back; null where there is none."""
    det = m["a"] * m["e"] - m["b"] * m["d"]
    a, b, d, e = m["e"] / det, -m["b"] / det, -m["d"] / det, m["a"] / det
    return F.when(det != 0, affine(a, b, -(a * m["c"] + b * m["f"]), d, e, -(d * m["c"] + e * m["f"])))


def padded_box(width: Column, height: Column, padding: float = 1.25) -> tuple[Column, Column, Column, Column]:
    """(cx, cy, w, h): the middle of a crop and its size with a margin."""
    return width / 2, height / 2, width * padding, height * padding


def fitted(w: Column, h: Column, out_w: int, out_h: int) -> tuple[Column, Column]:
    """The smallest size of the output's proportions that holds (w, h)."""
    wide = w * out_h > h * out_w
    return F.when(wide, w).otherwise(h * out_w / out_h), F.when(wide, w * out_h / out_w).otherwise(h)


def top_down(cx: Column, cy: Column, w: Column, out_w: int, out_h: int, degrees: float = 0.0) -> Column:
    """The map of a crop around (cx, cy), ``w`` wide and turned by ``degrees``, into an output; the identity for a crop without size."""
    turn = math.radians(degrees)
    grow = F.lit(float(out_w)) / w
    cos, sin = grow * math.cos(turn), grow * math.sin(turn)
    m = affine(cos, sin, out_w / 2 - cos * cx - sin * cy, -sin, cos, out_h / 2 + sin * cx - cos * cy)
    return F.when(w * w / 4 >= FLAT, m).otherwise(identity())
