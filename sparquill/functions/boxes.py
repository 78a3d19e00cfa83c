"""Column expressions on boxes. A corner box is (x, y, w, h) with x, y its lowest corner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def corner(cx: Column, cy: Column, w: Column, h: Column) -> list[Column]:
    """Centre box to corner box in the same space."""
    return [cx - w / 2, cy - h / 2, w, h]


def pixel_corner(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    """Normalized centre box to whole pixels, truncated toward zero."""
    pw, ph = w * width, h * height
    return [
        (cx * width - pw / 2).cast("int"),
        (cy * height - ph / 2).cast("int"),
        pw.cast("int"),
        ph.cast("int"),
    ]


def pixel_corners(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    """Both corners in pixels (x1, y1, x2, y2), truncated toward zero."""
    return [
        ((cx - w / 2) * width).cast("int"),
        ((cy - h / 2) * height).cast("int"),
        ((cx + w / 2) * width).cast("int"),
        ((cy + h / 2) * height).cast("int"),
    ]


def intersection(a: list[Column], b: list[Column]) -> Column:
    dx = F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0])
    dy = F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1])
    zero = F.lit(0)
    return (F.greatest(dx, zero) * F.greatest(dy, zero)).cast("double")


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union; 0 when the union is empty."""
    inter = intersection(a, b)
    union = (a[2] * a[3]).cast("double") + (b[2] * b[3]).cast("double") - inter
    return F.coalesce(F.try_divide(inter, union), F.lit(0.0))


def argmax(scores: Column) -> Column:
    """Index of the largest score, the first on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 or anything is missing."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))
