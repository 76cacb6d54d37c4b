"""Geometry of rectangles (x0, y0, x1, y1) as column expressions; all in 32-bit floats on native schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rect(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))


def bounding_box(prefix: str = "") -> list[Column]:
    """Aggregates of the smallest rectangle that covers a group."""
    return [f(f"{prefix}{c}").alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]


def overlaps(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Touching rectangles count."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def contains(outer: tuple[Column, ...], inner: tuple[Column, ...], slack: float = 1.0) -> Column:
    e = F.lit(slack).cast("float")
    return (inner[0] >= outer[0] - e) & (inner[1] >= outer[1] - e) & (inner[2] <= outer[2] + e) & (inner[3] <= outer[3] + e)


def holds_point(outer: tuple[Column, ...], x: Column, y: Column, slack: float = 1.0) -> Column:
    e = F.lit(slack).cast("float")
    return x.between(outer[0] - e, outer[2] + e) & y.between(outer[1] - e, outer[3] + e)


def same_line(upper_y: Column, lower_y: Column, lower_height: Column) -> Column:
    return (upper_y == lower_y) | (upper_y <= lower_y + lower_height * F.lit(2.0) / F.lit(3.0))


def near_on_line(left_x: Column, right_x: Column, left_text: Column, glyph_width: Column) -> Column:
    return right_x <= left_x + F.octet_length(left_text) * glyph_width * F.lit(0.43) + F.lit(10.0)
