"""Bounding boxes on the 0..499 grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import LOC_SCALE
from .text import trim_u


def parse_bbox(box: Column) -> Column:
    """struct(x1, y1, x2, y2) of the first four numbers; raises (ANSI) where one is missing or no number.  Wide numbers are clamped later, so none overflows."""
    parts = F.split(trim_u(box), r"(?U)\s+")
    return F.struct(*[F.element_at(parts, i + 1).cast("double").alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def on_grid(v: Column, size: Column) -> Column:
    """Half-even rounding, clamped at both ends."""
    return F.least(F.lit(LOC_SCALE - 1.0), F.greatest(F.lit(0.0), F.rint(v / size * LOC_SCALE))).cast("int")


def loc(box: Column, width: Column, height: Column) -> Column:
    sides = (("x1", width), ("y1", height), ("x2", width), ("y2", height))
    return F.concat(*[F.format_string("<loc_%d>", on_grid(box[n], s)) for n, s in sides])
