"""Column builders for bounding boxes [x0, y0, x1, y1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def union_box(box: Column) -> Column:
    """Aggregate: the box around all boxes, whichever way their corners are given."""
    g = lambda k: F.get(box, k)
    return F.array(F.min(F.least(g(0), g(2))), F.min(F.least(g(1), g(3))), F.max(F.greatest(g(0), g(2))), F.max(F.greatest(g(1), g(3))))


def _centre(box: Column, k: int) -> Column:
    return (F.get(box, k) + F.get(box, k + 2)) / 2


def distance(a: Column, b: Column) -> Column:
    """Vertical centre distance plus a quarter of the horizontal one; a million where a box is missing."""
    d = F.abs(_centre(a, 1) - _centre(b, 1)) + 0.25 * F.abs(_centre(a, 0) - _centre(b, 0))
    return F.coalesce(d, F.lit(1e6))


def horizontal_overlap(a: Column, b: Column) -> Column:
    """Shared width over the smaller width; 1 where a box is missing."""
    shared = F.greatest(F.lit(0.0), F.least(F.get(a, 2), F.get(b, 2)) - F.greatest(F.get(a, 0), F.get(b, 0)))
    width = F.least(F.get(a, 2) - F.get(a, 0), F.get(b, 2) - F.get(b, 0))
    return F.coalesce(F.when(width > 0, shared / width).when(width <= 0, F.lit(0.0)), F.lit(1.0))
