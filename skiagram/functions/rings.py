"""Polygon measures as expressions over arrays of vertices (xs, ys), all inside code generation.

A ring is open (the first vertex is not repeated).  Measures are built from arrays, not exploded rows, so they need no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def rolled(a: Column, k: int = 1) -> Column:
    return F.concat(F.slice(a, k + 1, F.size(a) - k), F.slice(a, 1, k))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def area(x: Column, y: Column) -> Column:
    return F.abs(total(F.zip_with(F.zip_with(x, rolled(y), lambda a, b: a * b), F.zip_with(rolled(x), y, lambda a, b: a * b), lambda a, b: a - b))) / 2


def steps(x: Column, y: Column) -> Column:
    dx, dy = F.zip_with(rolled(x), x, lambda a, b: a - b), F.zip_with(rolled(y), y, lambda a, b: a - b)
    return F.zip_with(dx, dy, lambda a, b: F.sqrt(a * a + b * b))


def perimeter(x: Column, y: Column) -> Column:
    return total(steps(x, y))


def ecd(a: Column) -> Column:
    return 2 * F.sqrt(a / math.pi)


def circularity(a: Column, p: Column) -> Column:
    return F.when(p > 0, 4 * math.pi * a / (p * p))


def crop_box(x: Column, y: Column, pad: int, rows: Column, cols: Column) -> dict[str, Column]:
    return {
        "r0": F.greatest(F.floor(F.array_min(y)) - pad, F.lit(0)),
        "c0": F.greatest(F.floor(F.array_min(x)) - pad, F.lit(0)),
        "r1": F.least(F.ceil(F.array_max(y)) + pad, rows),
        "c1": F.least(F.ceil(F.array_max(x)) + pad, cols),
    }
