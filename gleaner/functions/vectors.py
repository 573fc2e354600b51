"""Vector arithmetic over ARRAY columns, in DOUBLE.

A vector that does not fit (other width, zero length) gives NULL instead of an
error, so that one bad row does not stop a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _wide(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(_wide(a), _wide(b), lambda x, y: x * y))


def squared_norm(v: Column) -> Column:
    return _sum(F.transform(_wide(v), lambda x: x * x))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - F.try_divide(dot(a, b), F.sqrt(squared_norm(a) * squared_norm(b)))


def l2_squared(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(_wide(a), _wide(b), lambda x, y: (x - y) * (x - y)))


def similarity(distance: Column) -> Column:
    return 1.0 - distance


def limit_dimensions(v: Column, width: int) -> Column:
    return F.slice(v, 1, width)


def normalize(v: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    from .text import let

    return let(
        F.sqrt(squared_norm(v)),
        lambda n: F.when(n > 0, F.transform(_wide(v), lambda x: x / n)).otherwise(_wide(v)),
    )


def cast_float32(v: Column) -> Column:
    return v.cast("array<float>")


def fits_width(v: Column, width: int) -> Column:
    """True for a vector of exactly ``width`` non-NULL numbers."""
    return F.coalesce((F.size(v) == width) & ~F.exists(v, lambda x: x.isNull()), F.lit(False))
