"""Offline default embedder: hashed term counts, built-ins only.

A text becomes lower-cased letter/digit tokens, each token a bucket, and the
vector holds the count per bucket. Counts are whole numbers, so dot products and
squared norms are exact in DOUBLE and equal texts tie exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

SPARSE = "struct<indices:array<int>,values:array<double>>"


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def bucket(token: Column, width: int) -> Column:
    return (F.conv(F.left(F.md5(token.cast("binary")), F.lit(8)), 16, 10).cast("bigint") % width).cast("int")


def hashed_counts(text: Column, width: int) -> Column:
    """Sparse count vector of one row's text, without a shuffle.

    Buckets are sorted inside the row; the ends of equal runs give bucket and
    count. NULL when the text has no token.
    """

    def runs(b: Column) -> Column:
        n = F.size(b)
        ends = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == n - 1) | (F.get(b, i) != F.get(b, i + 1)),
        )
        return let(
            ends,
            lambda e: F.struct(
                F.transform(e, lambda i: F.get(b, i)).alias("indices"),
                F.transform(
                    e, lambda i, j: (i - F.coalesce(F.get(e, j - 1), F.lit(-1))).cast("double")
                ).alias("values"),
            ),
        )

    buckets = F.sort_array(F.transform(tokens(text), lambda t: bucket(t, width)))
    return let(buckets, lambda b: F.when(F.size(b) > 0, runs(b))).cast(SPARSE)


def densify(sparse: Column, width: int) -> Column:
    """ARRAY<DOUBLE> of ``width`` numbers."""
    zero = F.lit(0.0)

    def filled(v: Column) -> Column:
        """Runs of zeros between the entries, one pass over the width."""
        i, x = v["indices"], v["values"]
        gap = lambda at, j: at - F.coalesce(F.get(i, j - 1), F.lit(-1)) - 1
        runs = F.transform(i, lambda at, j: F.concat(F.array_repeat(zero, gap(at, j)), F.array(F.get(x, j))))
        tail = F.lit(width - 1) - F.coalesce(F.try_element_at(i, F.lit(-1)), F.lit(-1))
        return F.when(v.isNotNull(), F.concat(F.flatten(runs), F.array_repeat(zero, tail)))

    return let(sparse, filled)


def fold(dense: Column, wide: int, width: int) -> Column:
    """Counts of ``width`` buckets from those of ``wide``, a multiple of it: the bucket of a token is its hash's remainder."""
    if wide % width:
        raise ValueError(f"{width} does not divide {wide}")
    if wide == width:
        return dense
    every = [F.slice(dense, i + 1, width) for i in range(0, wide, width)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), every)


def unit_length(dense: Column) -> Column:
    """Scale a vector to unit length in single precision steps."""
    from .vectors import squared_norm

    return let(F.sqrt(squared_norm(dense)), lambda n: F.transform(dense, lambda x: (x / n).cast("float").cast("double")))
