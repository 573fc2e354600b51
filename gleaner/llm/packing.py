"""Shards by best-fit-decreasing bin packing.

Groups of equal texts are indivisible. They are sorted by size, and each enters the bin with the
tightest capacity left that holds it. Groups of about one size are interchangeable, so the packing
runs over classes of sizes: exact sizes below 4096 bytes, twelve significant bits above (at most some
60,000 classes for any input), each with its count and mean size, or its largest size where the capacity is
fixed. A class is laid into a bin as one run of ranks. The driver holds the classes and the bins only; groups find their bin by their rank
inside their class.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import ceil
from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinals import join_hot
from ..session import materialise
from .common import buckets_for, even_hash, packed, unpacked, with_earlier_sum, without

RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
CLASS_BITS = 12


class Bins:
    """Bins by (capacity left, number) in a treap: least one of at least a size, in O(log n)."""

    def __init__(self) -> None:
        self._root: list | None = None
        self._random = Random(0)

    def add(self, left: float, number: int) -> None:
        low, high = self._split(self._root, (left, number))
        self._root = self._merge(self._merge(low, [(left, number), self._random.random(), None, None]), high)

    def take_tightest(self, size: float) -> tuple[float, int] | None:
        """Remove and return the bin with the least capacity that holds ``size``."""
        low, high = self._split(self._root, (size, -1))
        first, rest = self._pop_first(high)
        self._root = self._merge(low, rest)
        return first

    def take_widest(self) -> tuple[float, int]:
        node = self._root
        while node[3]:
            node = node[3]
        low, high = self._split(self._root, node[0])
        first, rest = self._pop_first(high)
        self._root = self._merge(low, rest)
        return first

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, low, high):
        if low is None or high is None:
            return low if high is None else high
        if low[1] < high[1]:
            return [low[0], low[1], low[2], self._merge(low[3], high)]
        return [high[0], high[1], self._merge(low, high[2]), high[3]]

    def _pop_first(self, node):
        if node is None:
            return None, None
        if node[2] is None:
            return node[0], node[3]
        first, rest = self._pop_first(node[2])
        return first, [node[0], node[1], rest, node[3]]


def _fit(left: float, size: float) -> int:
    """How many of ``size`` the capacity ``left`` holds, one at least; exact for whole numbers."""
    whole = isinstance(left, int) and isinstance(size, int)
    return max(1, left // size if whole else int(left / size + 1e-9))


def best_fit(
    classes: Iterable[tuple[int, int, int]], capacity: float, shards: int | None = None
) -> list[tuple[int, int, int, int]]:
    """Runs ``(class, first rank, end rank, bin)`` for classes ``(class, groups, bytes)``.

    With ``shards`` there are that many bins, and what fits none enters the widest. Without, a new bin
    is opened; a group above the capacity has one of its own.
    """
    bins = Bins()
    for b in range(shards or 0):
        bins.add(capacity, b)
    opened, runs = shards or 0, []
    for name, count, total in sorted(classes, reverse=True):
        size, rank = total // count if total % count == 0 else total / count, 0
        while rank < count:
            found = bins.take_tightest(size - 1e-6)
            if found:
                left, b = found
                n = min(count - rank, _fit(left, size))
            elif shards:
                left, b = bins.take_widest()
                n = 1
            else:
                left, b, n = capacity, opened, min(count - rank, _fit(capacity, size))
                opened += 1
            bins.add(left - n * size, b)
            if runs and runs[-1][0] == name and runs[-1][3] == b:
                runs[-1] = (name, runs[-1][1], rank + n, b)
            else:
                runs.append((name, rank, rank + n, b))
            rank += n
    return runs


def size_class(size: Column) -> Column:
    shift = F.greatest(F.length(F.bin(size)) - CLASS_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)


def assign_shards(docs: DataFrame, shards: int | None = 8, capacity: int | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows with ``size, text_crc32, law, shard, slot, grown_shard``, law ``bytes``.

    With ``shards`` the sizes of that many shards are near equal; with ``capacity`` (bytes) as few shards as best
    fit decreasing needs for groups counted at their class's largest size (up to 1/2048 above their own), so that no
    shard exceeds it but that of a single group which does. Equal texts, nulls among themselves, stay together, however
    many there are; a group larger than a shard's share makes its shard larger. A null text has one
    byte and the crc32 of nothing. ``slot`` counts from 0 in each shard; repeated rows have slots of
    their own. An empty table gives an empty result; columns named like the result's give way.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give shards or capacity")
    kept = without(docs, RESULT)
    raw = F.coalesce(docs[text].cast("binary"), F.lit(b""))
    rows = docs.select(
        packed(kept).alias("row"),
        F.when(docs[text].isNull(), F.lit("null")).otherwise(F.md5(docs[text].cast("binary"))).alias("same"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        even_hash(docs[key], F.lit("slot")).alias("spread"),
    )
    groups = materialise(
        rows.groupBy("same").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("__n")), "groups"
    )
    classed = groups.select(
        "same", "bytes", size_class(F.col("bytes")).alias("class"), even_hash(F.col("same")).alias("at")
    )
    classes = [tuple(r) for r in classed.groupBy("class").agg(F.count(F.lit(1)), F.sum("bytes"), F.max("bytes")).collect()]
    total, many = sum(c[2] for c in classes), sum(c[1] for c in classes)
    classes = [(c, n, n * most if capacity else size) for c, n, size, most in classes]
    runs = best_fit(classes, capacity or ceil(total / shards), shards)
    spark = docs.sparkSession
    plan = F.broadcast(spark.createDataFrame(runs, "class long, first long, end long, shard int"))
    ranked = with_earlier_sum(classed, "class", "at", ["same"], F.lit(1), "rank", buckets_for(many))
    r, p = ranked.alias("r"), plan.alias("p")
    placed = r.join(
        p,
        (F.col("r.class") == F.col("p.class")) & (F.col("r.rank") >= F.col("p.first")) & (F.col("r.rank") < F.col("p.end")),
    ).select("r.same", "p.shard")
    placed = materialise(placed, "placed")
    found = join_hot(rows, placed, ["same"], ["spread"], how="inner", counts=groups.select("same", "__n"))
    n_rows = groups.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    done = with_earlier_sum(found, "shard", "spread", ["same"], F.lit(1), "slot", buckets_for(n_rows))
    return done.select(
        *unpacked(done), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
