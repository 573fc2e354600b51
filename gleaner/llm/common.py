"""Helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of one key that one task sorts, about.
BUCKET_ROWS = 50_000


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers."""
    ship_package(spark)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns named like those of a result: they give way to it."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs meets one of an operator's own."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return F.struct(*(cols or [F.lit(1).alias("none")]))


def unpacked(df: DataFrame, row: str = "row") -> list[Column]:
    """The columns of the struct that :func:`packed` made."""
    names = df.schema[row].dataType.names
    return [F.col(row)[n].alias(n) for n in names]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def known(key: Column) -> Column:
    """A string that is never null and tells a null key from every other key."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def even_hash(*keys: Column) -> Column:
    """A long from 0 up to 2^31, evenly spread, the same in every engine that has md5."""
    text = F.concat_ws("/", *[known(k) for k in keys])
    return F.shiftright(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), 1)


def _slot(code: Column, words: int) -> tuple[Column, Column]:
    slot = F.pmod(code, F.lit(words * 64))
    return F.shiftright(slot, 6), F.pmod(slot, F.lit(64)).cast("int")


def marks_of(keys: DataFrame, bits_per_key: int = 16, most_words: int = 1 << 20) -> tuple[DataFrame, int]:
    """``word, marks`` for ``keys`` (a column ``code`` of longs), and the number of words.

    A code has a bit in one of at most ``most_words`` words of 64 bits, whatever the number of keys, so the
    table may be broadcast or fetched. Beyond four million keys it tells fewer of them apart.
    """
    asked = -(-keys.count() * bits_per_key // 64)
    words = min(most_words, 1 << max(asked, 1).bit_length())
    word, bit = _slot(F.col("code"), words)
    marked = keys.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    return marked.groupBy("word").agg(F.bit_or("bit").alias("marks")), words


def maybe_among(df: DataFrame, code: Column, keys: DataFrame, bits_per_key: int = 16, most_words: int = 1 << 20) -> DataFrame:
    """The rows of ``df`` whose ``code`` (a long) is among those of ``keys`` (column ``code``), and a few others.

    Nothing is lost: it only spares a shuffle most rows that meet nothing. Beyond four million keys more and
    more rows pass.
    """
    marks, words = marks_of(keys, bits_per_key, most_words)
    word, bit = _slot(code, words)
    marks = F.broadcast(marks.select(F.col("word").alias("__word"), F.col("marks").alias("__marks")))
    tagged = df.withColumn("__word", word).withColumn("__bit", bit).join(marks, "__word")
    hit = F.call_function("shiftright", F.col("__marks"), F.col("__bit")).bitwiseAND(F.lit(1)) == 1
    return tagged.where(hit).select(*[F.col(f"`{c}`") for c in df.columns])


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return max(1, -(-rows // bucket_rows))


def with_earlier_sum(
    df: DataFrame,
    key: str,
    spread: str,
    order: Sequence[str],
    amount: Column,
    name: str,
    buckets: int,
) -> DataFrame:
    """Add the sum of ``amount`` over the rows of the same ``key`` that come before, in (spread, *order).

    ``key`` has no nulls; ``spread`` is a hash below 2^31. Its range is cut into ``buckets``, so that
    a key with a third of all rows is spread over that many tasks: the sums of whole buckets are
    added up on one row per key and bucket, and a window is taken inside a bucket only.
    """
    cut = df.withColumn("__b", F.shiftright(F.col(spread) * buckets, 31)).withColumn("__a", amount.cast("long"))
    whole = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        cut.groupBy(key, "__b")
        .agg(F.sum("__a").alias("__s"))
        .select(key, "__b", F.coalesce(F.sum("__s").over(whole), F.lit(0)).alias("__before"))
    )
    inside = (
        Window.partitionBy(key, "__b")
        .orderBy(spread, *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        cut.withColumn("__in", F.coalesce(F.sum("__a").over(inside), F.lit(0)))
        .join(before, [key, "__b"])
        .withColumn(name, F.col("__before") + F.col("__in"))
        .select(*[F.col(f"`{c}`") for c in df.columns], name)
    )
