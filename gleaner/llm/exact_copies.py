"""Exact copies: groups of one 128-bit content hash, whose bytes are compared.

Rows are grouped by the MD5 of their normalised text on thin rows, and the row that stays is the least by
a stable order. Texts themselves move only where their hash occurs twice or more: the distinct texts of
such a hash are gathered, partly in every task, so that a group of a third of all rows moves one text a
task. A hash with two texts is a collision; its rows are grouped by hash and text instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordinals import join_hot
from ..session import materialise
from .common import maybe_among, packed, unpacked, without

RESULT = ("keep_id", "group_size", "kept", "text_sha256")
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def without_blanks(text: Column) -> Column:
    """The text without ASCII white space; null is the empty text."""
    return F.coalesce(F.translate(text, BLANKS, ""), F.lit(""))


def _hashed(docs: DataFrame, text: str, digest: Callable[[Column], Column], *cols: Column) -> DataFrame:
    norm = without_blanks(docs[text])
    return docs.select(*cols, norm.alias("norm"), digest(norm).alias("hash"))


def collisions(docs: DataFrame, repeated: DataFrame, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """``hash, norm, class`` (from 1) for every text of a hash that two or more texts have."""
    rows = maybe_among(_hashed(docs, text, digest), F.xxhash64("hash"), repeated.select(F.xxhash64("hash").alias("code")))
    texts = rows.groupBy("hash").agg(F.collect_set("norm").alias("texts")).where(F.size("texts") > 1)
    found = texts.select("hash", F.posexplode(F.sort_array("texts")).alias("class", "norm"))
    return materialise(found.select("hash", "norm", (F.col("class") + 1).alias("class")), "collisions")


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", longest: bool = True, keep_text: bool = True,
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """All rows with ``keep_id``, the key of the row of its group that stays, ``group_size``, ``kept`` and
    ``text_sha256`` of the normalised text.

    Texts are equal when they are the same without ASCII white space; null is the empty text, and empty
    texts are a group. The longest original text stays (unless ``longest`` is false), then the least key,
    null keys last; among rows of one key and length one, chosen by a hash of its text. Repeated rows are
    members like any other. Columns named like the result's give way, the text too unless it is to be kept;
    an empty table gives an empty result. ``digest`` only spreads: its collisions are told apart by bytes.
    """
    kept = without(docs, RESULT if keep_text else (*RESULT, text))
    length = F.coalesce(F.length(docs[text]), F.lit(0)) if longest else F.lit(0)
    columns = [
        packed(kept).alias("row"), docs[key].alias("key"), length.alias("length"), F.xxhash64(docs[text]).alias("tie"),
    ]

    def thin(known: DataFrame | None) -> DataFrame:
        rows = _hashed(docs, text, digest, *columns).withColumn("text_sha256", F.sha2("norm", 256))
        if known is not None:
            rows = join_hot(rows, known, ["hash", "norm"], ["key", "tie"], min_rows=2_000)
        classed = F.lit(0) if known is None else F.coalesce("class", F.lit(0))
        rows = rows.select("row", "key", "length", "tie", "hash", "text_sha256", classed.alias("class"))
        return materialise(rows.withColumn("id", F.monotonically_increasing_id()), "content-hashes")

    def grouped(rows: DataFrame) -> DataFrame:
        order = F.struct((-F.col("length")).alias("length"), F.col("key").isNull().alias("none"), "key", "tie", "id")
        groups = rows.groupBy("hash", "class").agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("first"))
        return materialise(groups, "groups")

    rows = thin(None)  # the row numbers are fixed by writing them
    groups = grouped(rows)
    clashing = collisions(docs, groups.where("__n > 1"), text, digest)
    if not clashing.isEmpty():
        rows = thin(clashing)
        groups = grouped(rows)
    several = groups.where("__n > 1").select("hash", "class", F.col("__n").alias("size"), "first")
    done = join_hot(rows, several, ["hash", "class"], ["id"], counts=groups, min_rows=2_000)
    alone = F.col("size").isNull()
    return done.select(
        *unpacked(done), F.when(alone, F.col("key")).otherwise(F.col("first.key")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("id") == F.col("first.id"))).alias("kept"), "text_sha256",
    )
