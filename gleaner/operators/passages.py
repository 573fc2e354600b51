"""Corpus samples to passages, documents, ids and metadata.

Input: ``id, type, level, context STRUCT<title ARRAY<STRING>, sentences
ARRAY<ARRAY<STRING>>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import unnest_rows
from ..functions.text import first_present


def _zipped(df: DataFrame) -> DataFrame:
    """Project names first, so that the zipped struct keeps them."""
    named = df.withColumns({"title": F.col("context.title"), "sentences": F.col("context.sentences")})
    n = F.greatest(F.least(F.size("title"), F.size("sentences")), F.lit(0))
    return named.withColumn("entries", F.slice(F.arrays_zip("title", "sentences"), F.lit(1), n)).drop(
        "title", "sentences", "context"
    )


def unnest(df: DataFrame, joiner: str, id_infix: str, first: int) -> DataFrame:
    """One row per context entry: ``id, document`` and the sample's other columns."""
    others = [c for c in df.columns if c not in ("id", "context")]
    exploded = unnest_rows(_zipped(df), "entries", "ordinal", "entry", "id", *others)
    ordinal = F.col("ordinal") + F.lit(first)
    return exploded.select(
        F.concat(F.col("id"), F.lit(id_infix), ordinal.cast("string")).alias("id"),
        F.col("id").alias("sample_id"),
        ordinal.alias("ordinal"),
        F.concat(
            F.col("entry.title"), F.lit(" : "), F.array_join(F.col("entry.sentences"), joiner)
        ).alias("document"),
        *others,
    )


def passages_base(df: DataFrame) -> DataFrame:
    return unnest(df, "; ", "_", 0)


def passages_ctx(df: DataFrame) -> DataFrame:
    return unnest(df, " ", "_ctx", 1)


def _one_document(df: DataFrame, entry_text, joiner: str) -> DataFrame:
    zipped = _zipped(df)
    text = F.array_join(F.transform("entries", entry_text), joiner)
    return zipped.withColumn("document", text).drop("entries")


def sample_document(df: DataFrame) -> DataFrame:
    """All entries of a sample in one text, joined by comma."""
    return _one_document(
        df, lambda e: F.concat(e["title"], F.lit(" : "), F.array_join(e["sentences"], " ")), ", "
    )


def list_text(items: Column) -> Column:
    """A list of strings as printed by Python; quotes switch when an item holds ``'``.

    Backslashes, control characters and items holding both quote kinds print
    with escapes in Python; those are kept unescaped here.
    """

    def quoted(x: Column) -> Column:
        q = F.when(F.contains(x, F.lit("'")), F.lit('"')).otherwise(F.lit("'"))
        return F.concat(q, x, q)

    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def sample_document_list_text(df: DataFrame) -> DataFrame:
    return _one_document(df, lambda e: F.concat(e["title"], F.lit(" : "), list_text(e["sentences"])), " ")


def sample_document_pairs(df: DataFrame) -> DataFrame:
    """As :func:`sample_document` for ``context ARRAY<STRUCT<title, sentences>>`` with gaps."""

    def entry_text(e: Column, i: Column) -> Column:
        title = F.coalesce(e["title"], F.concat(F.lit("title["), i.cast("string"), F.lit("]")))
        sentences = F.coalesce(F.array_join(e["sentences"], " "), F.lit(""))
        return F.concat(title, F.lit(" : "), sentences)

    text = F.array_join(F.transform("context", entry_text), ", ")
    return df.withColumn("document", text).drop("context")


def derive_id(fallback: Column, prefix: str, *ids: Column) -> Column:
    return F.coalesce(first_present(*ids, F.lit(None).cast("string")), F.concat(F.lit(prefix), fallback.cast("string")))


def metadata_default(type_: Column, level: Column) -> Column:
    unknown = F.lit("unknown")
    return F.create_map(
        F.lit("type"), F.coalesce(type_, unknown), F.lit("level"), F.coalesce(level, unknown)
    )


def metadata_sparse(type_: Column, level: Column) -> Column:
    """Only the keys present; NULL when there is none."""
    kept = F.map_filter(
        F.create_map(F.lit("type"), type_, F.lit("level"), level), lambda k, v: v.isNotNull()
    )
    return F.when(F.coalesce(type_, level).isNotNull(), kept)


def metadata_qa(question: Column, answer: Column, type_: Column, level: Column) -> Column:
    return F.create_map(
        F.lit("question"), F.coalesce(question, F.lit("")),
        F.lit("answer"), F.coalesce(answer, F.lit("")),
        F.lit("level"), F.coalesce(level, F.lit("unknown")),
        F.lit("type"), F.coalesce(type_, F.lit("unknown")),
    )


def metadata_source(source: str, split: str) -> Column:
    return F.create_map(F.lit("source"), F.lit(source), F.lit("split"), F.lit(split))
