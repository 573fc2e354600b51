"""Contexts from hits ``query_id, rank, document, distance``.

A context holds at most k passages, so each group is small whatever the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed_3
from ..functions.vectors import similarity


def _joined(hits: DataFrame, part: Column, separator: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct(F.col("rank"), part.alias("part"))))
    text = F.array_join(F.transform(ordered, lambda e: e["part"]), separator)
    return hits.groupBy("query_id").agg(text.alias("context"))


def context_scored(hits: DataFrame) -> DataFrame:
    part = F.concat(
        F.lit("Document "), F.col("rank").cast("string"),
        F.lit(" (similarity: "), fixed_3(similarity(F.col("distance"))),
        F.lit("):\n"), F.col("document"), F.lit("\n"),
    )
    return _joined(hits, part, "\n")


def context_numbered(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Every question gets a row; one without hits says so."""
    part = F.concat(F.lit("Context "), F.col("rank").cast("string"), F.lit(": "), F.col("document"))
    found = _joined(hits, part, "\n\n")
    empty = F.lit("No relevant context found.")
    return (
        queries.select("query_id").join(found, "query_id", "left").withColumn("context", F.coalesce("context", empty))
    )


def context_plain(hits: DataFrame) -> DataFrame:
    return _joined(hits, F.col("document"), "\n\n")
