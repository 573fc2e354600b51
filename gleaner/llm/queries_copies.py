"""Exact copies among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .exact_copies import exact_duplicates
from .registry import query, table

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
o AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
      FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id, rid))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM o
"""


@query("op11_exact_copies", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_duplicates(docs, keep_text=False).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
