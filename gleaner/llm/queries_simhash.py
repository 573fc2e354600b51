"""Near-duplicates among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import query, table
from .simhash import near_duplicates


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, keep_text=False).select("doc_id", "fingerprint", "component_id").select("doc_id", "fingerprint", "component_id")
