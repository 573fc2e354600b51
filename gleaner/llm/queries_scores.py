"""Log-probabilities of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .log_bilinear import score_texts
from .registry import query, table


@query("op10_lm_scores")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
