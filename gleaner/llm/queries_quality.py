"""Quality of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .kneser_ney import score_quality
from .registry import query, table


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return score_quality(docs, table(spark, sf_dir, "labels"), keep_text=False)
