"""Shards of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .packing import assign_shards
from .registry import query, table


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return sharded.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
