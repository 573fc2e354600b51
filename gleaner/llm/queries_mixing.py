"""Mixing over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mixing import plan_mix
from .registry import query, table

SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1.0, 2.0, 3.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, cap / weight AS fill, (SELECT sum(source_size) FROM s)::DOUBLE AS total FROM w),
lv AS (SELECT (any_value(a.total) - coalesce(sum(b.cap) FILTER (b.fill < a.fill), 0))
              / sum(b.weight) FILTER (b.fill >= a.fill) AS level, a.fill FROM f a, f b GROUP BY a.source, a.fill),
t AS (SELECT source, source_size, least(cap, weight * (SELECT min_by(level, fill) FROM lv WHERE level <= fill))::DOUBLE AS target FROM f),
o AS (SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY ('0x' || substr(md5('=' || doc_id), 1, 8))::BIGINT // 2, '=' || doc_id
          ROWS UNBOUNDED PRECEDING) - size AS start FROM d)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CASE WHEN size = 0 THEN 0 ELSE size * len(list_filter([0, 1, 2], lambda e: e * source_size + start + size / 2.0 < target)) END::BIGINT AS taken
FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source
"""


@query("op1_mixing", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    planned = plan_mix(docs, keep_text=False).orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")
    return planned.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")
