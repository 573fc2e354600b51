"""Benchmark passages in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import benchmark_hits
from .registry import query, table

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
       FROM b, LATERAL unnest(range(1, greatest(len(w) - 8, 2))) AS u(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT rid, m, i, array_to_string(w[i:i + m - 1], ' ') AS win FROM d, lens, LATERAL unnest(range(1, len(w) - m + 2)) AS u(i)),
hit AS (SELECT rid, i, m, item_id FROM dw JOIN bw USING (m, win)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, LATERAL unnest(range(i, i + m)) AS u(p) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


@query("op8_decontaminate", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
