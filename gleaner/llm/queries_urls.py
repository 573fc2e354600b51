"""URL rules over all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import query, table
from .url_rules import judge_urls

# The rules of the contract (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

SQL = f"""
WITH rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
SELECT page_id, host, path, any_value(rule) AS rule, any_value(verdict) AS verdict FROM (
  SELECT row_number() OVER () AS rid, page_id, host, path FROM parts
) u LEFT JOIN LATERAL (
  SELECT h || p AS rule, v FROM rules
  WHERE (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)
  ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1
) b ON true
CROSS JOIN LATERAL (SELECT coalesce(b.v, 'allow') AS verdict) c
GROUP BY rid, page_id, host, path
"""


@query("op9_url_rules", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")
