"""Divergence of the sources of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .divergence import audit_sources
from .registry import query, table

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT rid, lang, source, term, count(*) AS n FROM d, LATERAL unnest(terms) AS u(term) GROUP BY ALL),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(*) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(s.n, 0)::HUGEINT AS n FROM g JOIN kept k USING (lang)
      LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM o GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v)::HUGEINT AS p FROM c JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
      FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS f
                     FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
"""


@query("op12_divergence", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents").select("lang", "source", "text"))
