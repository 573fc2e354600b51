"""Maximal conversations, rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import query, table
from .snapshots import collapse

SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS pos, role, text FROM conversations),
p AS (SELECT conv_id, pos, md5(string_agg(md5(role) || md5(text), ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS h FROM t),
w AS (SELECT conv_id, max(pos) AS pos, max_by(h, pos) AS h FROM p GROUP BY conv_id),
k AS (SELECT min(conv_id) AS conv_id, pos, h, count(*) AS n_copies FROM w GROUP BY pos, h),
top AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM p JOIN w USING (conv_id) WHERE p.h = k.h AND p.pos = k.pos AND w.pos > p.pos))
SELECT top.conv_id, t.pos // 1000 AS page, any_value(top.pos + 1) AS n_turns, any_value(n_copies) AS n_copies,
       string_agg('<|' || role || '|>' || chr(10) || text, chr(10) ORDER BY t.pos) AS rendered
FROM top JOIN t USING (conv_id) GROUP BY top.conv_id, t.pos // 1000
"""


@query("op5_chats", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(table(spark, sf_dir, "conversations"))
