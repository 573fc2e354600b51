"""Quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .line_rules import apply_line_rules
from .registry import query, table

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS win FROM w, LATERAL unnest(range(1, len(words) - 6)) AS u(i)),
twin AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win) WHERE n > 1),
cover AS (SELECT rid, sum(least(8, i - coalesce(before, -8)))::BIGINT AS n_repeat_words FROM
          (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM twin) GROUP BY rid),
l AS (SELECT rid, source, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM w, LATERAL unnest(lines) AS u(line)),
common AS (SELECT source, line FROM l GROUP BY source, line HAVING count(DISTINCT rid) > 20),
gone AS (SELECT rid, sum(n)::BIGINT AS n FROM l JOIN common USING (source, line) GROUP BY rid),
base AS (SELECT rid, doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone.n, 0) AS common_words
         FROM w LEFT JOIN cover USING (rid) LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f AS base_failed, common_words,
       NOT f AND n_words - common_words >= 20 AND n_words - common_words >= 0.3 * n_words AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS f FROM base)
"""


@query("op7_line_rules", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_line_rules(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "common_words", "kept"
    )
