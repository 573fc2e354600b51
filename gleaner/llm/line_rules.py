"""Quality rules: counts of a text, and lines that many documents of a host share.

Lines are normalised and hashed; a line is common at a host when more distinct documents than a limit
hold it. Common lines are removed, and documents that are left with too little are rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordinals import join_hot
from ..session import materialise
from .common import SPACE, WORD, known, lower_ascii, packed, unpacked, without

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
RESULT = (*BASE, "n_lines", "n_common_lines", "common_words", "cleaned", "kept")
WINDOW = 8


@dataclass(frozen=True)
class LineLimits:
    """A line is common when more than ``max_docs`` documents of its host hold it, however large the host; a document
    is depleted when fewer than ``min_words`` words or less than ``min_left`` of its words are left."""

    max_docs: int = 20
    min_words: int = 20
    min_left: float = 0.3
    min_doc_words: int = 20
    max_repeat_percent: int = 30


def _count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def _joined_hashes(hashes: Column, step: int) -> Column:
    """Hashes of runs twice as long: of each place with that ``step`` farther."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))


def _repeat_words(words: Column) -> Column:
    """Words inside an 8-word window that occurs twice or more.

    A word is hashed once, and the hash of a window grows from those of its halves. Only where some
    window recurs are (hash, place) pairs sorted, neighbours of equal hash marked, and their union measured.
    """
    recurring = _named(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda one: _named(
            _joined_hashes(one, 1),
            lambda two: _named(
                _joined_hashes(two, 2),
                lambda four: _named(
                    _joined_hashes(four, 4),
                    lambda eight: F.when(F.size(F.array_distinct(eight)) < F.size(eight), _covered(eight)).otherwise(F.lit(0)),
                ),
            ),
        ),
    )
    return F.when(F.size(words) > WINDOW, recurring).otherwise(F.lit(0)).cast("long")


def _covered(windows: Column) -> Column:
    """Places inside those windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twins = _named(
        pairs,
        lambda own: F.filter(
            F.zip_with(
                own, F.slice(own, F.lit(2), F.size(own)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
            ),
            lambda x: x.isNotNull(),
        ),
    )
    return F.aggregate(
        F.sort_array(F.array_distinct(F.flatten(twins))),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def with_base(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """Add the counts of ``text`` to ``rows``, and ``lines``: hash and words of each line that holds a word."""
    text = F.col("text")
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    # a generator is not merged with what reads its output, so the arrays are made once a row
    stored = rows.withColumn("a", F.explode(F.array(F.struct(words.alias("words"), lines.alias("lines")))))
    counted = stored.select(
        *rows.columns,
        F.size("a.words").cast("long").alias("n_words"),
        (F.coalesce(F.length(text), F.lit(0)).cast("long") - _count(text, SPACE)).alias("word_chars"),
        _count(text, r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("a.lines") - F.size(F.array_distinct("a.lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("a.words")).alias("n_repeat_words"),
        F.transform("a.lines", lambda x: F.struct(line_hash(x).alias("line"), _count(x, WORD).alias("words"))).alias("lines"),
    )
    failed = (F.col("n_words") < limits.min_doc_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed)


def line_hash(line: Column) -> Column:
    """Equal for lines that differ in white space or the case of A-Z only."""
    return F.xxhash64(lower_ascii(F.trim(F.regexp_replace(line, SPACE + "+", " "))))


def common_lines(rows: DataFrame, limits: LineLimits) -> tuple[DataFrame, DataFrame]:
    """Lines ``host, line`` above the limit, and the number of documents of every line, from ``host, lines``."""
    # the lines of a document are distinct inside its row, so partial counts need no document
    counts = materialise(
        rows.select("host", F.explode(F.array_distinct("lines.line")).alias("line"))
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("__n")),
        "line-counts",
    )
    common = counts.where(F.col("__n") > limits.max_docs)
    return materialise(common.select("host", "line"), "common-lines"), counts


def apply_line_rules(
    docs: DataFrame, limits: LineLimits = LineLimits(), key: str = "doc_id", text: str = "text", host: str = "source",
    keep_text: bool = True,
) -> DataFrame:
    """All rows with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` of the whole
    text, ``n_lines, n_common_lines, common_words``, the text without common lines as ``cleaned``, and
    ``kept``. Without ``keep_text`` neither the text nor ``cleaned`` is handed on.

    A text is read once: its counts and the hashes of its lines are written, and all else is told from
    those. A null text has no words and fails; its ``cleaned`` is null. A null host is a host. Lines are
    those between newlines that hold a word. Identical rows are judged alike, and each stays. Columns
    named like the result's give way; an empty table gives an empty result.
    """
    kept = without(docs, RESULT if keep_text else (*RESULT, text))
    rows = docs.select(
        packed(kept).alias("row"),
        docs[text].alias("text"),
        known(docs[host]).alias("host"),
    )
    based = with_base(rows, limits)
    # the row numbers are fixed by writing them
    based = materialise(
        (based if keep_text else based.drop("text")).withColumn("id", F.monotonically_increasing_id()), "line-hashes"
    )
    common, counts = common_lines(based, limits)
    lines = based.select("id", "host", F.inline("lines"))
    hits = join_hot(lines, common, ["host", "line"], ["id"], how="inner", counts=counts)
    per_doc = hits.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_common_lines"), F.sum("words").alias("common_words"), F.collect_set("line").alias("gone")
    )
    per_doc = per_doc if keep_text else per_doc.drop("gone")
    done = (
        based.withColumn("n_lines", F.size("lines")).drop("lines", "host")
        .join(per_doc, "id", "left")
        .withColumn("n_common_lines", F.coalesce("n_common_lines", F.lit(0)).cast("long"))
        .withColumn("common_words", F.coalesce("common_words", F.lit(0)).cast("long"))
    )
    left = F.col("n_words") - F.col("common_words")
    verdict = ~F.col("base_failed") & (left >= limits.min_words) & (left >= limits.min_left * F.col("n_words"))
    out = [*unpacked(done), *BASE, "n_lines", "n_common_lines", "common_words", verdict.alias("kept")]
    if keep_text:
        stay = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("gone", line_hash(x)))
        out.append(F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n")).alias("cleaned"))
    return done.select(*out)
