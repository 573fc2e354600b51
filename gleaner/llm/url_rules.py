"""URL rules by a sort-merge range join.

Every host is written from its last label to its first, so that the rules of a host and of all its
subdomains are strings with a common prefix, that is an interval of the sorted keys. A URL gets one
key for each suffix of its host (no longer than the longest host of a rule) with its whole path
behind; a rule fits exactly when its key is a prefix of one of them. Keys and rules are cut into
ranges by sampled bounds, a rule goes to every range that its interval touches, and one sweep over
the sorted rows of a range keeps the stack of the rules that are open.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordinals import join_hot, key_counts
from .common import lower_ascii, packed, ship, unpacked, without

RESULT = ("host", "path", "rule", "verdict")
#: Sorts behind every continuation of a prefix.
LAST = "\U0010ffff"
SAMPLE_PER_RANGE = 40


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _rule_table(rules: DataFrame) -> DataFrame:
    """One row per host and path; of two verdicts the later in the alphabet (block) holds. Rules with nulls fit nothing."""
    host = lower_ascii(F.col("host"))
    labels = _reversed_labels(host)
    return (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(
            F.concat(F.array_join(labels, "."), F.lit("."), F.col("path")).alias("key"),
            F.concat(host, F.col("path")).alias("rule"),
            F.size(labels).alias("labels"),
            "verdict",
        )
        .groupBy("key", "rule", "labels")
        .agg(F.max("verdict").alias("verdict"))
    )


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by range, key and kind, rules before keys; the stack holds the open rules."""
    at, stack = None, []
    for batch in batches:
        out = []
        for part, key, host, path, rule, labels, verdict in zip(
            batch["part"], batch["key"], batch["host"], batch["path"], batch["rule"], batch["labels"], batch["verdict"]
        ):
            if part != at:
                at, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, labels, verdict))
            elif stack:
                out.append((host, path, *stack[-1][1:]))
        yield pd.DataFrame(out, columns=["host", "path", "rule", "labels", "verdict"])


def match_rules(pairs: DataFrame, rules: DataFrame, ranges: int | None = None) -> DataFrame:
    """For distinct ``host, path`` rows those that a rule fits, with ``rule, verdict``: the longest rule,
    of equally long ones that of the longest host."""
    spark = pairs.sparkSession
    ship(spark)
    table = _rule_table(rules)
    depth = table.agg(F.coalesce(F.max("labels"), F.lit(0))).first()[0]
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    back = _reversed_labels(F.col("host"))
    count = F.least(F.size(back), F.lit(depth))
    keys = pairs.select(
        "host",
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), count),
                lambda k: F.concat(F.array_join(F.slice(back, F.lit(1), k), "."), F.lit("."), F.col("path")),
            )
        ).alias("key"),
    ).where(F.lit(depth > 0))
    # the salt spreads a key that many hosts share, such as "com./"
    keys = keys.withColumn("place", F.concat("key", F.lit("\x01"), F.substring(F.md5("host"), 1, 8)))
    total = keys.count()
    share = min(1.0, n * SAMPLE_PER_RANGE / max(total, 1))
    few = F.pmod(F.xxhash64("place"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    seen = sorted(r[0] for r in keys.where(few).select("place").collect())
    bounds = [seen[len(seen) * i // n] for i in range(1, n)] if seen else []

    @F.pandas_udf("int")
    def range_of(place: pd.Series) -> pd.Series:
        return place.map(lambda x: bisect_right(bounds, x)).astype("int32")

    @F.pandas_udf("array<int>")
    def ranges_of(key: pd.Series) -> pd.Series:
        return key.map(lambda x: list(range(bisect_right(bounds, x), bisect_right(bounds, x + LAST) + 1)))

    asked = keys.select(
        range_of("place").alias("part"), "place", "key", "host", "path", F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("int").alias("labels"),
        F.lit(None).cast("string").alias("verdict"),
    )
    given = table.select(
        F.explode(ranges_of("key")).alias("part"), F.col("key").alias("place"), "key",
        F.lit("").alias("host"), F.lit("").alias("path"), F.lit(0).alias("kind"), "rule", "labels", "verdict",
    )
    swept = (
        asked.unionByName(given)
        .repartition(n, "part")
        .sortWithinPartitions("part", "place", "kind", "key")
        .mapInPandas(_sweep, "host string, path string, rule string, labels int, verdict string")
    )
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "labels"))
    return swept.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """All rows of ``pages`` with ``host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains if the path of the URL
    starts with the rule's; the longest wins; without one the rule is null and ``default`` holds. A URL
    that is null or has no ``://`` has an empty host and path. Repeated rows are all kept; an empty table
    gives an empty result; columns of ``pages`` named like one of the four give way.
    """
    kept = without(pages, RESULT)
    link = pages[url]
    rows = pages.select(
        F.struct(*[pages[c] for c in kept.columns]).alias("row") if kept.columns else F.struct(F.lit(1).alias("none")).alias("row"),
        F.coalesce(url_host(link), F.lit("")).alias("host"),
        F.coalesce(url_path(link), F.lit("")).alias("path"),
    )
    pairs = key_counts(rows, ["host", "path"])
    found = match_rules(pairs.select("host", "path"), rules)
    joined = join_hot(
        rows.withColumn("spread", F.xxhash64("row")), found, ["host", "path"], ["spread"], counts=pairs
    )
    return joined.select(
        *unpacked(joined), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
