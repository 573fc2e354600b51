"""Mixing sources to target weights along a time-varying curriculum.

Each source has a share of all words and a schedule: its weight over training time, piecewise linear
between knots. Time runs from 0 to 1. The integral of the schedule, scaled to the source's target, is
its cumulative demand; the words of a source, in an order fixed by a hash, are laid along that demand,
again from the start when they run out, and inverting it gives every document its training position.
Sorting by position mixes the sources.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, buckets_for, even_hash, known, packed, unpacked, with_earlier_sum, without

RESULT = ("size", "source_size", "target", "copies", "taken", "positions")
#: Knots (time, weight) of the schedules; source k, in the order of the weights, takes schedule k mod 3.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
MAX_REPEATS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``target`` and ``schedule`` number for each source of ``sizes`` (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn. Targets are the water level: a
    source is given its weight's part of what is left over from those that have reached
    ``max_repeats`` times their size. Sources fill in the order of cap over weight, so the level
    follows from running sums over one thin row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    upto, ahead = by_fill.rowsBetween(Window.unboundedPreceding, 0), by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    # the level if this source and all that fill later stay below their caps
    level = (F.col("total") - F.col("capped") + F.col("cap")) / F.col("open")
    return (
        sizes.withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("capped", F.sum("cap").over(upto))
        .withColumn("open", F.sum("weight").over(ahead))
        .withColumn("turn", F.row_number().over(by_fill))
        .withColumn("level", F.min(F.when(level <= F.col("fill"), F.struct("turn", level.alias("level")))).over(everything)["level"])
        .select("source", "source_size", F.least(F.col("cap"), F.col("weight") * F.col("level")).alias("target"), "rank")
    )


def _invert(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which ``share`` of the schedule's integral is reached."""
    parts = [(t0, w0, t1, w1, (t1 - t0) * (w0 + w1) / 2) for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    whole = sum(p[4] for p in parts)
    out, done = F.lit(1.0), sum(p[4] for p in parts)
    for t0, w0, t1, w1, area in reversed(parts):
        done -= area
        x = F.greatest(share * F.lit(whole) - F.lit(done), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        # w0 u + slope u^2 / 2 = x, in the form that does not divide by the slope
        time = F.lit(t0) + x * 2 / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + x * (2 * slope), F.lit(0.0))))
        out = F.when(share * F.lit(whole) <= F.lit(done + area), time).otherwise(out)
    return out


def _inverse(knots: Sequence[tuple[float, float]]) -> Callable[[Column], Column]:
    return lambda share: _invert(share, knots)


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    max_repeats: int = MAX_REPEATS,
    key: str = "doc_id",
    keep_text: bool = True,
) -> DataFrame:
    """All rows with ``size, source_size, target, copies, taken, positions``.

    A document is taken whole, each time when the middle of its words lies below its source's target;
    ``positions`` are the training times of its copies. So the words taken from a source are within half
    a document of its target, and no document is taken more than ``max_repeats`` times. A null or empty
    text has size 0 and is taken zero words. A null source is a source of its own. Rows with equal keys
    are ordered by their texts' hash; identical rows are interchangeable. Columns named like the
    result's give way; an empty table gives an empty result.
    """
    if any(w <= 0 for w in weights) or any(w < 0 or k[0][0] != 0 or k[-1][0] != 1 for k in schedules for _, w in k):
        raise ValueError("weights are positive; schedules run from 0 to 1 and are not negative")
    kept = without(docs, RESULT if keep_text else (*RESULT, "text"))
    rows = docs.select(
        packed(kept).alias("row"),
        docs["source"].alias("source"),
        known(docs["source"]).alias("in"),
        n_words(docs["text"]).alias("size"),
        even_hash(docs[key]).alias("spread"),
        known(docs[key]).alias("id"),
        F.xxhash64(docs["text"]).alias("mark"),
    )
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    buckets = buckets_for(found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    goals = source_targets(found.drop("n"), weights, max_repeats)
    goals = goals.select(known(F.col("source")).alias("in"), "source_size", "target", "rank")
    placed = with_earlier_sum(rows, "in", "spread", ["id", "mark", "size"], F.col("size"), "start", buckets)
    full = placed.join(goals, "in")
    middle = F.col("start") + F.col("size") / F.lit(2.0)
    epochs = F.array(*[F.lit(e) for e in range(max_repeats)])
    at = F.transform(epochs, lambda e: e * F.col("source_size") + middle)
    share = F.transform(
        F.filter(at, lambda m: (m < F.col("target")) & (F.col("size") > 0)), lambda m: m / F.col("target")
    )
    times = F.when(F.lit(False), share)
    for k, knots in enumerate(schedules):
        times = times.when(
            F.col("rank") % len(schedules) == k, F.transform(share, _inverse(tuple(knots)))
        )
    done = full.withColumn("positions", times).withColumn("copies", F.size("positions"))
    return done.select(
        *unpacked(done), "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), "positions",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The training sequence: a row for each copy, with ``epoch`` and ``position``, range-sorted by position."""
    kept = without(docs, [*RESULT, "epoch", "position"])
    planned = plan_mix(kept, **options)
    return (
        planned.select(*kept.columns, F.posexplode("positions").alias("epoch", "position"))
        .orderBy("position", "doc_id", "epoch")
    )
