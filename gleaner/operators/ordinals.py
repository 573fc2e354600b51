"""Positions, pages and totals that hold up when one key owns a third of all rows.

A plain ``row_number`` over a key (or over no key) puts the whole group into one
task. Hot keys are found by a partial count, and only their rows are
range-partitioned on key *and* order, so that a large group spans many tasks;
each row's position is the size of the group's earlier partitions plus its place
inside its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# Most rows of a few plain columns each that are broadcast.
THIN_KEYS = 200_000
# Most bytes of a page's entries; a single entry may be longer.
PAGE_BYTES = 32 * 1024 * 1024
# Rows of one key that one task may sort in a window.
WINDOW_ROWS = 1_000_000
_PID, _MID = "__pid", "__mid"


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """Rows with partition number and in-order row marker, fixed in a written table.

    The marker depends on the range bounds, hence on a sample; writing it makes
    it stable when a lost task is run again.
    """
    by = [*keys, *order]
    mid = F.monotonically_increasing_id()
    tagged = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn(_MID, mid)
        .withColumn(_PID, F.shiftright(_MID, 33))
    )
    return materialise(tagged, label)


def _prior(stable: DataFrame, keys: Sequence[str], measure: Column) -> DataFrame:
    """Per (key, partition): first marker and the measure of the earlier partitions.

    One row per key and partition, so the window sees at most as many rows per
    key as there are partitions.
    """
    sizes = stable.groupBy(*keys, _PID).agg(measure.alias("__n"), F.min(_MID).alias("__first"))
    earlier = (
        Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.select(
        *keys, _PID, "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )


def _with_prior(stable: DataFrame, prior: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on (key, partition), which is never hot.

    Without a key there is one row per partition, few enough to broadcast.
    """
    s, p = stable.alias("s"), (prior if keys else F.broadcast(prior)).alias("p")
    on = F.col(f"s.{_PID}") == F.col(f"p.{_PID}")
    for k in keys:
        on = on & F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}"))
    return s.join(p, on).select("s.*", "p.__first", "p.__before")


def _split_hot(
    df: DataFrame, keys: Sequence[str], min_rows: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ordinary keys and rows of hot keys; None where there are none.

    A key is hot with more than ``min_rows`` rows and a thousandth of all; at most
    1,000 keys are, so their list is broadcast.
    """
    counts = key_counts(df, keys)
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    hot = counts.where(F.col("__n") > max(total / 1000, min_rows)).select(*keys)
    if hot.isEmpty():
        return df, None
    h = F.broadcast(hot.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)]))
    on = [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)]
    return df.join(h, on, "left_anti"), df.join(h, on, "left_semi")


def _ranged_ordinal(df: DataFrame, order: Sequence[str], keys: Sequence[str], name: str, start: int) -> DataFrame:
    stable = _ranged(df, keys, order, name)
    joined = _with_prior(stable, _prior(stable, keys, F.count(F.lit(1))), keys)
    pos = F.col("__before") + F.col(_MID) - F.col("__first") + F.lit(start)
    return joined.select(*df.columns, pos.cast("bigint").alias(name))


def _ranged_sum(df: DataFrame, value: str, order: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    stable = _ranged(df, keys, order, name)
    joined = _with_prior(stable, _prior(stable, keys, F.sum(value)), keys)
    inside = (
        Window.partitionBy(*keys, _PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, 0)
    )
    total = F.col("__before") + F.sum(value).over(inside)
    return joined.select(*df.columns, total.cast("bigint").alias(name))


def _union(parts: list[DataFrame]) -> DataFrame:
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_ordinal(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "pos",
    start: int = 0,
    min_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add the position of each row inside its key, in ``order`` (a total order).

    Without a key the whole table is one group. Ordinary keys take a plain window.
    """
    if not keys:
        return _ranged_ordinal(df, order, keys, name, start)
    usual, hot = _split_hot(df, keys, min_rows)
    by = Window.partitionBy(*keys).orderBy(*order)
    parts = []
    if usual is not None:
        pos = (F.row_number().over(by) + F.lit(start - 1)).cast("bigint")
        parts.append(usual.select(*df.columns, pos.alias(name)))
    if hot is not None:
        parts.append(_ranged_ordinal(hot, order, keys, name, start))
    return _union(parts)


def with_running_sum(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    keys: Sequence[str],
    name: str,
    min_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add the running sum of ``value`` inside its key, the current row included."""
    usual, hot = _split_hot(df, keys, min_rows)
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    parts = []
    if usual is not None:
        parts.append(usual.select(*df.columns, F.sum(value).over(by).cast("bigint").alias(name)))
    if hot is not None:
        parts.append(_ranged_sum(hot, value, order, keys, name))
    return _union(parts)


def key_positions(df: DataFrame, order: Sequence[str], name: str = "pos", start: int = 0) -> DataFrame | None:
    """``order`` columns and their position, from these columns alone; None if a key repeats.

    No other column of ``df`` is read, sorted or moved.
    """
    stable = _ranged(df.select(*order), (), order, name)
    if not stable.groupBy(*order).count().where("count > 1").isEmpty():
        return None
    placed = _with_prior(stable, _prior(stable, (), F.count(F.lit(1))), ())
    pos = F.col("__before") + F.col(_MID) - F.col("__first") + F.lit(start)
    return placed.select(*order, pos.cast("bigint").alias(name))


def with_late_position(df: DataFrame, order: Sequence[str], name: str = "pos", start: int = 0) -> DataFrame:
    """As :func:`with_ordinal` without a key, for rows whose ``order`` is unique and whose other columns are heavy.

    The keys alone are numbered, and the position is joined to the rows: they are not sorted for the numbering
    nor written, and stay where they are while the numbered keys are small. Rows with a repeated key are
    numbered whole.
    """
    placed = key_positions(df, order, name, start)
    if placed is None:
        return with_ordinal(df, order, (), name, start)
    own = placed.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], name)
    on = [df[c].eqNullSafe(own[f"__o{i}"]) for i, c in enumerate(order)]
    return df.join(own, on).select(*[df[c] for c in df.columns], own[name])


def with_running(
    df: DataFrame, order: Sequence[str], keys: Sequence[str], pos: str, sums: dict[str, str], min_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Add the position inside the key, from 0, and for each ``name: column`` of ``sums`` the column's sum over earlier rows."""
    usual, hot = _split_hot(df, keys, min_rows)
    parts = []
    if usual is not None:
        by = Window.partitionBy(*keys).orderBy(*order)
        before = by.rowsBetween(Window.unboundedPreceding, -1)
        added = [F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint").alias(n) for n, c in sums.items()]
        parts.append(usual.select("*", (F.row_number().over(by) - 1).cast("bigint").alias(pos), *added))
    if hot is not None:
        stable = _ranged(hot, keys, order, pos)
        sizes = stable.groupBy(*keys, _PID).agg(
            F.count(F.lit(1)).alias("__rows"), F.min(_MID).alias("__first"), *[F.sum(c).alias(f"__{n}") for n, c in sums.items()]
        )
        earlier = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
        totals = {f"__{n}": F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)) for n in sums}
        prior = sizes.withColumns({"__before": F.coalesce(F.sum("__rows").over(earlier), F.lit(0)), **totals})
        s, p = stable.alias("s"), prior.alias("p")
        on = [F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}")) for k in [*keys, _PID]]
        joined = s.join(p, on).select("s.*", "p.__before", "p.__first", *[f"p.__{n}" for n in sums])
        inside = Window.partitionBy(*keys, _PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
        added = [
            (F.col(f"__{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).cast("bigint").alias(n) for n, c in sums.items()
        ]
        place = (F.col("__before") + F.col(_MID) - F.col("__first")).cast("bigint").alias(pos)
        parts.append(joined.select(*df.columns, place, *added))
    return _union(parts)


def paged_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    page_size: int = 1000,
    min_rows: int = WINDOW_ROWS,
    size: Column | None = None,
    page_bytes: int = PAGE_BYTES,
) -> DataFrame:
    """Ordered lists per key, split into pages of at most ``page_size`` entries and ``page_bytes`` bytes.

    Nothing is dropped: the list of a key is the concatenation of its pages, in their numbers' order. A key
    within both bounds has exactly one page, number 0; where bytes cut, a number may be left out. ``size`` is
    an entry's bytes (none: only entries count). Entries above half the bound have a page of their own; the
    others are cut where the sum of their earlier bytes passes a multiple of that half, so that a page never
    holds more than the bound, unless a single entry does.
    """
    half = max(1, page_bytes // 2)
    big = F.coalesce(size, F.lit(0)).cast("bigint") if size is not None else F.lit(0).cast("bigint")
    rows = df.withColumn("__value", value).withColumn("__bytes", big)
    rows = rows.withColumns({
        "__big": (F.col("__bytes") > half).cast("bigint"),
        "__small": F.when(F.col("__bytes") > half, F.lit(0)).otherwise(F.col("__bytes")).cast("bigint"),
    })
    placed = with_running(rows, order, keys, "__pos", {"__bigs": "__big", "__start": "__small"}, min_rows)
    entry = F.struct(F.col("__pos"), F.col("__value"))
    page = F.floor(F.col("__pos") / page_size) + F.floor(F.col("__start") / half) + 2 * F.col("__bigs") + F.col("__big")
    return (
        placed.withColumn("page", page.cast("bigint"))
        .groupBy(*keys, "page")
        .agg(F.sort_array(F.collect_list(entry)).alias("__entries"))
        .select(*keys, "page", F.transform("__entries", lambda e: e["__value"]).alias(name))
    )


def paged_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    separator: str = "\n",
    page_size: int = 1000,
    min_rows: int = WINDOW_ROWS,
    page_bytes: int = PAGE_BYTES,
) -> DataFrame:
    """As :func:`paged_lists`, each page joined to one text; the separators are on top of the bytes."""
    size = F.octet_length(value)
    pages = paged_lists(df, keys, order, value, name, page_size, min_rows, size, page_bytes)
    return pages.withColumn(name, F.array_join(name, separator))


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows per key as a written thin table (partial counts before the shuffle)."""
    return materialise(df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")), "key-counts")


def join_hot(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    counts: DataFrame | None = None,
    salts: int = 32,
    share: float = 0.001,
    min_rows: int = 100_000,
    thin_keys: int = 0,
) -> DataFrame:
    """Join ``big`` with ``small`` (one row per key) when some keys may be hot.

    A key with more than ``share`` of all rows is hot; there are at most
    ``1/share`` of them, so their list is broadcast. Rows of a hot key go to
    ``salts`` tasks and only its row of ``small`` is repeated. The salt is a hash of
    the row's own ``spread`` columns, so a task run again takes the same rows.

    Where the rows of ``small`` are thin, ``thin_keys`` allows to broadcast those that
    ``big`` asks for when its keys, which are counted, are not more than that; then
    ``big`` is not shuffled at all.
    """
    counts = key_counts(big, on) if counts is None else counts
    keys, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0))).first()
    if keys <= thin_keys:
        asked = small.join(F.broadcast(counts.select(*on)), list(on), "left_semi")
        return big.join(F.broadcast(asked), list(on), how)
    hot = counts.where(F.col("__n") > max(total * share, min_rows)).select(*on, F.lit(salts).alias("__salts"))
    if hot.isEmpty():
        return big.join(small, list(on), how)
    n = F.coalesce("__salts", F.lit(1))
    # a null key meets nothing, but its rows would all be sent to one task
    null_key = reduce(or_, [F.col(f"`{k}`").isNull() for k in on])
    parts = F.when(null_key, F.lit(salts)).otherwise(n)
    left = big.join(F.broadcast(hot), list(on), "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*spread), parts).cast("int")
    )
    right = small.join(F.broadcast(hot), list(on), "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), n - 1))
    )
    return left.drop("__salts").join(right.drop("__salts"), [*on, "__salt"], how).drop("__salt")


def with_key_totals(
    df: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    min_rows: int = 100_000,
    thin_keys: int = THIN_KEYS,
    **totals: Column,
) -> DataFrame:
    """Attach aggregates of a key to each of its rows, without a window over the key. Null is a key."""
    names = [f"__key{i}" for i in range(len(keys))]
    coded = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")).alias(n) for k, n in zip(keys, names)]
    rows = df.select("*", *coded)
    sums = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), *[c.alias(n) for n, c in totals.items()])
    sums = materialise(sums, "key-totals")
    joined = join_hot(rows, sums.drop("__n"), names, spread, counts=sums, min_rows=min_rows, thin_keys=thin_keys)
    return joined.drop(*names)
