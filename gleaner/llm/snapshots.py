"""Conversations that are snapshots of longer ones.

A log often holds a conversation once per turn, each time a little longer. The turns of a conversation
are hashed together with their place and summed up from the first on, so that every prefix has a
hash that follows from the one before. A conversation whose whole hash is also the hash of a proper
prefix of another is a snapshot and goes (anti-join); of equal conversations that with the smallest
id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinals import WINDOW_ROWS, join_hot, with_ordinal, with_running
from ..session import materialise

RESULT = ("conv_id", "n_turns", "n_copies", "rendered")
#: Lanes of 32 bits: sums stay exact in a long for 2^31 turns.
LANES = 3


def _lane(n: int) -> Column:
    turn = F.xxhash64(F.lit(n), "pos", F.coalesce(F.concat(F.lit("="), F.col("role")), F.lit("")), F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("")))
    return F.pmod(turn, F.lit(1 << 32))


def turn_prefixes(turns: DataFrame, min_rows: int = WINDOW_ROWS) -> DataFrame:
    """Turns with their place ``pos`` in the conversation from 0 and the hash lanes ``h0..`` of the prefix
    that ends there; written as a table, texts included."""
    rows = turns.select("conv_id", "turn", "role", "text", F.xxhash64("role", "text").alias("tie"))
    placed = with_ordinal(rows, ["turn", "role", "tie"], ["conv_id"], "pos", min_rows=min_rows)
    for n in range(LANES):
        placed = placed.withColumn(f"l{n}", _lane(n))
    summed = with_running(placed, ["pos"], ["conv_id"], "place", {f"s{n}": f"l{n}" for n in range(LANES)}, min_rows)
    own = [(F.col(f"s{n}") + F.col(f"l{n}")).alias(f"h{n}") for n in range(LANES)]
    return materialise(summed.select("conv_id", "turn", "role", "text", "pos", *own), "turn-prefixes")


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of conversations that no other one continues."""
    lanes = [f"h{n}" for n in range(LANES)]
    last = F.max_by(F.struct(*lanes), "pos")
    whole = prefixes.groupBy("conv_id").agg(last.alias("h"), F.max("pos").alias("pos")).select("conv_id", "pos", "h.*")
    # the proper prefixes: all but those that end where their conversation does, each counted once however common
    same = (F.col("p.pos") == F.col("w.pos")) & F.col("p.conv_id").eqNullSafe(F.col("w.conv_id"))
    proper = (
        prefixes.select("conv_id", "pos", *lanes).alias("p")
        .join(whole.alias("w"), same, "left_anti")
        .select("pos", *lanes)
        .distinct()
    )
    kinds = whole.groupBy("pos", *lanes).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    top = kinds.join(proper, ["pos", *lanes], "left_anti")
    return top.select("conv_id", (F.col("pos") + 1).alias("n_turns"), "n_copies")


def collapse(turns: DataFrame, page_turns: int = 1000, min_rows: int = WINDOW_ROWS, join_rows: int = 100_000) -> DataFrame:
    """Maximal conversations, rendered: ``conv_id, page, n_turns, n_copies, rendered``.

    ``turns`` has ``conv_id, turn, role, text``. Turns are ordered by turn, then role, then a hash of the
    text; repeated turns count each. A null role or text is a value of its own and renders as nothing;
    turns without ``conv_id`` form one conversation, which loses to an equal one that has an id. Each turn
    becomes ``<|role|>`` and its text on a line of their own. A conversation is rendered in pages of
    ``page_turns`` turns, so no task gathers an unbounded one; one with more than ``min_rows`` turns (windows) or
    ``join_rows`` (join) is spread over tasks. Other columns are not looked at; an empty table gives an empty result.
    """
    prefixes = turn_prefixes(turns, min_rows)
    top = maximal_conversations(prefixes)
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")))
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key")  # none is a conversation too
    spread = prefixes.select("conv_id", "pos", "role", "text", key)
    kept = join_hot(spread, top.select(key, "n_turns", "n_copies"), ["key"], ["pos"], "inner", min_rows=join_rows)
    entries = F.sort_array(F.collect_list(F.struct("pos", line.alias("line"))))
    return (
        kept.withColumn("page", F.floor(F.col("pos") / page_turns).cast("bigint"))
        .groupBy("conv_id", "page")
        .agg(F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), entries.alias("e"))
        .select("conv_id", "page", "n_turns", "n_copies", F.array_join(F.transform("e", lambda x: x["line"]), "\n").alias("rendered"))
    )
