"""Streams: corpus ingest and the chat store.

Both write each micro-batch to its own ``batch_id`` folder, overwritten when the
batch is run again after a failure, so every row lands exactly once. The ingest finds
earlier ids through an index on disk; the chat store keeps turns as keyed state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chats import chat_title
from .id_index import IdIndex

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Turn numbers of one chat that one page holds.
PAGE_TURNS = 1000
_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_ingest(
    samples: DataFrame, to_passages: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, index: IdIndex | None = None
) -> StreamingQuery:
    """New corpus rows -> passages -> collection, each passage id once.

    Of one id in a batch the row with the least contents stays. Earlier ids are looked up in ``index`` (beside the
    target unless given), which opens only the buckets that may hold some of them.
    """
    index = index or IdIndex(f"{target}-index")

    def add(batch: DataFrame, batch_id: int) -> None:
        passages = to_passages(batch)
        others = [F.col(c) for c in passages.columns if c != "id"]
        least = passages.groupBy("id").agg(F.min(F.struct(*others)).alias("least")).select("id", "least.*") if others else passages.distinct()
        rows = least.select(passages.columns).persist()
        try:
            _write_batch(index.unknown(rows, batch_id), target, batch_id)
        finally:
            rows.unpersist()
        index.add(batch.sparkSession.read.schema(rows.schema).parquet(f"{target}/batch_id={batch_id}").select("id"), batch_id)

    return (
        samples.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_chat_store(turns: DataFrame, target: str, checkpoint: str, page_turns: int = PAGE_TURNS) -> StreamingQuery:
    """Turns ``chat_id, turn, role, content, ts, error`` and perhaps ``model_nm`` -> the current turns of their chats.

    The state is keyed by chat, page (``page_turns`` turn numbers each) and turn, and lies in RocksDB. Of two deliveries
    of a turn the earlier one counts, then the lesser: whatever the order or number of deliveries, the turn is the same.
    A batch writes the turns that were delivered in it, as they stand; :func:`chat_pages` makes the pages.
    Failed turns are ignored, and so are turns without a number; a missing text is an empty one.
    """
    spark = turns.sparkSession
    spark.conf.set(STATE_STORE, ROCKSDB)
    texts = {
        "ts": F.date_format("ts", _STAMP), "role": F.col("role"), "content": F.col("content"),
        "model_nm": F.col("model_nm") if "model_nm" in turns.columns else F.lit(None).cast("string"),
    }
    told = turns.where("error IS NULL AND turn IS NOT NULL").select(
        "chat_id", F.floor(F.col("turn") / page_turns).cast("bigint").alias("page"), F.col("turn").cast("bigint").alias("turn"),
        F.struct(*[F.coalesce(text, F.lit("")).alias(name) for name, text in texts.items()]).alias("told"),
    )
    current = told.groupBy("chat_id", "page", "turn").agg(F.min("told").alias("told"))
    return (
        current.writeStream.foreachBatch(lambda batch, batch_id: _write_batch(batch, target, batch_id))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def chat_pages(written: DataFrame) -> DataFrame:
    """The current pages of the turns that the batches wrote, each a row with its messages in order.

    What a later batch wrote of a turn is never greater, so the least is the newest. All rows of a page go to one
    task at once, where its turns and then the page are put together without another shuffle.
    """
    turns = written.repartition("chat_id", "page").groupBy("chat_id", "page", "turn").agg(F.min("told").alias("told"))
    asked = F.when(F.col("told.role") == "user", F.col("turn"))
    named = F.when(F.col("told.model_nm") != "", F.col("turn"))
    message = F.struct("turn", "told.role", "told.content", "told.ts")
    return turns.groupBy("chat_id", "page").agg(
        F.count(F.lit(1)).alias("n_messages"), F.min(asked).alias("first_turn"), F.min_by("told.content", asked).alias("first_message"),
        F.min_by("told.model_nm", named).alias("model_nm"), F.min("told.ts").alias("created"), F.max("told.ts").alias("updated"),
        F.sort_array(F.collect_list(message)).alias("messages"),
    )


def chat_messages(pages: DataFrame) -> DataFrame:
    """``chat_id, turn, role, content``: a chat's history, a row per turn."""
    return pages.select("chat_id", F.inline("messages")).select("chat_id", "turn", "role", "content")


def chat_store_headers(pages: DataFrame) -> DataFrame:
    """The current row of each chat: model, title, first user message, number of messages, and both stamps.

    It needs no message: every page brings its own sums.
    """
    asked = F.when(F.col("first_turn").isNotNull(), F.col("page"))
    rows = pages.groupBy("chat_id").agg(
        F.min_by("model_nm", F.when(F.col("model_nm").isNotNull(), F.col("page"))).alias("model_nm"),
        F.min_by("first_message", asked).alias("first_message"),
        F.sum("n_messages").alias("n_messages"), F.min("created").alias("created"), F.max("updated").alias("updated"),
    )
    created = F.to_timestamp_ntz("created", F.lit(_STAMP))
    return rows.select(
        "chat_id", "model_nm", chat_title(F.coalesce("model_nm", F.lit("")), F.col("first_message"), created).alias("title"),
        "first_message", "n_messages", F.substring("created", 1, 19).alias("created_at"), F.substring("updated", 1, 19).alias("updated_at"),
    )
