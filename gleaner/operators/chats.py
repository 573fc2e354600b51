"""Chats as two tables: one header row per chat, one row per message.

``chats``: ``chat_id, model_nm, system_message, title, created_at, updated_at``.
``messages``: ``chat_id, turn, role, content``. A chat of any length stays a set
of rows; arrays of messages come in pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_seconds, present, strip_text
from .models import PROVIDERS, provider_of
from .ordinals import PAGE_BYTES, join_hot, paged_lists, with_ordinal, with_running_sum

# Fixed value: characters of the first message kept in a title.
TITLE_LENGTH = 40


def invalid_request(configured: tuple[str, ...]) -> Column:
    """First reason to reject a request; ``configured`` names the providers with a key."""
    message, model = F.col("message"), F.col("model_nm")
    reason = F.when(F.coalesce(strip_text(message), F.lit("")) == "", F.lit("Enter a message"))
    reason = reason.when(
        present(model).isNull(), F.lit("Model must be selected. Please select a model.")
    )
    for word, _, key, label in PROVIDERS:
        if key and key not in configured:
            text = f"{label} API key-{key} not found in environment variables"
            reason = reason.when(F.contains(F.lower(model), F.lit(word)), F.lit(text))
    return reason.when(
        provider_of(model).isNull(), F.concat(F.lit("Model: "), model, F.lit(" is not supported"))
    )


def history_messages(messages: DataFrame) -> DataFrame:
    """Only user and assistant turns enter a history."""
    return messages.where(F.col("role").isin("user", "assistant"))


def _with_system(messages: DataFrame, chats: DataFrame) -> DataFrame:
    """History rows plus, for a chat with a non-blank system message, a first row."""
    system = (
        chats.select("chat_id", strip_text(F.col("system_message")).alias("content"))
        .where("content <> ''")
        .select("chat_id", F.lit(-1).cast("bigint").alias("turn"), F.lit("system").alias("role"), "content")
    )
    return history_messages(messages).select("chat_id", "turn", "role", "content").unionByName(system)


def ordered_messages(messages: DataFrame, chats: DataFrame) -> DataFrame:
    """``chat_id, position, role, content``: the messages sent to a model, in order."""
    rows = with_ordinal(_with_system(messages, chats), ["turn"], ["chat_id"], "position")
    return rows.select("chat_id", "position", "role", "content")


def chat_history(messages: DataFrame, chats: DataFrame, page_size: int = 1000, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """``chat_id, page, messages ARRAY<STRUCT<role, content>>``; see ``paged_lists``."""
    value, size = F.struct("role", "content"), F.octet_length("content")
    rows = _with_system(messages, chats)
    return paged_lists(rows, ["chat_id"], ["turn"], value, "messages", page_size, size=size, page_bytes=page_bytes)


def first_user_message(messages: DataFrame) -> DataFrame:
    users = messages.where(F.col("role") == "user")
    return users.groupBy("chat_id").agg(F.min_by("content", "turn").alias("first_message"))


def chat_title(model: Column, first_message: Column, created: Column) -> Column:
    """Model and start of the first message.

    The dots appear when the message exceeds the title length less the model name,
    although the full title length of it is kept.
    """
    dots = F.when(F.length(first_message) > F.lit(TITLE_LENGTH) - F.length(model), F.lit("...")).otherwise("")
    named = F.concat(model, F.lit("-"), F.left(first_message, F.lit(TITLE_LENGTH)), dots)
    return F.when(present(first_message).isNotNull(), named).otherwise(
        F.concat(F.lit("Chat - "), F.date_format(created, "HH:mm"))
    )


def build_chats(requests: DataFrame, messages: DataFrame) -> DataFrame:
    """Header rows from ``chat_id, model_nm, system_message, created`` and the messages."""
    titled = requests.join(first_user_message(messages), "chat_id", "left")
    stamp = iso_seconds(F.col("created"))
    return titled.select(
        "chat_id", "model_nm", F.coalesce("system_message", F.lit("")).alias("system_message"),
        chat_title(F.col("model_nm"), F.col("first_message"), F.col("created")).alias("title"),
        stamp.alias("created_at"), stamp.alias("updated_at"),
    )


def with_new_ids(chats: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """Give each new chat the next free id, in ``order``; ids start at 1."""
    top = chats.agg(F.coalesce(F.max("chat_id"), F.lit(0))).first()[0]
    return with_ordinal(new, order, (), "chat_id", start=int(top) + 1)


def upsert_headers(chats: DataFrame, updates: DataFrame) -> DataFrame:
    """New chats are added; a known chat changes only ``updated_at``."""
    kept = ["model_nm", "system_message", "title", "created_at"]
    c, u = chats.alias("c"), updates.alias("u")
    joined = c.join(u, F.col("c.chat_id") == F.col("u.chat_id"), "full_outer")
    known = F.col("c.chat_id").isNotNull()
    return joined.select(
        F.coalesce("c.chat_id", "u.chat_id").alias("chat_id"),
        *[F.when(known, F.col(f"c.{n}")).otherwise(F.col(f"u.{n}")).alias(n) for n in kept],
        F.coalesce("u.updated_at", "c.updated_at").alias("updated_at"),
    )


def replace_messages(messages: DataFrame, updates: DataFrame) -> DataFrame:
    """The full new histories take the place of the old ones of the same chats. A long chat is spread."""
    changed = updates.select("chat_id").distinct().withColumn("__changed", F.lit(True))
    spread = [c for c in messages.columns if c != "chat_id"]
    kept = join_hot(messages, changed, ["chat_id"], spread).where("__changed IS NULL")
    return kept.select(messages.columns).unionByName(updates.select(messages.columns))


def upsert_chats(
    chats: DataFrame, messages: DataFrame, updates: DataFrame, histories: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Headers and messages after saving ``updates`` with their full ``histories``."""
    return upsert_headers(chats, updates), replace_messages(messages, histories)


def append_turns(messages: DataFrame, turns: DataFrame) -> DataFrame:
    """History plus the new turns; turns of failed calls are not kept."""
    ok = turns.where("error IS NULL").select(messages.columns)
    return messages.unionByName(ok)


def lookup_chats(requests: DataFrame, chats: DataFrame) -> DataFrame:
    """Requested chats; an unknown id gives an error row."""
    found = requests.join(chats, "chat_id", "left")
    missing = F.concat(
        F.lit("ERROR Exception: Chat not found. chat_id: "), F.coalesce(F.col("chat_id").cast("string"), F.lit(""))
    )
    return found.withColumn("error", F.when(F.col("model_nm").isNull(), missing))


def delete_chats(chats: DataFrame, ids: DataFrame) -> DataFrame:
    """Unknown ids are ignored."""
    return chats.join(ids.select("chat_id"), "chat_id", "left_anti")


def latest_first(chats: DataFrame) -> DataFrame:
    return chats.select("title", "chat_id").orderBy(F.desc("chat_id"))


def chat_segments(events: DataFrame, user: str, order: list[str], reset: Column) -> DataFrame:
    """Number the chats of a user: each reset event starts a new one."""
    flagged = events.withColumn("__reset", F.when(reset, 1).otherwise(0).cast("bigint"))
    return with_running_sum(flagged, "__reset", order, [user], "segment").drop("__reset")


def user_message_parts(message: Column, parts: Column, supports: Column) -> Column:
    """Text part first, then file parts when the model takes attachments."""
    none = F.lit(None).cast("string")
    text = F.struct(
        F.lit("text").alias("type"), message.alias("text"), none.alias("source_type"),
        none.alias("mime_type"), none.alias("data"),
    )
    return F.when(supports & parts.isNotNull(), F.concat(F.array(text), parts)).otherwise(F.array(text))
