"""A batch of chat requests: validate, route, take in files, build messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chats
from ..operators import files as fl
from ..operators.models import route, with_model
from ..operators.ordinals import paged_text
from ..session import materialise
from .intake import file_intake


# Fixed value: what a requester should check when files were refused.
REFUSED = "files refused"
FILE_ADVICE = (
    ". Please check the following: 1) File contents and file extensions match 2) Total size of files uploaded is "
    "less then 20MB 3) That the files exist. Resubmit once corrected"
)


def _file_verdicts(taken: DataFrame) -> DataFrame:
    """``chat_id, parts, gate, failed`` per request with files.

    The size gate bounds what a request may carry, so its parts fit one row.
    """
    accepted = F.col("accepted")
    ok = accepted & F.col("part").isNotNull()
    return taken.groupBy("chat_id").agg(
        F.transform(
            F.sort_array(F.collect_list(F.when(ok, F.struct("path", "part")))), lambda e: e["part"]
        ).alias("parts"),
        F.max(F.when(~accepted, F.col("error"))).alias("gate"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def _refused_files(taken: DataFrame) -> DataFrame:
    """``chat_id, position, file_error``: names of refused files, 1000 per row."""
    refused = taken.where(F.col("accepted") & F.col("error").isNotNull()).select("chat_id", "path", "name")
    pages = paged_text(refused, ["chat_id"], ["path"], F.col("name"), "names")
    text = F.concat(F.lit("Following files were not processed: "), "names", F.lit(FILE_ADVICE))
    return pages.select("chat_id", F.col("page").alias("position"), text.alias("file_error"))


def chat_request(
    requests: DataFrame,
    history: DataFrame,
    files: DataFrame,
    batch: str,
    configured: tuple[str, ...],
    cap: int = fl.MAX_BATCH_BYTES,
) -> DataFrame:
    """Messages to send per valid request, or its error.

    ``requests``: ``chat_id, model_nm, system_message, message`` and ``batch``.
    Output: ``chat_id, position, role, content, parts, provider, error``. A model
    without attachments ignores the files. A very long list of refused files takes
    several error rows.
    """
    checked = route(requests.withColumn("reason", chats.invalid_request(configured)))
    taken = file_intake(files, checked.select(batch, "chat_id", "model_nm"), batch, cap)
    taken = materialise(taken.select("chat_id", "path", "name", "accepted", "error", "part"), "taken-files")
    judged = with_model(checked.join(_file_verdicts(taken), "chat_id", "left")).withColumn(
        "error", F.coalesce("reason", "error", "gate", F.when(F.col("failed") > 0, F.lit(REFUSED)))
    )
    judged = materialise(judged, "judged-requests")
    good, bad = judged.where("error IS NULL"), judged.where("error IS NOT NULL")

    past = history.join(good.select("chat_id"), "chat_id", "left_semi")
    sent = chats.ordered_messages(past, good)
    last = sent.groupBy("chat_id").agg(F.count(F.lit(1)).alias("n"))
    parts = chats.user_message_parts(F.col("message"), F.col("parts"), F.col("supports_file_attachments"))
    asked = good.join(last, "chat_id", "left").select(
        "chat_id", F.coalesce("n", F.lit(0)).alias("position"), F.lit("user").alias("role"),
        F.col("message").alias("content"), parts.alias("parts"),
    )
    rows = sent.withColumn("parts", F.lit(None).cast(f"array<{fl.PART}>")).unionByName(asked)
    out = rows.join(good.select("chat_id", "provider"), "chat_id").withColumn("error", F.lit(None).cast("string"))
    none = {c: F.lit(None).cast(out.schema[c].dataType) for c in ("role", "content", "parts")}
    named = bad.where(F.col("error") == REFUSED).join(_refused_files(taken), "chat_id")
    failed = (
        bad.where(F.col("error") != REFUSED)
        .select("chat_id", F.lit(None).cast("bigint").alias("position"), "provider", "error")
        .unionByName(named.select("chat_id", "position", "provider", F.col("file_error").alias("error")))
    )
    return out.unionByName(failed.withColumns(none))


def store_replies(messages: DataFrame, answered: DataFrame) -> DataFrame:
    """Histories after a batch of calls.

    ``answered``: ``chat_id, message, response, error``. A successful call adds a
    user and an assistant turn, a failed one nothing.
    """
    last = messages.groupBy("chat_id").agg(F.max("turn").alias("last"))
    known = answered.join(last, "chat_id", "left").withColumn("last", F.coalesce("last", F.lit(-1)))
    pair = F.array(
        F.struct((F.col("last") + 1).alias("turn"), F.lit("user").alias("role"), F.col("message").alias("content")),
        F.struct((F.col("last") + 2).alias("turn"), F.lit("assistant").alias("role"), F.col("response").alias("content")),
    )
    turns = known.select("chat_id", "error", F.inline(pair))
    return chats.append_turns(messages, turns)
