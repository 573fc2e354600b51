"""Chats, models and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.operators import chats as ch
from gleaner.operators import models as md
from gleaner.operators.ordinals import join_hot
from gleaner.plans import chat as pc
from gleaner.streaming import jobs
from gleaner.session import scratch_path

from . import adapters as ad
from .filetasks import GATE, IMAGE_SQL, GATED_SQL
from .registry import query

CONFIGURED = ("OPENAI_API_KEY", "GOOGLE_API_KEY")


def _asked(spark, sf) -> DataFrame:
    """Every turn as a request; system turns stand for requests without a model."""
    model = F.when(F.col("role") != "system", ad.model_by(F.col("chat_id")))
    blank = F.when(F.length("content") > 60, F.col("content")).otherwise(F.lit("  "))
    return ad.messages(spark, sf).select("chat_id", "turn", blank.alias("message"), model.alias("model_nm"))


ASKED_SQL = f"""{ad.MESSAGES_SQL}, asked AS (SELECT chat_id, turn,
  CASE WHEN length(content) > 60 THEN content ELSE '  ' END AS message,
  CASE WHEN role <> 'system' THEN {ad.MODEL_LIST_SQL}[chat_id % 6 + 1] END AS model_nm FROM messages)"""


@query(
    "request_validation",
    f"""WITH {ASKED_SQL} SELECT chat_id, turn, CASE WHEN trim(message) = '' THEN 'Enter a message'
      WHEN model_nm IS NULL THEN 'Model must be selected. Please select a model.'
      WHEN contains(model_nm, 'claude') THEN 'Anthropic API key-ANTHROPIC_API_KEY not found in environment variables'
      END AS reason FROM asked""",
)
def request_validation(spark, sf):
    return _asked(spark, sf).select("chat_id", "turn", ch.invalid_request(CONFIGURED).alias("reason"))


@query("history_roles", f"WITH {ad.MESSAGES_SQL} SELECT * FROM messages WHERE role IN ('user', 'assistant')")
def history_roles(spark, sf):
    return ch.history_messages(ad.messages(spark, sf))


def _chats(spark, sf) -> DataFrame:
    return ch.build_chats(ad.chat_requests(spark, sf), ad.messages(spark, sf))


@query("chat_title", f"WITH {ad.CHATS_SQL} SELECT chat_id, title FROM chats")
def chat_title(spark, sf):
    return _chats(spark, sf).select("chat_id", "title")


@query("iso_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events")
def iso_timestamp(spark, sf):
    return ad.table(spark, sf, "events").select("event_id", tx.iso_seconds(F.col("ts")).alias("stamp"))


@query(
    "first_user_message",
    f"WITH {ad.MESSAGES_SQL} SELECT chat_id, arg_min(content, turn) AS first_message FROM messages WHERE role = 'user' GROUP BY chat_id",
)
def first_user_message(spark, sf):
    return ch.first_user_message(ad.messages(spark, sf))


HISTORY_SQL = f"""{ad.REQUESTS_SQL}, sent AS (
  SELECT chat_id, turn, role, content FROM messages WHERE role IN ('user', 'assistant')
  UNION ALL SELECT chat_id, -1, 'system', trim(system_message, {ad.SPACE_SQL}) FROM requests
  WHERE trim(coalesce(system_message, ''), {ad.SPACE_SQL}) <> ''),
placed AS (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY turn) - 1 AS position FROM sent)"""


@query(
    "chat_history",
    f"""WITH {HISTORY_SQL} SELECT chat_id, position // 3 AS page, CAST(to_json(list({{'role': role, 'content': content}}
    ORDER BY position)) AS VARCHAR) AS messages FROM placed GROUP BY ALL""",
)
def chat_history(spark, sf):
    """Pages of three messages, so that several pages per chat are seen here."""
    pages = ch.chat_history(ad.messages(spark, sf), ad.chat_requests(spark, sf), page_size=3)
    return pages.select("chat_id", "page", F.to_json("messages").alias("messages"))


@query("chat_messages", f"WITH {HISTORY_SQL} SELECT chat_id, position, role, content FROM placed")
def chat_messages(spark, sf):
    return ch.ordered_messages(ad.messages(spark, sf), ad.chat_requests(spark, sf))


@query(
    "chat_lookup",
    f"""WITH {ad.CHATS_SQL}, ids AS (SELECT DISTINCT user_id AS chat_id FROM events)
    SELECT ids.chat_id, title, model_nm, system_message, CASE WHEN model_nm IS NULL THEN
      'ERROR Exception: Chat not found. chat_id: ' || CAST(ids.chat_id AS VARCHAR) END AS error
    FROM ids LEFT JOIN chats USING (chat_id)""",
)
def chat_lookup(spark, sf):
    wanted = ad.table(spark, sf, "events").select(F.col("user_id").alias("chat_id")).distinct()
    return ch.lookup_chats(wanted, _chats(spark, sf)).select("chat_id", "title", "model_nm", "system_message", "error")


@query(
    "chat_delete",
    f"""WITH {ad.CHATS_SQL} SELECT chat_id, title FROM chats
    WHERE chat_id NOT IN (SELECT chat_id FROM messages WHERE role = 'system')""",
)
def chat_delete(spark, sf):
    """Drops the chats that have a system turn, and ids that do not exist."""
    gone = ad.messages(spark, sf).where("role = 'system'").select("chat_id")
    unknown = ad.table(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("chat_id"))
    return ch.delete_chats(_chats(spark, sf), gone.unionByName(unknown)).select("chat_id", "title")


@query("chats_latest_first", f"WITH {ad.CHATS_SQL} SELECT title, chat_id FROM chats ORDER BY chat_id DESC")
def chats_latest_first(spark, sf):
    return ch.latest_first(_chats(spark, sf))


@query(
    "next_chat_id",
    f"""WITH {ad.MESSAGES_SQL} SELECT page_id, (SELECT max(chat_id) FROM messages) + row_number() OVER (ORDER BY page_id)
    AS chat_id FROM pages""",
)
def next_chat_id(spark, sf):
    new = ad.table(spark, sf, "pages").select("page_id")
    return ch.with_new_ids(ad.messages(spark, sf), new, ["page_id"])


UPSERT_SQL = f"""{ad.CHATS_SQL}, updates AS (
  SELECT chat_id, 'other' AS model_nm, '' AS system_message, 'new title' AS title, '2025-01-01T00:00:00' AS created_at,
         '2025-01-02T03:04:05' AS updated_at
  FROM (SELECT DISTINCT chat_id FROM messages WHERE role = 'system'
        UNION ALL SELECT 1000000 + page_id FROM pages))"""


def _updates(spark, sf) -> DataFrame:
    known = ad.messages(spark, sf).where("role = 'system'").select("chat_id").distinct()
    new = ad.table(spark, sf, "pages").select((F.col("page_id") + 1_000_000).alias("chat_id"))
    fixed = {
        "model_nm": "other", "system_message": "", "title": "new title",
        "created_at": "2025-01-01T00:00:00", "updated_at": "2025-01-02T03:04:05",
    }
    return known.unionByName(new).withColumns({k: F.lit(v) for k, v in fixed.items()})


@query(
    "chat_upsert",
    f"""WITH {UPSERT_SQL}, headers AS (SELECT coalesce(c.chat_id, u.chat_id) AS chat_id, coalesce(c.model_nm, u.model_nm) AS model_nm,
      coalesce(c.system_message, u.system_message) AS system_message, coalesce(c.title, u.title) AS title,
      coalesce(c.created_at, u.created_at) AS created_at, coalesce(u.updated_at, c.updated_at) AS updated_at
    FROM chats c FULL JOIN updates u ON c.chat_id = u.chat_id), stored AS (
      SELECT chat_id, turn, role, content FROM messages WHERE chat_id NOT IN (SELECT chat_id FROM updates)
      UNION ALL SELECT chat_id, 0, 'user', 'asked again' FROM updates
      UNION ALL SELECT chat_id, 1, 'assistant', 'answered again' FROM updates)
    SELECT headers.*, turn, role, content FROM headers JOIN stored USING (chat_id)""",
)
def chat_upsert(spark, sf):
    """Headers after the upsert, with the messages that are stored then."""
    updates, messages = _updates(spark, sf), ad.messages(spark, sf)
    turns = F.array(
        F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("asked again").alias("content")),
        F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"), F.lit("answered again").alias("content")),
    )
    histories = updates.select("chat_id", F.inline(turns)).withColumn("turn", F.col("turn").cast(messages.schema["turn"].dataType))
    headers, stored = ch.upsert_chats(_chats(spark, sf), messages, updates, histories)
    return join_hot(stored, headers, ["chat_id"], ["turn"], how="inner")


@query(
    "history_append",
    f"""WITH {ad.MESSAGES_SQL}, last AS (SELECT chat_id, max(turn) AS t, any_value(CASE WHEN role = 'system' THEN 1 END) AS sys
      FROM messages GROUP BY chat_id), bad AS (SELECT DISTINCT chat_id FROM messages WHERE role = 'system')
    SELECT * FROM messages
    UNION ALL SELECT chat_id, t + 1, 'user', 'more' FROM last WHERE chat_id NOT IN (SELECT chat_id FROM bad)
    UNION ALL SELECT chat_id, t + 2, 'assistant', 'reply' FROM last WHERE chat_id NOT IN (SELECT chat_id FROM bad)""",
)
def history_append(spark, sf):
    """The calls of chats with a system turn fail."""
    msgs = ad.messages(spark, sf)
    answered = msgs.groupBy("chat_id").agg(
        F.lit("more").alias("message"), F.lit("reply").alias("response"),
        F.max(F.when(F.col("role") == "system", F.lit("timeout"))).alias("error"),
    )
    return pc.store_replies(msgs, answered)


@query(
    "chat_segments",
    """SELECT event_id, user_id, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER
      (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM events""",
)
def chat_segments(spark, sf):
    rows = ad.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    out = ch.chat_segments(rows, "user_id", ["ts", "event_id"], F.col("event_type") == "signup")
    return out.select("event_id", "user_id", "segment")


@query(
    "model_attributes",
    f"""WITH {ad.REQUESTS_SQL} SELECT chat_id, model_nm, CASE model_nm WHEN 'gpt-4o' THEN 1 WHEN 'gpt-4o-mini' THEN 2
      WHEN 'claude-sonnet-4-0' THEN 3 WHEN 'gemini-1.5-flash' THEN 5 WHEN 'llama3.2' THEN 6 ELSE 7 END::BIGINT AS model_id,
      CASE WHEN model_nm IN ('gpt-4o', 'claude-sonnet-4-0', 'gemini-1.5-flash') THEN 'Text, Code, PDF, Images'
      ELSE 'Text, Code, PDF(Images Ignored)' END AS supported_types FROM requests""",
)
def model_attributes(spark, sf):
    return md.with_model(ad.chat_requests(spark, sf)).select("chat_id", "model_nm", "model_id", "supported_types")


@query(
    "supports_attachments",
    f"WITH {ad.REQUESTS_SQL} SELECT chat_id, model_nm FROM requests WHERE model_nm NOT IN ('llama3.2', 'gemma3:1b')",
)
def supports_attachments(spark, sf):
    return md.supporting_attachments(ad.chat_requests(spark, sf)).select("chat_id", "model_nm")


@query(
    "provider_route",
    f"""WITH {ASKED_SQL} SELECT chat_id, turn, CASE WHEN contains(model_nm, 'gpt') THEN 'openai'
      WHEN contains(model_nm, 'claude') THEN 'anthropic' WHEN contains(model_nm, 'llama') OR contains(model_nm, 'gemma')
      THEN 'ollama' WHEN contains(model_nm, 'gemini') THEN 'google' END AS provider,
      CASE WHEN model_nm IS NULL THEN 'Model:  is not supported' END AS error FROM asked""",
)
def provider_route(spark, sf):
    return md.route(_asked(spark, sf)).select("chat_id", "turn", "provider", "error")


@query(
    "provider_registry",
    f"""WITH {ad.REQUESTS_SQL} SELECT chat_id, model_nm AS model, CASE model_nm WHEN 'gpt-4o-mini' THEN 'openai'
      WHEN 'gemini-1.5-flash' THEN 'google' WHEN 'llama3.2' THEN 'ollama' END AS provider,
      CASE WHEN model_nm NOT IN ('gpt-4o-mini', 'gemini-1.5-flash', 'llama3.2') THEN 'Unsupported model: ' || model_nm END
      AS error FROM requests""",
)
def provider_registry(spark, sf):
    good, bad = md.registered(ad.chat_requests(spark, sf).select("chat_id", F.col("model_nm").alias("model")))
    none = F.lit(None).cast("string")
    columns = ["chat_id", "model", "provider", "error"]
    return good.withColumn("error", none).select(columns).unionByName(bad.withColumn("provider", none).select(columns))


@query(
    "user_message_parts",
    f"""WITH {ad.REQUESTS_SQL} SELECT m.chat_id, turn, CASE WHEN model_nm NOT IN ('llama3.2', 'gemma3:1b') AND role = 'user'
      THEN 2 ELSE 1 END::BIGINT AS n_parts, content || CASE WHEN model_nm NOT IN ('llama3.2', 'gemma3:1b') AND role = 'user'
      THEN chr(10) || role ELSE '' END AS texts FROM messages m JOIN requests USING (chat_id)""",
)
def user_message_parts(spark, sf):
    """User turns carry one more part, made of the role."""
    none = F.lit(None).cast("string")
    extra = F.struct(
        F.lit("text").alias("type"), F.col("role").alias("text"), none.alias("source_type"),
        none.alias("mime_type"), none.alias("data"),
    )
    rows = ad.messages(spark, sf).withColumns(
        {"model_nm": ad.model_by(F.col("chat_id")), "extra": F.when(F.col("role") == "user", F.array(extra))}
    )
    parts = ch.user_message_parts(F.col("content"), F.col("extra"), F.col("supports_file_attachments"))
    return md.with_model(rows).select(
        "chat_id", "turn", F.size(parts).cast("bigint").alias("n_parts"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("texts"),
    )


@query(
    "strip_text",
    f"WITH {ad.MESSAGES_SQL} SELECT chat_id, turn, trim(content, {ad.SPACE_SQL}) AS content FROM messages",
)
def strip_text(spark, sf):
    padded = F.concat(F.lit("\n \t"), "content", F.lit(" \xa0\n"))
    return ad.messages(spark, sf).select("chat_id", "turn", tx.strip_text(padded).alias("content"))


@query(
    "response_text",
    f"""WITH {ad.MESSAGES_SQL} SELECT chat_id, turn, CASE WHEN role = 'assistant' THEN content
      WHEN role = 'user' THEN content || chr(10) || role END AS response,
      CASE WHEN role = 'system' THEN 'empty response' END AS error FROM messages""",
)
def response_text(spark, sf):
    """Assistant turns reply with plain text, user turns with blocks, system turns with nothing."""
    role, content = F.col("role"), F.col("content")

    def block(kind: str, text):
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))

    blocks = F.when(role == "user", F.array(block("text", content), block("tool", F.lit("x")), block("text", role)))
    reply = tx.response_text(F.when(role == "assistant", content), blocks)
    return ad.messages(spark, sf).select(
        "chat_id", "turn", reply.alias("response"), F.when(reply.isNull(), F.lit("empty response")).alias("error")
    )


def _chat_requests(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The last user turn of a chat is its request, the turns before it the history."""
    msgs = ad.messages(spark, sf)
    last = msgs.where("role = 'user'").groupBy("chat_id").agg(
        F.max("turn").alias("ask"), F.max_by("content", "turn").alias("message")
    )
    history = msgs.join(last.select("chat_id", "ask"), "chat_id").where("turn < ask").drop("ask")
    requests = ad.chat_requests(spark, sf).join(last, "chat_id").withColumn(
        "batch", F.concat(F.lit("src"), F.col("chat_id").cast("string"))
    )
    return requests.select("chat_id", "model_nm", "system_message", "message", "batch"), history


CHAT_REQUEST_SQL = f"""{IMAGE_SQL}, {GATED_SQL},
asked AS (SELECT chat_id, max(turn) AS ask, arg_max(content, turn) AS message FROM messages WHERE role = 'user' GROUP BY chat_id),
filed AS (SELECT *, CASE file_type WHEN 'text' THEN true WHEN 'pdf' THEN pdf WHEN 'image' THEN img ELSE false END AS ok
          FROM gated JOIN r USING (batch) WHERE att),
verdict AS (SELECT chat_id, count(*) FILTER (NOT accepted OR reason IS NOT NULL OR NOT ok) AS failed,
   any_value(CASE WHEN NOT accepted THEN 'FATAL ERROR: Total size ' || CAST(total_bytes AS VARCHAR)
        || ' exceeds max allowed {GATE}. Delete some files.' END) AS gate,
   string_agg(CASE WHEN accepted AND (reason IS NOT NULL OR NOT ok) THEN name END, chr(10) ORDER BY path) AS refused,
   string_agg(CASE WHEN accepted AND reason IS NULL AND ok THEN CASE WHEN file_type = 'text'
        THEN trim(text, {ad.SPACE_SQL}) ELSE to_base64(content) END END, chr(10) ORDER BY path) AS attached,
   count(*) AS n_files FROM filed GROUP BY chat_id),
judged AS (SELECT q.chat_id, q.model_nm, q.system_message, message, ask, attached, coalesce(n_files, 0) AS n_files,
   CASE WHEN contains(q.model_nm, 'claude') THEN 'Anthropic API key-ANTHROPIC_API_KEY not found in environment variables'
        WHEN gate IS NOT NULL THEN gate
        WHEN failed > 0 THEN 'Following files were not processed: ' || refused || '{pc.FILE_ADVICE}' END AS error,
   NOT contains(q.model_nm, 'claude') AND gate IS NULL AND failed > 0 AS by_file
   FROM requests q JOIN asked USING (chat_id) LEFT JOIN verdict USING (chat_id)),
sent AS (
  SELECT m.chat_id, turn, role, content, NULL AS attached, NULL AS n_parts FROM messages m JOIN judged j USING (chat_id)
  WHERE role IN ('user', 'assistant') AND turn < ask AND error IS NULL
  UNION ALL SELECT chat_id, -1, 'system', trim(system_message, {ad.SPACE_SQL}), NULL, NULL FROM judged
  WHERE trim(coalesce(system_message, ''), {ad.SPACE_SQL}) <> '' AND error IS NULL
  UNION ALL SELECT chat_id, ask, 'user', message, attached, 1 + n_files FROM judged WHERE error IS NULL)
SELECT chat_id, row_number() OVER (PARTITION BY chat_id ORDER BY turn) - 1 AS position, role, content,
   md5(attached) AS attached_md5, n_parts, CAST(NULL AS VARCHAR) AS error FROM sent
UNION ALL SELECT chat_id, CASE WHEN by_file THEN 0 END, NULL, NULL, NULL, NULL, error FROM judged WHERE error IS NOT NULL"""


@query("chat_request", f"{CHAT_REQUEST_SQL}")
def chat_request(spark, sf):
    requests, history = _chat_requests(spark, sf)
    rows = pc.chat_request(requests, history, ad.files(spark, sf), "batch", CONFIGURED, GATE)
    files = F.filter("parts", lambda p, i: i > 0)
    texts = F.transform(files, lambda p: F.coalesce(p["text"], p["data"]))
    joined = F.when(F.size("parts") > 1, F.array_join(texts, "\n"))
    return rows.select(
        "chat_id", "position", "role", "content", F.md5(joined.cast("binary")).alias("attached_md5"),
        F.when(F.col("parts").isNotNull(), F.size("parts")).cast("bigint").alias("n_parts"), "error",
    )


@query(
    "stream_chat_store",
    f"""WITH {ad.MESSAGES_SQL}, ok AS (SELECT * FROM messages WHERE role <> 'system'),
    rows AS (SELECT chat_id, arg_min(content, turn) FILTER (role = 'user') AS first_message, count(*) AS n_messages,
      TIMESTAMP '2024-01-01 00:00:00' + min(turn) * INTERVAL 1 MINUTE AS created,
      TIMESTAMP '2024-01-01 00:00:00' + max(turn) * INTERVAL 1 MINUTE AS updated FROM ok GROUP BY chat_id),
    pages AS (SELECT chat_id, turn // 2 AS page, CAST(to_json(list({{'role': role, 'content': content}} ORDER BY turn)) AS VARCHAR)
      AS messages FROM ok GROUP BY ALL)
    SELECT chat_id, 'other' AS model_nm, CASE WHEN trim(coalesce(first_message, ''), {ad.SPACE_SQL}) = ''
      THEN 'Chat - ' || strftime(created, '%H:%M')
      ELSE 'other-' || left(first_message, 40) || CASE WHEN length(first_message) > 35 THEN '...' ELSE '' END END AS title,
      first_message, n_messages, strftime(created, '%Y-%m-%dT%H:%M:%S') AS created_at, strftime(updated, '%Y-%m-%dT%H:%M:%S')
      AS updated_at, page, messages FROM rows JOIN pages USING (chat_id)""",
)
def stream_chat_store(spark, sf):
    """Current rows with their histories, in pages of two turn numbers. System turns stand for failed calls."""
    source = ad.stream(spark, sf, "conversations")
    minute = F.make_dt_interval(mins=F.col("turn").cast("int"))
    turns = source.select(
        F.col("conv_id").alias("chat_id"), "turn", "role", F.col("text").alias("content"), F.lit("other").alias("model_nm"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minute).alias("ts"),
        F.when(F.col("role") == "system", F.lit("failed")).alias("error"),
    )
    target = scratch_path(spark, "chat-store")
    jobs.stream_chat_store(turns, target, scratch_path(spark, "stream"), page_turns=2).awaitTermination()
    pages = jobs.chat_pages(spark.read.parquet(target))
    sent = F.to_json(F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))))
    return jobs.chat_store_headers(pages).join(pages.select("chat_id", "page", sent.alias("messages")), "chat_id")
