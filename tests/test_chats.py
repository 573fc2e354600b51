import pytest
from pyspark.sql import functions as F

from gleaner.operators import chats as ch
from gleaner.operators import models as md
from gleaner.plans import chat as pc

MSG = "chat_id BIGINT, turn BIGINT, role STRING, content STRING"


def requests(spark, rows):
    df = spark.createDataFrame(rows, "chat_id BIGINT, model_nm STRING, system_message STRING, at STRING")
    return df.withColumn("created", F.col("at").cast("timestamp_ntz")).drop("at")


@pytest.mark.parametrize("n", [0, 33, 34, 35, 39, 40, 41])
def test_title(spark, n):
    text = "m" * n
    req = requests(spark, [(1, "gpt-4o", None, "2024-05-06 07:08:09")])
    msgs = spark.createDataFrame([(1, 2, "user", text), (1, 3, "user", "later"), (1, 0, "assistant", "hi")], MSG)
    title = ch.build_chats(req, msgs).first().title
    if n == 0:
        assert title == "Chat - 07:08"
    else:
        assert title == "gpt-4o-" + text[:40] + ("..." if n > 40 - 6 else "")


def test_history(spark):
    req = requests(spark, [(1, "m", "  be kind \n", "2024-01-01 00:00:00"), (2, "m", "  ", "2024-01-01 00:00:00")])
    msgs = spark.createDataFrame(
        [(1, 9, "assistant", "c"), (1, 1, "user", "a"), (1, 5, "tool", "x"), (1, 4, "user", "b"), (2, 0, "user", "z")], MSG
    )
    rows = ch.ordered_messages(msgs, req).orderBy("chat_id", "position").collect()
    assert [tuple(r) for r in rows] == [
        (1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (2, 0, "user", "z"),
    ]
    pages = ch.chat_history(msgs, req, page_size=3).where("chat_id = 1").orderBy("page").collect()
    assert [[m.content for m in p.messages] for p in pages] == [["be kind", "a", "b"], ["c"]]


def test_upsert_is_idempotent_and_keeps_title(spark):
    schema = "chat_id BIGINT, model_nm STRING, system_message STRING, title STRING, created_at STRING, updated_at STRING"
    old = spark.createDataFrame([(1, "m", "s", "t", "c", "u"), (2, "m", "s", "t2", "c", "u")], schema)
    new = spark.createDataFrame([(1, "x", "x", "x", "x", "u9"), (3, "n", "", "t3", "c3", "u3")], schema)
    once = ch.upsert_headers(old, new)
    want = [(1, "m", "s", "t", "c", "u9"), (2, "m", "s", "t2", "c", "u"), (3, "n", "", "t3", "c3", "u3")]
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in ch.upsert_headers(once, new).collect()) == want
    a = spark.createDataFrame([(1, 0, "user", "old"), (2, 0, "user", "keep")], MSG)
    b = spark.createDataFrame([(1, 0, "user", "new"), (1, 1, "assistant", "r")], MSG)
    got = sorted((r.chat_id, r.content) for r in ch.replace_messages(a, b).collect())
    assert got == [(1, "new"), (1, "r"), (2, "keep")]


def test_new_ids_lookup_delete(spark):
    chats = spark.createDataFrame([(4, "m", "s", "t", "c", "u")],
        "chat_id BIGINT, model_nm STRING, system_message STRING, title STRING, created_at STRING, updated_at STRING")
    new = spark.createDataFrame([("b",), ("a",)], "name STRING")
    got = sorted((r.name, r.chat_id) for r in ch.with_new_ids(chats, new, ["name"]).collect())
    assert got == [("a", 5), ("b", 6)]
    first = ch.with_new_ids(chats.limit(0), new, ["name"])
    assert sorted(r.chat_id for r in first.collect()) == [1, 2]
    asked = spark.createDataFrame([(4,), (7,)], "chat_id BIGINT")
    found = {r.chat_id: r.error for r in ch.lookup_chats(asked, chats).collect()}
    assert found[4] is None and "7" in found[7]
    assert ch.delete_chats(chats, asked).count() == 0
    assert ch.delete_chats(chats, asked.where("chat_id = 7")).count() == 1


def test_failed_turns_are_not_kept(spark):
    msgs = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], MSG)
    answered = spark.createDataFrame(
        [(1, "q", "r", None), (2, "q2", None, "timeout"), (3, "q3", "r3", None)],
        "chat_id BIGINT, message STRING, response STRING, error STRING",
    )
    got = sorted(tuple(r) for r in pc.store_replies(msgs, answered).collect())
    assert got == [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "q"), (1, 3, "assistant", "r"),
        (3, 0, "user", "q3"), (3, 1, "assistant", "r3"),
    ]


def test_segments(spark):
    events = [(u, t, "new" if t % 4 == 0 else "msg") for u in (1, 2) for t in range(1, 12)]
    df = spark.createDataFrame(events, "u INT, t INT, kind STRING")
    got = {(r.u, r.t): r.segment for r in ch.chat_segments(df, "u", ["t"], F.col("kind") == "new").collect()}
    assert got == {(u, t): t // 4 for u, t, _ in events}


def test_request_rules_and_routes(spark):
    rows = [
        (" ", "gpt-4o"), (None, "gpt-4o"), ("q", None), ("q", ""), ("q", "gpt-4o"), ("q", "claude-sonnet-4-0"),
        ("q", "GEMINI-1.5"), ("q", "llama3.2"), ("q", "gemma3:1b"), ("q", "other"),
    ]
    df = spark.createDataFrame(rows, "message STRING, model_nm STRING")
    got = [r.v for r in df.select(ch.invalid_request(("OPENAI_API_KEY",)).alias("v")).collect()]
    assert got[:5] == ["Enter a message"] * 2 + ["Model must be selected. Please select a model."] * 2 + [None]
    assert got[5].startswith("Anthropic API key-") and got[6].startswith("Google API key-")
    assert got[7:9] == [None, None] and got[9] == "Model: other is not supported"
    routed = [(r.provider, r.error) for r in md.route(df).collect()]
    assert [p for p, _ in routed[4:9]] == ["openai", "anthropic", None, "ollama", "ollama"]
    good, bad = md.registered(spark.createDataFrame([("llama3.2",), ("nope",)], "model STRING"))
    assert [r.provider for r in good.collect()] == ["ollama"]
    assert [r.error for r in bad.collect()] == ["Unsupported model: nope"]
