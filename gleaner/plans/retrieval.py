"""Retrieval jobs: corpus and questions to prompts, for all questions in one run.

``samples`` has the corpus shape of ``operators.passages``; ``questions`` has
``query_id, question``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashed import densify, fold, hashed_counts, unit_length
from ..functions.text import truncate_ellipsis
from ..functions.vectors import cast_float32
from ..operators import context, passages, prompts
from ..operators.embedding import embed
from ..operators.nearest import attach_documents, top_k
from ..session import JobConfig, materialise, scratch_path
from ..operators.ordinals import with_late_position
from ..sources.collection import Collection
from ..sources.corpus import ingest_limit


def embed_questions(questions: DataFrame, cfg: JobConfig) -> DataFrame:
    return embed(questions, "question", cfg.embedding_model)


def search(rows: DataFrame, questions: DataFrame, cfg: JobConfig) -> DataFrame:
    """Hits ``query_id, rank, id, distance, document`` for rows that have vectors."""
    asked = embed_questions(questions, cfg)
    hits = top_k(rows, asked, cfg.top_k, cfg.embed_width, cfg.metric)
    return attach_documents(hits, rows, questions, cfg.top_k, "document")


def search_by_model(passages_: DataFrame, questions: DataFrame, models: tuple[str, ...], k: int) -> DataFrame:
    """Hits of the same questions under each hashed model, with a ``model`` column."""
    out = None
    for model in models:
        width = int(model.removeprefix("hash-"))
        rows, asked = embed(passages_, "document", model), embed(questions, "question", model)
        hits = top_k(rows, asked, k, width).withColumn("model", F.lit(model))
        out = hits if out is None else out.unionByName(hits)
    return out


def _prompted(contexts: DataFrame, questions: DataFrame, prompt) -> DataFrame:
    """A prompt for every question; the context of one without hits is empty."""
    joined = questions.join(contexts, "query_id", "left").withColumn("context", F.coalesce("context", F.lit("")))
    return joined.select("query_id", prompt(F.col("context"), F.col("question")).alias("prompt"))


def passage_rows(samples: DataFrame, cfg: JobConfig, unnest) -> DataFrame:
    limited = ingest_limit(samples, cfg.ingest_limit, ["id"])
    return embed(unnest(limited), "document", cfg.embedding_model)


def stored_passages(samples: DataFrame, cfg: JobConfig, unnest) -> DataFrame:
    """Passages written once with their metadata and vectors, so that the model sees each only once."""
    rows = passage_rows(samples, cfg, unnest)
    store = Collection(scratch_path(samples.sparkSession, "collection"), cfg.metric, cfg.embedding_model, cfg.embed_width)
    store.replace(rows)
    return store.read(samples.sparkSession)


def rag_base(samples: DataFrame, questions: DataFrame, cfg: JobConfig) -> DataFrame:
    rows = stored_passages(samples, cfg, passages.passages_base)
    ctx = context.context_scored(search(rows, questions, cfg))
    cap = cfg.max_context_chars
    return _prompted(
        ctx.withColumn("context", truncate_ellipsis(F.col("context"), cap)), questions, prompts.prompt_base
    )


def rag_gpt5(samples: DataFrame, questions: DataFrame, cfg: JobConfig) -> DataFrame:
    rows = stored_passages(samples, cfg, passages.passages_ctx)
    ctx = context.context_plain(search(rows, questions, cfg))
    return _prompted(ctx, questions, lambda c, q: prompts.prompt_gpt5(c, q, cfg.max_context_chars))


def rag_sonnet(samples: DataFrame, questions: DataFrame, cfg: JobConfig) -> DataFrame:
    rows = stored_passages(samples, cfg, passages.sample_document)
    ctx = context.context_numbered(search(rows, questions, cfg), questions)
    return _prompted(ctx, questions, prompts.prompt_sonnet)


def rag_gemini(
    samples: DataFrame, questions: DataFrame, cfg: JobConfig, store: Collection, source: str = "hotpot_qa", split: str = "train"
) -> DataFrame:
    """One document a sample, kept in ``store`` with the origin as metadata; a filled store is left as it is."""
    store.check(cfg.embedding_model, cfg.metric, cfg.embed_width)
    rows = passage_rows(samples, cfg, passages.sample_document_list_text)
    origin = passages.metadata_source(source, split)
    store.fill_if_empty(rows.select("id", "document", "vector", origin.alias("metadata")))
    ctx = context.context_plain(search(store.read(samples.sparkSession), questions, cfg))
    return _prompted(ctx, questions, prompts.prompt_gemini)


def _unit_vectors(df: DataFrame, text: str, widths: tuple[int, ...], label: str) -> DataFrame:
    """Dense unit vectors in single precision, as flat indexes store them, one column ``v<width>`` a width.

    Each text is hashed once, to the widest; a width that divides it is folded from it. The table is written,
    so that no search hashes again. A text without tokens keeps a NULL vector, which is never a hit.
    """
    widest = max(widths)
    rows = embed(df, text, f"hash-{widest}").withColumn("vector", densify(F.col("vector"), widest))
    other = [w for w in widths if widest % w]
    for w in other:
        rows = rows.withColumn(f"v{w}", densify(hashed_counts(F.col(text), w), w))
    folded = {f"v{w}": fold(F.col("vector"), widest, w) for w in widths if w not in other}
    units = {f"v{w}": cast_float32(unit_length(F.col(f"v{w}"))) for w in widths}
    return materialise(rows.withColumns(folded).withColumns(units).drop("vector"), label)


def rag_flat(texts: DataFrame, questions: DataFrame, widths: tuple[int, ...], k: int = 3) -> DataFrame:
    """The same questions against one flat index per embedding width.

    ``texts`` has ``key, text``, the key unique; positions are given once, in key order, and shared
    by the indexes; a hit's text comes back by position.
    """
    out = None
    placed = with_late_position(texts, ["key"], "id").withColumnRenamed("text", "document")
    all_rows = _unit_vectors(placed, "document", widths, "flat-rows")
    all_asked = _unit_vectors(questions, "question", widths, "flat-questions")
    for width in widths:
        corpus = all_rows.select("id", "document", F.col(f"v{width}").alias("vector"))
        asked = all_asked.select("query_id", F.col(f"v{width}").alias("vector"))
        hits = top_k(corpus, asked, k, width, "l2")
        ctx = context.context_plain(attach_documents(hits, corpus, questions, k, "document"))
        one = _prompted(ctx, questions, prompts.prompt_flat).withColumn("model", F.lit(f"hash-{width}"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("system", F.lit(prompts.SYSTEM_FLAT))
