"""Vector functions, nearest neighbours, retrieval jobs and plugged-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import hashed as hs
from gleaner.functions import text as tx
from gleaner.functions import vectors as vc
from gleaner.operators import ann, context, embedding, nearest
from gleaner.operators import passages as ps
from gleaner.operators import prompts as pr
from gleaner.plans import retrieval as rt
from gleaner.session import JobConfig, scratch_path
from gleaner.sources.collection import Collection, flat_index
from gleaner.streaming import jobs

from . import adapters as ad
from .registry import query
from .webtasks import quoted

WIDTH = 64


def _pairs(spark, sf) -> DataFrame:
    """Each vector beside the one with the next id."""
    v = ad.vectors(spark, sf)
    after = v.select((F.col("id") - 1).alias("id"), F.col("vector").alias("other"))
    return v.join(after, "id")


PAIRS_SQL = """pairs AS (SELECT a.vec_id AS id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""
COSINE_SQL = "1.0 - list_inner_product({x}, {y}) / sqrt(list_inner_product({x}, {x}) * list_inner_product({y}, {y}))"


@query("cosine_distance", f"WITH {PAIRS_SQL} SELECT id, round({COSINE_SQL.format(x='x', y='y')}, 6) AS distance FROM pairs")
def cosine_distance(spark, sf):
    d = vc.cosine_distance(F.col("vector"), F.col("other"))
    return _pairs(spark, sf).select("id", F.round(d, 6).alias("distance"))


@query("l2_squared", f"WITH {PAIRS_SQL} SELECT id, round(pow(list_distance(x, y), 2), 6) AS distance FROM pairs")
def l2_squared(spark, sf):
    d = vc.l2_squared(F.col("vector"), F.col("other"))
    return _pairs(spark, sf).select("id", F.round(d, 6).alias("distance"))


@query("similarity", f"WITH {PAIRS_SQL} SELECT id, round(1.0 - ({COSINE_SQL.format(x='x', y='y')}), 6) AS similarity FROM pairs")
def similarity(spark, sf):
    d = vc.cosine_distance(F.col("vector"), F.col("other"))
    return _pairs(spark, sf).select("id", F.round(vc.similarity(d), 6).alias("similarity"))


def _long(df: DataFrame) -> DataFrame:
    rows = df.select("id", F.posexplode("vector").alias("pos", "x"))
    return rows.select("id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x"))


LONG_SQL = """SELECT id, generate_subscripts(vector, 1) - 1 AS pos, round(CAST(unnest(vector) AS DOUBLE), 6) AS x FROM v"""


@query("limit_dimensions", f"WITH v AS (SELECT vec_id AS id, embedding[1:16] AS vector FROM embeddings) {LONG_SQL}")
def limit_dimensions(spark, sf):
    v = ad.vectors(spark, sf)
    return _long(v.withColumn("vector", vc.limit_dimensions(F.col("vector"), 16)))


@query(
    "normalize_vector",
    f"""WITH s AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS w FROM embeddings),
    v AS (SELECT id, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w))) AS vector FROM s) {LONG_SQL}""",
)
def normalize_vector(spark, sf):
    return _long(ad.vectors(spark, sf).withColumn("vector", vc.normalize(F.col("vector"))))


@query(
    "check_dimension",
    "SELECT vec_id AS id, len(embedding) = 64 AS fits_64, len(embedding) = 32 AS fits_32 FROM embeddings",
)
def check_dimension(spark, sf):
    v = F.col("vector")
    return ad.vectors(spark, sf).select(
        "id", vc.fits_width(v, 64).alias("fits_64"), vc.fits_width(v, 32).alias("fits_32")
    )


@query(
    "cast_float32",
    """WITH v AS (SELECT vec_id AS id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(x / 3 AS FLOAT)) AS vector
    FROM embeddings) SELECT id, generate_subscripts(vector, 1) - 1 AS pos, CAST(unnest(vector) AS DOUBLE) AS x FROM v""",
)
def cast_float32(spark, sf):
    third = F.transform(F.col("vector").cast("array<double>"), lambda x: x / 3.0)
    rows = ad.vectors(spark, sf).select("id", F.posexplode(vc.cast_float32(third)).alias("pos", "x"))
    return rows.select("id", F.col("pos").cast("bigint").alias("pos"), F.col("x").cast("double").alias("x"))


# Nearest neighbours

COSINE_HITS_SQL = f"""WITH {ad.CENTRES_SQL}, d AS (SELECT query_id, id, {COSINE_SQL.format(x='q.vector', y='v.vector')}
  AS distance FROM q, v), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)"""
L2_HITS_SQL = f"""WITH {ad.CENTRES_SQL}, d AS (SELECT query_id, id, pow(list_distance(q.vector, v.vector), 2) AS distance
  FROM q, v), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)"""


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id", F.round("distance", 6).alias("distance")
    )


@query("topk_cosine", f"{COSINE_HITS_SQL} SELECT query_id, rank, id, round(distance, 6) AS distance FROM r WHERE rank <= 5")
def topk_cosine(spark, sf):
    return _rounded(nearest.top_k(ad.vectors(spark, sf), ad.label_centres(spark, sf), 5, WIDTH))


@query("topk_l2", f"{L2_HITS_SQL} SELECT query_id, rank, id, round(distance, 6) AS distance FROM r WHERE rank <= 3")
def topk_l2(spark, sf):
    return _rounded(nearest.top_k(ad.vectors(spark, sf), ad.label_centres(spark, sf), 3, WIDTH, "l2"))


@query("knn_cross", f"{COSINE_HITS_SQL} SELECT query_id, rank, id, round(distance, 6) AS distance FROM r WHERE rank <= 10")
def knn_cross(spark, sf):
    """The way taken when the questions outgrow a broadcast: blocks of them, one after the other."""
    return _rounded(
        nearest.top_k(ad.vectors(spark, sf), ad.label_centres(spark, sf), 10, WIDTH, max_broadcast_rows=4)
    )


@query(
    "hit_rank",
    f"{COSINE_HITS_SQL} SELECT query_id, id, rank, round(1.0 - distance, 6) AS similarity FROM r WHERE rank <= 5",
)
def hit_rank(spark, sf):
    hits = nearest.top_k(ad.vectors(spark, sf), ad.label_centres(spark, sf), 5, WIDTH)
    return hits.select(
        "query_id", "id", F.col("rank").cast("bigint").alias("rank"),
        F.round(vc.similarity(F.col("distance")), 6).alias("similarity"),
    )


@query(
    "topk_ann",
    f"""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vector FROM embeddings), d AS (SELECT q.id AS query_id, v.id,
      {COSINE_SQL.format(x='q.vector', y='v.vector')} AS distance FROM v q, v WHERE q.id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d)
    SELECT query_id, rank, id, round(distance, 6) AS distance, true AS certified, 1.0::DOUBLE AS recall FROM r WHERE rank <= 5""",
)
def topk_ann(spark, sf):
    """Every vector with an id divisible by 50 asks all of them; beside each hit the part of the exact hits that were found."""
    rows = ad.vectors(spark, sf)
    asked = rows.where(F.col("id") % 50 == 0).withColumnRenamed("id", "query_id")
    index = ann.build(rows, scratch_path(spark, "cells"), WIDTH, cells=8)
    found = index.search(asked, 5, probe=2)
    exact = nearest.top_k(rows, asked, 5, WIDTH).select("query_id", "id")
    hit = exact.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    recall = hit.groupBy("query_id").agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
    return found.join(recall, "query_id").select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id", F.round("distance", 6).alias("distance"), "certified", "recall"
    )


@query(
    "position_lookup",
    f"""{L2_HITS_SQL}, i AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos, label FROM embeddings)
    SELECT query_id, rank, pos, CAST(label AS BIGINT) AS label FROM r JOIN i ON i.vec_id = r.id WHERE rank <= 3""",
)
def position_lookup(spark, sf):
    rows = ad.table(spark, sf, "embeddings").withColumnRenamed("embedding", "vector")
    index, width = flat_index(rows, ["vec_id"])
    corpus = index.select(F.col("pos").alias("id"), "vector", F.col("label").cast("bigint").alias("label"))
    centres = ad.label_centres(spark, sf)
    hits = nearest.top_k(corpus, centres, 3, width, "l2")
    found = nearest.attach_documents(hits, corpus, centres, 3, "label")
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), F.col("id").alias("pos"), "label")


# Hashed embedder

EMBED_SQL = f"WITH {ad.BASE_SQL}, {ad.hits_sql()}"


@query("embed_hash", f"{EMBED_SQL} SELECT id, CAST(b AS BIGINT) AS bucket, w AS weight FROM pv")
def embed_hash(spark, sf):
    rows = ps.passages_base(ad.samples(spark, sf))
    v = embedding.embed(rows, "document", "hash-256")
    pairs = F.arrays_zip(F.col("vector.indices").alias("i"), F.col("vector.values").alias("w"))
    return v.select("id", F.inline(pairs)).toDF("id", "bucket", "weight").withColumn("bucket", F.col("bucket").cast("bigint"))


@query("embed_query", f"{EMBED_SQL} SELECT item_id AS query_id, CAST(b AS BIGINT) AS bucket, w AS weight FROM qv")
def embed_query(spark, sf):
    v = rt.embed_questions(ad.questions(spark, sf), ad.FULL)
    pairs = F.arrays_zip(F.col("vector.indices").alias("i"), F.col("vector.values").alias("w"))
    return v.select("query_id", F.inline(pairs)).toDF("query_id", "bucket", "weight").withColumn(
        "bucket", F.col("bucket").cast("bigint")
    )


def _base_hits(spark, sf, cfg: JobConfig = ad.FULL) -> DataFrame:
    rows = rt.passage_rows(ad.samples(spark, sf), cfg, ps.passages_base)
    return rt.search(rows, ad.questions(spark, sf), cfg)


@query(
    "retrieval_flatten",
    f"""{EMBED_SQL} SELECT query_id, rank, id, h.document, round(distance, 6) AS distance, lang AS type, 'unknown' AS level
    FROM hits h JOIN p USING (id)""",
)
def retrieval_flatten(spark, sf):
    rows = rt.passage_rows(ad.samples(spark, sf), ad.FULL, ps.passages_base).withColumn(
        "metadata", ps.metadata_default(F.col("type"), F.col("level"))
    )
    asked = ad.questions(spark, sf)
    hits = nearest.top_k(rows, rt.embed_questions(asked, ad.FULL), 5, 256)
    return nearest.attach_documents(hits, rows, asked, 5, "document", "metadata").select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id", "document",
        F.round("distance", 6).alias("distance"), F.col("metadata")["type"].alias("type"),
        F.col("metadata")["level"].alias("level"),
    )


@query("similarity_threshold", f"{EMBED_SQL} SELECT query_id, id, round(1.0 - distance, 6) AS similarity FROM hits WHERE 1.0 - distance >= 0.7")
def similarity_threshold(spark, sf):
    s = vc.similarity(F.col("distance"))
    return _base_hits(spark, sf).where(s >= 0.7).select("query_id", "id", F.round(s, 6).alias("similarity"))


@query("similarity_text", f"{EMBED_SQL} SELECT query_id, id, printf('%.3f', 1.0 - distance) AS similarity FROM hits")
def similarity_text(spark, sf):
    return _base_hits(spark, sf).select("query_id", "id", tx.fixed_3(vc.similarity(F.col("distance"))).alias("similarity"))


@query(
    "retrieval_by_model",
    f"""WITH {ad.BASE_SQL}, {ad.hits_sql()}, {ad.hits_sql(width=64, tail='2')}
    SELECT 'hash-256' AS model, query_id, rank, id, round(distance, 6) AS distance FROM hits
    UNION ALL SELECT 'hash-64', query_id, rank, id, round(distance, 6) FROM hits2""",
)
def retrieval_by_model(spark, sf):
    return rt.search_by_model(
        ps.passages_base(ad.samples(spark, sf)), ad.questions(spark, sf), ("hash-256", "hash-64"), 5
    ).select("model", "query_id", F.col("rank").cast("bigint").alias("rank"), "id", F.round("distance", 6).alias("distance"))


SCORED_SQL = """string_agg('Document ' || CAST(rank AS VARCHAR) || ' (similarity: ' || printf('%.3f', 1.0 - distance)
  || '):' || chr(10) || document || chr(10), chr(10) ORDER BY rank)"""
CONTEXTS_SQL = f"""{EMBED_SQL}, c AS (SELECT query_id, {SCORED_SQL} AS context FROM hits GROUP BY query_id)"""


@query("context_scored", f"{CONTEXTS_SQL} SELECT query_id, context FROM c")
def context_scored(spark, sf):
    return context.context_scored(_base_hits(spark, sf))


@query(
    "context_numbered",
    f"""{EMBED_SQL}
    SELECT item_id AS query_id, coalesce(string_agg('Context ' || CAST(rank AS VARCHAR) || ': ' || document,
      chr(10) || chr(10) ORDER BY rank), 'No relevant context found.') AS context
    FROM benchmark LEFT JOIN hits ON query_id = item_id GROUP BY item_id""",
)
def context_numbered(spark, sf):
    return context.context_numbered(_base_hits(spark, sf), ad.questions(spark, sf))


PLAIN_SQL = "string_agg(document, chr(10) || chr(10) ORDER BY rank)"


@query("context_plain", f"{EMBED_SQL} SELECT query_id, {PLAIN_SQL} AS context FROM hits GROUP BY query_id")
def context_plain(spark, sf):
    return context.context_plain(_base_hits(spark, sf))


@query(
    "truncate_ellipsis",
    "SELECT doc_id, CASE WHEN length(text) > 1000 THEN left(text, 1000) || '...' ELSE text END AS text FROM documents",
)
def truncate_ellipsis(spark, sf):
    return ad.table(spark, sf, "documents").select("doc_id", tx.truncate_ellipsis(F.col("text"), 1000).alias("text"))


@query(
    "truncate_marker",
    """SELECT doc_id, CASE WHEN length(text) > 1000 THEN left(text, 1000) || chr(10) || '[Context truncated]' ELSE text END
    AS text FROM documents""",
)
def truncate_marker(spark, sf):
    return ad.table(spark, sf, "documents").select("doc_id", tx.truncate_marker(F.col("text"), 1000).alias("text"))


@query("truncate_hard", "SELECT doc_id, left(text, 2000) AS text, text AS whole FROM documents")
def truncate_hard(spark, sf):
    return ad.table(spark, sf, "documents").select(
        "doc_id", tx.truncate_hard(F.col("text"), 2000).alias("text"), tx.truncate_hard(F.col("text"), None).alias("whole")
    )


@query("coalesce_default", "SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'unknown') AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def coalesce_default(spark, sf):
    joined = ad.table(spark, sf, "documents").join(ad.table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("unknown")).alias("quality"))


# Prompts over the questions with a document as context

DOC_CONTEXT_SQL = "FROM documents"
NL = "chr(10)"


def _doc_prompt(spark, sf, prompt):
    return ad.table(spark, sf, "documents").select("doc_id", prompt(F.col("text"), F.col("source")).alias("prompt"))


def _base_prompt_sql(c: str, q: str) -> str:
    return f"""{quoted(pr.SYSTEM_BASE)} || {NL} || {NL} || 'Context:' || {NL} || {c} || {NL} || {NL} || 'Question: ' || {q}
      || {NL} || {NL} || 'Answer:'"""


def _sonnet_prompt_sql(c: str, q: str) -> str:
    lead = (
        "Based on the following context, please answer the question. If the answer cannot be found in the context, "
        "please state that clearly."
    )
    return f"""'{lead}' || {NL} || {NL} || 'Context:' || {NL} || {c} || {NL} || {NL} || 'Question: ' || {q} || {NL} || {NL}
      || 'Answer:'"""


def _gpt5_prompt_sql(c: str, q: str, cap: int | None) -> str:
    if cap is not None:
        c = f"CASE WHEN length({c}) > {cap} THEN left({c}, {cap}) || {NL} || '[Context truncated]' ELSE {c} END"
    return f"""{quoted(pr.SYSTEM_STRICT)} || {NL} || {NL} || '=== Retrieved Context ===' || {NL} || {c} || {NL} || {NL} ||
      '=== Task ===' || {NL} || 'Question: ' || {q} || {NL} || 'Answer using ONLY the retrieved context above.' || {NL}"""


def _gemini_prompt_sql(c: str, q: str) -> str:
    return f"""'Based on the following context, answer the user''s query:' || {NL} || {NL} || 'Context:' || {NL} || {c}
      || {NL} || {NL} || 'Query: ' || {q} || {NL} || {NL} || 'Answer:'"""


def _flat_prompt_sql(c: str, q: str) -> str:
    return f"""{NL} || '    Context:' || {NL} || '    ' || {c} || {NL} || {NL} || '    User''s question: ' || {q} || {NL} || '    '"""


@query("prompt_base", f"SELECT doc_id, {_base_prompt_sql('text', 'source')} AS prompt FROM documents")
def prompt_base(spark, sf):
    return _doc_prompt(spark, sf, pr.prompt_base)


@query("prompt_sonnet", f"SELECT doc_id, {_sonnet_prompt_sql('text', 'source')} AS prompt FROM documents")
def prompt_sonnet(spark, sf):
    return _doc_prompt(spark, sf, pr.prompt_sonnet)


@query("prompt_gpt5", f"SELECT doc_id, {_gpt5_prompt_sql('text', 'source', pr.CONTEXT_CAP)} AS prompt FROM documents")
def prompt_gpt5(spark, sf):
    return _doc_prompt(spark, sf, pr.prompt_gpt5)


@query("prompt_gemini", f"SELECT doc_id, {_gemini_prompt_sql('text', 'source')} AS prompt FROM documents")
def prompt_gemini(spark, sf):
    return _doc_prompt(spark, sf, pr.prompt_gemini)


@query("prompt_flat", f"SELECT doc_id, {_flat_prompt_sql('text', 'source')} AS prompt FROM documents")
def prompt_flat(spark, sf):
    return _doc_prompt(spark, sf, pr.prompt_flat)


# Retrieval jobs


def _job_sql(passages: str, context_sql: str, prompt, empty: str = "") -> str:
    return f"""WITH {passages}, {ad.hits_sql()}, c AS (SELECT query_id, {context_sql} AS context FROM hits GROUP BY query_id)
    , every AS (SELECT item_id, text, coalesce(context, '{empty}') AS context FROM benchmark LEFT JOIN c ON item_id = query_id)
    SELECT item_id AS query_id, {prompt('context', 'text')} AS prompt FROM every"""


def _cut(c: str, q: str) -> str:
    return _base_prompt_sql(f"CASE WHEN length({c}) > {pr.CONTEXT_CAP} THEN left({c}, {pr.CONTEXT_CAP}) || '...' ELSE {c} END", q)


CAPPED = JobConfig(max_context_chars=pr.CONTEXT_CAP)


@query("rag_base", _job_sql(ad.BASE_SQL, SCORED_SQL, _cut))
def rag_base(spark, sf):
    return rt.rag_base(ad.samples(spark, sf), ad.questions(spark, sf), CAPPED)


@query("rag_gpt5", _job_sql(ad.CTX_SQL, PLAIN_SQL, lambda c, q: _gpt5_prompt_sql(c, q, pr.CONTEXT_CAP)))
def rag_gpt5(spark, sf):
    return rt.rag_gpt5(ad.samples(spark, sf), ad.questions(spark, sf), CAPPED)


NUMBERED_SQL = "string_agg('Context ' || CAST(rank AS VARCHAR) || ': ' || document, chr(10) || chr(10) ORDER BY rank)"


@query("rag_sonnet", _job_sql(ad.SAMPLE_SQL, NUMBERED_SQL, _sonnet_prompt_sql, "No relevant context found."))
def rag_sonnet(spark, sf):
    return rt.rag_sonnet(ad.samples(spark, sf), ad.questions(spark, sf), ad.FULL)


@query("rag_gemini", _job_sql(ad.LIST_TEXT_SQL, PLAIN_SQL, _gemini_prompt_sql))
def rag_gemini(spark, sf):
    store = Collection(scratch_path(spark, "collection"))
    return rt.rag_gemini(ad.samples(spark, sf), ad.questions(spark, sf), ad.FULL, store)


def _flat_sql(width: int) -> str:
    """Unit vectors in single precision, compared over the buckets both sides have."""
    t = f"f{width}"
    base = ad.hits_sql(3, width, t)
    return f"""{base},
    pu{t} AS (SELECT id, b, CAST(CAST(w / sqrt(n) AS FLOAT) AS DOUBLE) AS u FROM pv{t} JOIN pn{t} USING (id)),
    qu{t} AS (SELECT item_id, b, CAST(CAST(w / sqrt(n) AS FLOAT) AS DOUBLE) AS u FROM qv{t} JOIN qn{t} USING (item_id)),
    pl{t} AS (SELECT id, list(coalesce(u, 0) ORDER BY b) AS vector
      FROM (SELECT id, b, u FROM (SELECT DISTINCT id FROM pu{t}) CROSS JOIN range({width}) g(b)
            LEFT JOIN pu{t} USING (id, b)) GROUP BY id),
    ql{t} AS (SELECT item_id, list(coalesce(u, 0) ORDER BY b) AS vector
      FROM (SELECT item_id, b, u FROM (SELECT DISTINCT item_id FROM qu{t}) CROSS JOIN range({width}) g(b)
            LEFT JOIN qu{t} USING (item_id, b)) GROUP BY item_id),
    pos{t} AS (SELECT id, vector, row_number() OVER (ORDER BY id) - 1 AS pos FROM pl{t}),
    l2{t} AS (SELECT item_id, id, row_number() OVER (PARTITION BY item_id
      ORDER BY list_distance(pos{t}.vector, ql{t}.vector), pos) AS rank FROM pos{t}, ql{t}),
    ctx{t} AS (SELECT item_id AS query_id, string_agg(document, chr(10) || chr(10) ORDER BY rank) AS context
      FROM l2{t} JOIN p USING (id) WHERE rank <= 3 GROUP BY item_id)"""


def _flat_out(width: int) -> str:
    return f"""SELECT item_id AS query_id, {_flat_prompt_sql("coalesce(context, '')", 'text')} AS prompt, 'hash-{width}' AS model,
      {quoted(pr.SYSTEM_FLAT)} AS system FROM benchmark LEFT JOIN ctxf{width} ON item_id = query_id"""


@query(
    "rag_flat",
    f"""WITH p AS (SELECT doc_id AS id, text AS document FROM documents), {_flat_sql(64)}, {_flat_sql(32)}
    {_flat_out(64)} UNION ALL {_flat_out(32)}""",
)
def rag_flat(spark, sf):
    texts = ad.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text")
    return rt.rag_flat(texts, ad.questions(spark, sf), (64, 32))


# Plugged-in functions


def letter_embedder():
    """A stand-in for a caller's model: three letter counts."""
    return lambda texts: [[float(len(t)), float(t.count("e")), float(t.count(" "))] for t in texts]


@query(
    "embed_batch",
    """SELECT doc_id, CAST(length(text) AS DOUBLE) AS v0, CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS v1,
      CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS v2 FROM documents""",
)
def embed_batch(spark, sf):
    docs = ad.table(spark, sf, "documents").select("doc_id", "text")
    out = embedding.embed_batch(docs, "text", letter_embedder)
    return out.select("doc_id", *[F.col("vector")[i].cast("double").alias(f"v{i}") for i in range(3)])


def echo_model():
    """A stand-in for a caller's model: length of the prompt; long prompts fail."""

    def call(prompts):
        if any(len(p) > 4000 for p in prompts):
            raise ValueError("prompt too long")
        return [f"{len(p)} characters" for p in prompts]

    return call


REPLIES_SQL = """replies AS (SELECT doc_id, CASE WHEN length(text) <= 4000 THEN CAST(length(text) AS VARCHAR) || ' characters' END
  AS response, CASE WHEN length(text) > 4000 THEN 'ValueError: prompt too long' END AS error FROM documents)"""


def _replies(spark, sf):
    docs = ad.table(spark, sf, "documents").select("doc_id", "text")
    return embedding.generate_batch(docs, "text", echo_model)


@query("generate_batch", f"WITH {REPLIES_SQL} SELECT doc_id, response, error FROM replies")
def generate_batch(spark, sf):
    return _replies(spark, sf).select("doc_id", "response", "error")


@query(
    "error_as_value",
    f"""WITH {REPLIES_SQL} SELECT doc_id, coalesce(response, 'An error occurred during LLM generation: ' || error) AS answer
    FROM replies""",
)
def error_as_value(spark, sf):
    answer = embedding.error_as_text(F.col("response"), F.col("error"))
    return _replies(spark, sf).select("doc_id", answer.alias("answer"))


@query("stream_ingest", f"WITH {ad.BASE_SQL} SELECT id, document FROM p")
def stream_ingest(spark, sf):
    target = scratch_path(spark, "ingested")

    def to_passages(batch):
        return ps.passages_base(ad.as_samples(batch)).select("id", "document")

    jobs.stream_ingest(ad.stream(spark, sf, "documents"), to_passages, target, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(target).select("id", "document")
