"""File intake: filters, lookups, aggregates and conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.operators import files as fl
from gleaner.operators import models as md
from gleaner.operators.ordinals import paged_text, with_key_totals
from gleaner.plans import intake

from . import adapters as ad
from .registry import query

GATE = 60_000
GATED_SQL = f"""gated AS (SELECT *, CAST(sum(length) OVER (PARTITION BY batch) AS BIGINT) AS total_bytes,
  sum(length) OVER (PARTITION BY batch) <= {GATE} AS accepted FROM checked)"""


@query(
    "file_info",
    f"WITH {ad.FILES_SQL} SELECT path, name, length AS size_bytes, {ad.MEBIBYTES_SQL} AS size_mb, extension FROM files",
)
def file_info(spark, sf):
    return fl.file_info(ad.files(spark, sf)).select("path", "name", "size_bytes", "size_mb", "extension")


@query("size_mb", f"WITH {ad.FILES_SQL} SELECT path, {ad.MEBIBYTES_SQL} AS size_mb FROM (SELECT path, length * 97 AS length FROM files)")
def size_mb(spark, sf):
    return ad.files(spark, sf).select("path", tx.size_mb(F.col("length") * 97).alias("size_mb"))


@query("file_extension", f"WITH {ad.FILES_SQL} SELECT path, extension FROM files")
def file_extension(spark, sf):
    return ad.files(spark, sf).select("path", tx.file_extension(F.col("path")).alias("extension"))


def _converted(spark, sf) -> DataFrame:
    valid = fl.validated(ad.files(spark, sf)).where("reason IS NULL")
    return fl.files_to_text(valid)


TEXT_SQL = "CASE WHEN file_type = 'text' THEN text ELSE to_base64(content) END"


@query(
    "file_metadata",
    f"""WITH {ad.FILES_SQL} SELECT path, CAST(json_object('file_type', file_type, 'mime_type', mime_type,
    'content_length', CAST(length({TEXT_SQL}) AS VARCHAR), 'name', name, 'size_bytes', CAST(length AS VARCHAR),
    'size_mb', CAST({ad.MEBIBYTES_SQL} AS VARCHAR), 'extension', upper(extension)) AS VARCHAR) AS metadata
    FROM checked WHERE reason IS NULL""",
)
def file_metadata(spark, sf):
    extra = F.create_map(F.lit("extension"), F.upper("extension"))
    return _converted(spark, sf).select("path", F.to_json(fl.file_metadata(extra)).alias("metadata"))


@query(
    "content_parts",
    f"""WITH {ad.FILES_SQL}
    SELECT path, model_nm, CASE file_type WHEN 'text' THEN 'text' WHEN 'pdf' THEN 'file' ELSE 'image' END AS type,
      CASE WHEN file_type = 'text' THEN trim(text, {ad.SPACE_SQL}) END AS text,
      CASE WHEN file_type <> 'text' THEN 'base64' END AS source_type,
      CASE file_type WHEN 'pdf' THEN 'application/pdf' WHEN 'image' THEN 'image/jpeg' END AS mime_type,
      CASE WHEN file_type <> 'text' THEN to_base64(content) END AS data
    FROM checked, (VALUES ('gpt-4o-mini', false, false), ('claude-sonnet-4-0', true, true)) m(model_nm, img, pdf)
    WHERE reason IS NULL AND (file_type = 'text' OR (file_type = 'pdf' AND pdf) OR (file_type = 'image' AND img))""",
)
def content_parts(spark, sf):
    models = F.array(F.lit("gpt-4o-mini"), F.lit("claude-sonnet-4-0"))
    rows = fl.nonempty_content(_converted(spark, sf)).withColumn("model_nm", F.explode(models))
    parts = md.with_model(rows).withColumn("part", fl.content_part()).where("part IS NOT NULL")
    return parts.select("path", "model_nm", "part.*")


@query(
    "supported_extension",
    f"WITH {ad.FILES_SQL} SELECT path, file_type FROM typed WHERE file_type IS NOT NULL",
)
def supported_extension(spark, sf):
    return ad.typed_files(spark, sf).where("file_type IS NOT NULL").select("path", "file_type")


@query("valid_files", f"WITH {ad.FILES_SQL} SELECT path, reason, reason IS NULL AS valid FROM checked")
def valid_files(spark, sf):
    return fl.validated(ad.files(spark, sf)).select("path", "reason", F.col("reason").isNull().alias("valid"))


@query(
    "content_confidence",
    f"""WITH {ad.FILES_SQL} SELECT path,
      CASE WHEN extension IN ('.pdf', '.png') THEN 0.0 WHEN length = 0 THEN 0.0
           WHEN length(text) = strlen(text) THEN 1.0 ELSE 0.99 END::DOUBLE AS text_conf,
      CASE WHEN extension IN ('.pdf', '.png') THEN 0.9 ELSE 0.0 END::DOUBLE AS bin_conf,
      CASE WHEN extension = '.pdf' THEN 'application/pdf' WHEN extension = '.png' THEN 'image/png'
           WHEN length = 0 THEN NULL
           WHEN length(text) = strlen(text) THEN 'text/ascii' ELSE 'text/utf-8' END AS actual_mime,
      length > 0 AS confident FROM typed""",
)
def content_confidence(spark, sf):
    return fl.sniff(ad.typed_files(spark, sf)).select(
        "path", "text_conf", "bin_conf", fl.actual_mime().alias("actual_mime"), fl.confident().alias("confident")
    )


@query(
    "content_matches_extension",
    f"""WITH {ad.FILES_SQL} SELECT path, length > 0 AS lenient, length > 0 AND extension <> '.json' AS strict FROM typed""",
)
def content_matches_extension(spark, sf):
    return fl.sniff(ad.typed_files(spark, sf)).select(
        "path", fl.matches_extension().alias("lenient"), fl.matches_extension(strict=True).alias("strict")
    )


@query("upload_size_gate", f"WITH {ad.FILES_SQL}, {GATED_SQL} SELECT path, batch, total_bytes, accepted FROM gated")
def upload_size_gate(spark, sf):
    thin = ad.files(spark, sf).select("path", "batch", "length")
    return fl.size_gate(thin, "batch", GATE).select("path", "batch", "total_bytes", "accepted")


@query(
    "batch_size_total",
    f"WITH {ad.FILES_SQL}, {GATED_SQL} SELECT path, batch, length, total_bytes FROM gated",
)
def batch_size_total(spark, sf):
    thin = ad.files(spark, sf).select("path", "batch", "length")
    return with_key_totals(thin, ["batch"], ["path"], total_bytes=F.sum("length").cast("bigint")).select(
        "path", "batch", "length", "total_bytes"
    )


@query(
    "upload_bytes",
    f"WITH {ad.FILES_SQL} SELECT batch, CAST(sum(length) AS BIGINT) AS total_bytes FROM files WHERE present GROUP BY batch",
)
def upload_bytes(spark, sf):
    present = ad.files(spark, sf).where(F.col("exists"))
    return present.groupBy("batch").agg(F.sum("length").cast("bigint").alias("total_bytes"))


@query(
    "nonempty_content",
    f"""WITH {ad.FILES_SQL} SELECT path, file_type, trim({TEXT_SQL}, {ad.SPACE_SQL}) AS text FROM typed
    WHERE present AND file_type IS NOT NULL AND length({TEXT_SQL}) > 0""",
)
def nonempty_content(spark, sf):
    converted = fl.files_to_text(ad.typed_files(spark, sf).where(F.col("exists")))
    return fl.nonempty_content(converted).select("path", "file_type", "text")


IMAGE_SQL = f"""WITH {ad.FILES_SQL}, {ad.REQUESTS_SQL},
  r AS (SELECT 'src' || CAST(chat_id AS VARCHAR) AS batch, chat_id, model_nm,
        model_nm NOT IN ('llama3.2', 'gemma3:1b') AS att,
        model_nm IN ('gpt-4o', 'claude-sonnet-4-0', 'gemini-1.5-flash') AS img,
        model_nm IN ('claude-sonnet-4-0', 'gemini-1.5-flash') AS pdf FROM requests)"""


def _requests_by_batch(spark, sf) -> DataFrame:
    batch = F.concat(F.lit("src"), F.col("chat_id").cast("string"))
    return ad.chat_requests(spark, sf).select(batch.alias("batch"), "chat_id", "model_nm")


@query(
    "image_gate",
    f"""{IMAGE_SQL} SELECT chat_id, path, file_type, CASE WHEN file_type = 'image' AND NOT img THEN 'dropped'
      WHEN file_type = 'pdf' AND pdf THEN 'base64' WHEN file_type = 'image' THEN 'base64' ELSE 'text' END AS form
    FROM typed JOIN r USING (batch) WHERE file_type IS NOT NULL""",
)
def image_gate(spark, sf):
    typed = ad.typed_files(spark, sf).where("file_type IS NOT NULL").drop("content")
    rows = intake.for_requests(typed, _requests_by_batch(spark, sf), "batch")
    return rows.select("chat_id", "path", "file_type", intake.content_form().alias("form"))


@query(
    "attachable_files",
    f"""{IMAGE_SQL} SELECT chat_id, path, file_type FROM typed JOIN r USING (batch)
    WHERE att AND (file_type IN ('text', 'pdf') OR (file_type = 'image' AND img))""",
)
def attachable_files(spark, sf):
    typed = ad.typed_files(spark, sf).drop("content")
    return md.attachable_files(_requests_by_batch(spark, sf), typed, "batch").select("chat_id", "path", "file_type")


@query("extension_type", f"WITH {ad.FILES_SQL} SELECT path, extension, file_type, mime_type FROM typed")
def extension_type(spark, sf):
    return ad.typed_files(spark, sf).select("path", "extension", "file_type", "mime_type")


@query("mime_guess", f"WITH {ad.FILES_SQL} SELECT path, mime_type FROM typed")
def mime_guess(spark, sf):
    return ad.typed_files(spark, sf).select("path", "mime_type")


@query(
    "unprocessed_files",
    f"""WITH {ad.FILES_SQL}, late AS (SELECT batch, name, row_number() OVER (PARTITION BY batch ORDER BY path) - 1 AS pos
      FROM checked WHERE reason IS NOT NULL)
    SELECT batch, pos // 1000 AS page, string_agg(name, chr(10) ORDER BY pos) AS names FROM late GROUP BY ALL""",
)
def unprocessed_files(spark, sf):
    every = ad.files(spark, sf).select("batch", "path")
    done = fl.validated(ad.files(spark, sf)).where("reason IS NULL").select("batch", "path")
    late = every.join(done, ["batch", "path"], "left_anti").withColumn("name", tx.base_name(F.col("path")))
    return paged_text(late, ["batch"], ["path"], F.col("name"), "names")


@query("files_except", f"WITH {ad.FILES_SQL} SELECT batch, path FROM files EXCEPT ALL SELECT batch, path FROM checked WHERE reason IS NULL")
def files_except(spark, sf):
    done = fl.validated(ad.files(spark, sf)).where("reason IS NULL").select("batch", "path")
    return ad.files(spark, sf).select("batch", "path").exceptAll(done)


@query(
    "validation_errors",
    f"""WITH {ad.FILES_SQL}, bad AS (SELECT batch, path, reason,
      row_number() OVER (PARTITION BY batch ORDER BY path) - 1 AS pos FROM checked WHERE reason IS NOT NULL)
    SELECT batch, pos // 1000 AS page, string_agg(path || ': ' || reason, chr(10) ORDER BY pos) AS report
    FROM bad GROUP BY ALL""",
)
def validation_errors(spark, sf):
    bad = fl.validated(ad.files(spark, sf)).where("reason IS NOT NULL").select("batch", "path", "reason")
    return paged_text(bad, ["batch"], ["path"], F.concat("path", F.lit(": "), "reason"), "report")


@query(
    "ingest_counts",
    f"""WITH {ad.FILES_SQL} SELECT batch, count(*) AS uploaded, count(*) FILTER (reason IS NULL) AS valid,
    count(*) FILTER (reason IS NOT NULL) AS skipped FROM checked GROUP BY batch""",
)
def ingest_counts(spark, sf):
    reason = F.col("reason")
    return fl.validated(ad.files(spark, sf)).groupBy("batch").agg(
        F.count(F.lit(1)).alias("uploaded"), F.count_if(reason.isNull()).alias("valid"),
        F.count_if(reason.isNotNull()).alias("skipped"),
    )


@query(
    "best_mime",
    """WITH c AS (SELECT user_id, event_type, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS conf, event_id
       FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY conf DESC, event_id) AS n FROM c)
    SELECT user_id AS path, CASE WHEN conf > 0 THEN event_type END AS mime,
           CAST(greatest(conf, 0) AS DOUBLE) AS conf FROM r WHERE n = 1""",
)
def best_mime(spark, sf):
    conf = F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value"))
    candidates = ad.table(spark, sf, "events").select(
        F.col("user_id").alias("path"), F.col("event_type").alias("mime"), conf.alias("conf"),
        F.col("event_id").alias("pos"),
    )
    return fl.best_mime(candidates)


@query("line_count", f"WITH {ad.FILES_SQL} SELECT path, len(string_split(text, chr(10))) AS n_lines FROM files")
def line_count(spark, sf):
    ext = F.get(F.array(*[F.lit(e) for e in ad.EXTENSIONS]), (F.col("doc_id") % 6).cast("int"))
    path = F.concat(F.lit("/data/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), ext)
    return ad.table(spark, sf, "documents").select(path.alias("path"), tx.line_count(F.col("text")).alias("n_lines"))


@query(
    "page_join",
    """SELECT doc_id, array_to_string(string_split(text, chr(10)), chr(10) || '--- Page Break ---' || chr(10)) AS text
    FROM documents""",
)
def page_join(spark, sf):
    return ad.table(spark, sf, "documents").select("doc_id", tx.page_join(F.split("text", "\n")).alias("text"))


@query("to_base64", f"WITH {ad.FILES_SQL} SELECT path, to_base64(content) AS data FROM files")
def to_base64(spark, sf):
    return ad.files(spark, sf).select("path", tx.to_base64(F.col("content")).alias("data"))


@query(
    "encoding_rule",
    f"WITH {ad.FILES_SQL} SELECT path, CASE WHEN length > 0 AND extension <> '.png' THEN 'utf-8' END AS encoding FROM files",
)
def encoding_rule(spark, sf):
    return fl.sniff(ad.files(spark, sf)).select("path", tx.encoding_rule(F.col("encoding")).alias("encoding"))


@query(
    "files_to_text",
    f"""WITH {ad.FILES_SQL} SELECT path, file_type, {TEXT_SQL} AS text,
      CASE WHEN file_type = 'text' THEN 'utf-8' END AS encoding_out,
      CASE WHEN file_type = 'text' THEN len(string_split(text, chr(10))) END AS line_count
    FROM checked WHERE reason IS NULL""",
)
def files_to_text(spark, sf):
    return _converted(spark, sf).select("path", "file_type", "text", "encoding_out", "line_count")


@query(
    "docx_to_text",
    f"""SELECT '/data/' || CAST(doc_id AS VARCHAR) || '.docx' AS path, 'ms-wordx' AS file_type,
      CASE WHEN strlen(text) <= {ad.DOCX_LONG} AND doc_id % 10 <> {ad.DOCX_BROKEN} THEN text END AS text
    FROM documents WHERE text IS NOT NULL""",
)
def docx_to_text(spark, sf):
    """Archives of all documents, some broken and some too large, which have no text."""
    typed = md.with_file_type(fl.file_info(ad.docx_files(spark, sf)))
    return fl.files_to_text(typed, ad.DOCX_BUDGET).select("path", "file_type", "text")


@query(
    "file_intake",
    f"""{IMAGE_SQL}, {GATED_SQL}
    SELECT chat_id, path, CASE WHEN NOT accepted THEN 'FATAL ERROR: Total size ' || CAST(total_bytes AS VARCHAR)
        || ' exceeds max allowed {GATE}. Delete some files.'
        WHEN reason IS NOT NULL THEN reason WHEN NOT ok THEN 'not accepted by model' END AS error,
      CASE WHEN accepted AND reason IS NULL AND ok THEN
        CASE file_type WHEN 'text' THEN 'text' WHEN 'pdf' THEN 'file' ELSE 'image' END END AS part_type,
      CASE WHEN accepted AND reason IS NULL AND ok THEN md5(CASE WHEN file_type = 'text'
        THEN trim(text, {ad.SPACE_SQL}) ELSE to_base64(content) END) END AS part_md5
    FROM (SELECT *, CASE file_type WHEN 'text' THEN true WHEN 'pdf' THEN pdf WHEN 'image' THEN img END AS ok
          FROM gated JOIN r USING (batch) WHERE att)""",
)
def file_intake(spark, sf):
    rows = intake.file_intake(ad.files(spark, sf), _requests_by_batch(spark, sf), "batch", GATE)
    part = F.col("part")
    return rows.select(
        "chat_id", "path", "error", part["type"].alias("part_type"),
        F.md5(F.coalesce(part["text"], part["data"]).cast("binary")).alias("part_md5"),
    )
