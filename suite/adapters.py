"""The supplied tables in the shapes the operators read, in Spark and as SQL CTEs."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.rows import unnest_rows
from gleaner.operators.files import WORD
from gleaner.operators.models import MODELS, with_file_type
from gleaner.session import JobConfig, ship_package
from gleaner.sources.corpus import spread

FULL = JobConfig()


# Tables with long texts per row, and their keys.
HEAVY = {"documents": ("doc_id",), "pages": ("page_id",), "conversations": ("conv_id", "turn")}


def ship(spark: SparkSession) -> None:
    ship_package(spark, Path(__file__).resolve().parent)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(rows, *HEAVY[name]) if name in HEAVY else rows


def stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The rows of a table, one file or a folder of files, as a stream. A pattern, as a stream takes a plain path for a folder."""
    ship(spark)
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return as_samples(table(spark, sf, "documents"))


def as_samples(documents: DataFrame) -> DataFrame:
    """Corpus samples: every line of a document is a context entry."""
    entries = F.split("text", "\n")
    cut = F.concat(F.lit("."), F.chr(F.lit(1)))
    title = F.transform(entries, lambda e, i: F.concat(F.col("source"), F.lit("#"), i.cast("string")))
    sentences = F.transform(
        entries, lambda e: F.split(F.replace(e, F.lit(". "), cut), "\x01")
    )
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("type"),
        F.lit(None).cast("string").alias("level"),
        F.struct(title.alias("title"), sentences.alias("sentences")).alias("context"),
    )


ENTRIES_SQL = """
entries AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, lang, source,
         unnest(string_split(text, chr(10))) AS entry,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents),
parts AS (
  SELECT *, source || '#' || CAST(pos AS VARCHAR) AS title,
         string_split(replace(entry, '. ', '.' || chr(1)), chr(1)) AS sentences
  FROM entries)
"""
BASE_SQL = f"""{ENTRIES_SQL},
p AS (SELECT id || '_' || CAST(pos AS VARCHAR) AS id, lang,
             title || ' : ' || array_to_string(sentences, '; ') AS document FROM parts)
"""
CTX_SQL = f"""{ENTRIES_SQL},
p AS (SELECT id || '_ctx' || CAST(pos + 1 AS VARCHAR) AS id, lang,
             title || ' : ' || array_to_string(sentences, ' ') AS document FROM parts)
"""
SAMPLE_SQL = f"""{ENTRIES_SQL},
p AS (SELECT id, any_value(lang) AS lang,
             string_agg(title || ' : ' || array_to_string(sentences, ' '), ', ' ORDER BY pos) AS document
      FROM parts GROUP BY id)
"""
LIST_TEXT_SQL = f"""{ENTRIES_SQL},
p AS (SELECT id, any_value(lang) AS lang,
             string_agg(title || ' : [' || array_to_string(list_transform(sentences,
               lambda x: CASE WHEN contains(x, '''') THEN '"' || x || '"' ELSE '''' || x || '''' END), ', ') || ']',
               ' ' ORDER BY pos) AS document
      FROM parts GROUP BY id)
"""


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def hits_sql(k: int = 5, width: int = 256, tail: str = "") -> str:
    """Hashed-count hits of the questions among the rows of CTE ``p``."""

    def counts(source: str, key: str, text: str) -> str:
        return f"""SELECT {key}, CAST('0x' || left(md5(t), 8) AS BIGINT) % {width} AS b, CAST(count(*) AS DOUBLE) AS w
        FROM (SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS t FROM {source})
        WHERE t <> '' GROUP BY ALL"""

    return f"""
pv{tail} AS ({counts('p', 'id', 'document')}),
pn{tail} AS (SELECT id, sum(w * w) AS n FROM pv{tail} GROUP BY id),
qv{tail} AS ({counts('benchmark', 'item_id', 'text')}),
qn{tail} AS (SELECT item_id, sum(w * w) AS n FROM qv{tail} GROUP BY item_id),
dots{tail} AS (SELECT item_id, id, sum(qv{tail}.w * pv{tail}.w) AS dot
               FROM qv{tail} JOIN pv{tail} USING (b) GROUP BY ALL),
dist{tail} AS (SELECT item_id, id, 1.0 - dot / sqrt(qn{tail}.n * pn{tail}.n) AS distance
               FROM dots{tail} JOIN qn{tail} USING (item_id) JOIN pn{tail} USING (id)),
ranked{tail} AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY distance, id) AS rank FROM dist{tail}),
hits{tail} AS (SELECT item_id AS query_id, rank, id, distance, document
               FROM ranked{tail} JOIN p USING (id) WHERE rank <= {k})
"""


def label_centres(spark: SparkSession, sf: str) -> DataFrame:
    """One question vector per label: the mean of its vectors, to six places."""
    at = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = at.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("m"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "m")))
    return means.groupBy("label").agg(F.transform(ordered, lambda e: e["m"]).alias("vector")).select(
        F.col("label").cast("bigint").alias("query_id"), "vector"
    )


CENTRES_SQL = """
dims AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, round(avg(CAST(x AS DOUBLE)), 6) AS m FROM dims GROUP BY ALL),
q AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS vector FROM means GROUP BY label),
v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)
"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def model_by(key: Column) -> Column:
    names = F.array(*[F.lit(m[0]) for m in MODELS])
    return F.get(names, (key % len(MODELS)).cast("int"))


MODEL_LIST_SQL = "[" + ", ".join(f"'{m[0]}'" for m in MODELS) + "]"


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("chat_id"), "turn", "role", F.col("text").alias("content")
    )


MESSAGES_SQL = "messages AS (SELECT conv_id AS chat_id, turn, role, text AS content FROM conversations)"


def chat_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per chat: model, system message and start time."""
    system = F.max(F.when(F.col("role") == "system", F.col("content")))
    per_chat = messages(spark, sf).groupBy("chat_id").agg(system.alias("system_message"))
    minute = F.make_dt_interval(mins=F.col("chat_id").cast("int"))
    return per_chat.select(
        "chat_id", model_by(F.col("chat_id")).alias("model_nm"), "system_message",
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minute).alias("created"),
    )


REQUESTS_SQL = f"""{MESSAGES_SQL},
requests AS (
  SELECT chat_id, {MODEL_LIST_SQL}[chat_id % 6 + 1] AS model_nm,
         max(CASE WHEN role = 'system' THEN content END) AS system_message,
         TIMESTAMP '2024-01-01 00:00:00' + chat_id * INTERVAL 1 MINUTE AS created
  FROM messages GROUP BY chat_id)
"""
CHATS_SQL = f"""{REQUESTS_SQL},
firsts AS (SELECT chat_id, arg_min(content, turn) AS first_message FROM messages WHERE role = 'user' GROUP BY chat_id),
chats AS (
  SELECT chat_id, model_nm, coalesce(system_message, '') AS system_message,
         CASE WHEN coalesce(first_message, '') <> '' THEN model_nm || '-' || left(first_message, 40) ||
              CASE WHEN length(first_message) > 40 - length(model_nm) THEN '...' ELSE '' END
              ELSE 'Chat - ' || strftime(created, '%H:%M') END AS title,
         strftime(created, '%Y-%m-%dT%H:%M:%S') AS created_at,
         strftime(created, '%Y-%m-%dT%H:%M:%S') AS updated_at
  FROM requests LEFT JOIN firsts USING (chat_id))
"""

EXTENSIONS = [".txt", ".MD", ".json", ".pdf", ".png", ".xyz"]


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as uploaded files; the batch is the source. Labels say which are missing."""
    ext = F.get(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("doc_id") % 6).cast("int"))
    lead = (
        F.when(ext == ".pdf", F.unhex(F.lit("255044462D312E340A")))
        .when(ext == ".png", F.unhex(F.lit("89504E470D0A1A0A")))
        .otherwise(F.unhex(F.lit("")))
    )
    docs = table(spark, sf, "documents")
    marks = table(spark, sf, "labels")
    content = F.concat(lead, F.encode("text", "UTF-8"))
    return docs.join(marks, "doc_id", "left").select(
        F.concat(F.lit("/data/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), ext).alias("path"),
        F.col("source").alias("batch"),
        content.alias("content"),
        F.octet_length(content).cast("bigint").alias("length"),
        (F.coalesce("toxic", F.lit(0)) == 0).alias("exists"),
        (F.coalesce("quality", F.lit(1)) == 1).alias("is_file"),
    )


#: Texts of more bytes get an archive that unpacks to more than the budget; ids with this last digit a broken one.
DOCX_LONG, DOCX_BUDGET, DOCX_BROKEN = 8_000, 1 << 20, 7


def docx_archive(text: str, long: bool, broken: bool) -> bytes:
    """A text's lines as paragraphs of a docx."""
    lines = "".join(f"<w:p><w:r><w:t>{escape(t, {chr(13): '&#13;'})}</w:t></w:r></w:p>" for t in text.split("\n"))
    filler = f"<!--{' ' * DOCX_BUDGET}-->" if long else ""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{WORD[1:-1]}"><w:body>{filler}{lines}</w:body></w:document>')
    return out.getvalue()[: len(out.getvalue()) // 2] if broken else out.getvalue()


def docx_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as uploaded docx files."""

    @F.pandas_udf("binary")
    def archive(text: pd.Series, long: pd.Series, broken: pd.Series) -> pd.Series:
        return pd.Series([docx_archive(*row) for row in zip(text, long, broken)], dtype=object)

    ship(spark)
    docs = table(spark, sf, "documents").where("text IS NOT NULL")
    long, broken = F.octet_length("text") > DOCX_LONG, F.col("doc_id") % 10 == DOCX_BROKEN
    content = archive("text", long, broken)
    files = docs.select(F.concat(F.lit("/data/"), F.col("doc_id").cast("string"), F.lit(".docx")).alias("path"), content.alias("content"))
    return files.withColumn("length", F.octet_length("content").cast("bigint"))


def typed_files(spark: SparkSession, sf: str) -> DataFrame:
    from gleaner.operators.files import file_info

    return with_file_type(file_info(files(spark, sf)))


FILES_SQL = """
raw AS (
  SELECT d.doc_id, text, source, ['.txt', '.MD', '.json', '.pdf', '.png', '.xyz'][doc_id % 6 + 1] AS ext,
         coalesce(toxic, 0) = 0 AS present, coalesce(quality, 1) = 1 AS is_file
  FROM documents d LEFT JOIN labels l USING (doc_id)),
files AS (
  SELECT '/data/' || source || '/' || CAST(doc_id AS VARCHAR) || ext AS path, source AS batch,
         CAST(doc_id AS VARCHAR) || ext AS name, lower(ext) AS extension, text, present, is_file,
         CASE ext WHEN '.pdf' THEN from_hex('255044462D312E340A') WHEN '.png' THEN from_hex('89504E470D0A1A0A')
              ELSE ''::BLOB END || encode(text) AS content,
         CASE ext WHEN '.pdf' THEN 9 WHEN '.png' THEN 8 ELSE 0 END + strlen(text) AS length
  FROM raw),
typed AS (
  SELECT *, CASE WHEN extension IN ('.txt', '.md', '.json') THEN 'text' WHEN extension = '.pdf' THEN 'pdf'
                 WHEN extension = '.png' THEN 'image' END AS file_type,
         CASE extension WHEN '.txt' THEN 'text/plain' WHEN '.md' THEN 'text/markdown'
              WHEN '.json' THEN 'application/json' WHEN '.pdf' THEN 'application/pdf'
              WHEN '.png' THEN 'image/png' END AS mime_type
  FROM files),
checked AS (
  SELECT *, CASE WHEN NOT present THEN 'File not found: ' || path
                 WHEN NOT is_file THEN 'Path is not a file: ' || path
                 WHEN length <= 0 THEN 'File is empty: ' || path
                 WHEN file_type IS NULL THEN 'Unsupported file type: ' || extension END AS reason
  FROM typed)
"""
MEBIBYTES_SQL = """(length * 100 // 1048576 + CASE WHEN (length * 100 % 1048576) * 2 > 1048576
  OR ((length * 100 % 1048576) * 2 = 1048576 AND (length * 100 // 1048576) % 2 = 1) THEN 1 ELSE 0 END) / 100.0"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lower-cased sentences as source lines, so that some start like an import."""
    path = F.concat(F.lit("/src/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".py"))
    pieces = F.split(F.lower("text"), r"\n|\. ")
    return unnest_rows(table(spark, sf, "documents"), pieces, "pos", "line", path.alias("path")).drop("pos")


LINES_SQL = """
lines AS (SELECT '/src/' || source || '/' || CAST(doc_id AS VARCHAR) || '.py' AS path,
                 unnest(regexp_split_to_array(lower(text), '\\n|\\. ')) AS line FROM documents)
"""

HIDDEN = [
    ("<!--.*?-->", "s"), (r"<script\b[^>]*>.*?(?:</script\s*>|\z)", "si"), (r"<style\b[^>]*>.*?(?:</style\s*>|\z)", "si")
]


def _hidden_sql(expr: str, token: str) -> str:
    for pattern, flags in HIDDEN:
        expr = f"regexp_replace({expr}, '{pattern}', '{token}', 'g{flags}')"
    return expr


SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def _decoded_sql(x: str) -> str:
    for name, code in (("&lt;", 60), ("&gt;", 62), ("&quot;", 34), ("&nbsp;", 160), ("&copy;", 169), ("&middot;", 183)):
        x = f"replace({x}, '{name}', chr({code}))"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


PAGES_SQL = f"""
bodies AS (SELECT page_id, url, html,
  regexp_extract(html, '<body\\b[^>]*>(.*?)(?:</body\\s*>|\\z)', 1, 'si') AS body,
  {_hidden_sql('html', '')} AS visible FROM pages),
fragments AS (SELECT page_id, list_filter(list_transform(
    regexp_split_to_array({_hidden_sql('body', '<x>')}, '<[a-zA-Z/!?][^>]*>'),
    lambda x: trim({_decoded_sql('x')}, {SPACE_SQL})), lambda x: x <> '') AS f FROM bodies),
texts AS (SELECT page_id, array_to_string(list_filter(list_transform(
    string_split(array_to_string(f, ''), chr(10)), lambda x: trim(x, {SPACE_SQL})), lambda x: x <> ''), chr(10)) AS text
  FROM fragments),
parsed AS (SELECT b.page_id, url,
    coalesce(nullif({_decoded_sql("regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'si')")}, ''),
             'No title found') AS title, text,
    list_filter(list_transform(regexp_extract_all(visible, '<a\\s[^>]*>', 0, 'i'),
      lambda x: {_decoded_sql("regexp_extract(x, 'href=\"([^\"]*)\"', 1)")}), lambda x: x <> '') AS links
  FROM bodies b JOIN texts USING (page_id)),
contents AS (SELECT *, 'Webpage Title:' || chr(10) || title || chr(10) || 'Webpage Contents:' || chr(10) || text
                       || chr(10) || chr(10) AS contents FROM parsed)
"""


def pages(spark: SparkSession, sf: str) -> DataFrame:
    from gleaner.operators.web import parse_pages

    return parse_pages(table(spark, sf, "pages"))


def parsed_pages(spark: SparkSession, sf: str) -> DataFrame:
    from gleaner.operators.web import parse_once

    return parse_once(table(spark, sf, "pages"))


def followed_links(parsed: DataFrame) -> DataFrame:
    """Links to follow: a page's own anchors, completed, and the URL of the next page."""
    from gleaner.functions.html import clean_url

    own = unnest_rows(parsed, "links", "link_pos", "link", "page_id", "url").select(
        "page_id", "link_pos", F.lit("site page").alias("type"),
        clean_url(F.col("link"), F.col("url")).alias("url"),
    )
    nxt = parsed.select((F.col("page_id") - 1).alias("page_id"), "url")
    onward = parsed.select("page_id", F.size("links").cast("bigint").alias("link_pos")).join(nxt, "page_id").select(
        "page_id", "link_pos", F.lit("next page").alias("type"), "url"
    )
    return own.unionByName(onward)


FOLLOWED_SQL = f"""{PAGES_SQL},
anchors AS (SELECT page_id, url AS base, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS link_pos FROM parsed),
links AS (
  SELECT page_id, link_pos, 'site page' AS type,
         CASE WHEN link LIKE '/%' THEN regexp_extract(base, '^([a-z]+://[^/?#]+)', 1) || replace(link, ' ', '')
              ELSE replace(link, ' ', '') END AS url FROM anchors
  UNION ALL
  SELECT a.page_id, len(links), 'next page', b.url FROM parsed a JOIN pages b ON b.page_id = a.page_id + 1),
sections AS (
  SELECT page_id, CAST(-1 AS BIGINT) AS pos, 'Content for Landing Page URL: ' || url || ' is: ' || contents || chr(10)
         || chr(10) || 'Content from embedded links:' || chr(10) AS section FROM contents
  UNION ALL
  SELECT l.page_id, link_pos, chr(10) || type || chr(10) || CASE WHEN c.contents IS NULL THEN '' ELSE
         'Link ' || l.url || ' is of type: ''' || type || ''', and its content is as follows: ' || c.contents || ' '
         || chr(10) END FROM links l LEFT JOIN contents c ON c.url = l.url),
linked AS (SELECT page_id, string_agg(section, '' ORDER BY pos) AS content FROM sections GROUP BY page_id)
"""
