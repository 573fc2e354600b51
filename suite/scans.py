"""Sources, sinks and projections."""

from __future__ import annotations

import re
from functools import partial
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import files as fl
from gleaner.operators import passages as ps
from gleaner.operators.embedding import embed
from gleaner.operators.modules import excluded
from gleaner.session import scratch_path
from gleaner.sources import corpus
from gleaner.sources.collection import Collection, batch_numbers, flat_index

from . import adapters as ad
from .registry import query

EXCLUDED = ("src1", "src7/")
# Files of a folder of documents: many folders are listed in parallel.
FOLDER_FILES = 4_096


@query("corpus_scan", "SELECT doc_id, text, source, lang FROM documents WHERE lang = 'en'")
def corpus_scan(spark, sf):
    ad.ship(spark)
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING"
    return corpus.corpus_scan(spark, f"{sf}/documents.parquet", schema, lang="en").select(
        "doc_id", "text", "source", "lang"
    )


@query("ingest_limit", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def ingest_limit(spark, sf):
    return corpus.ingest_limit(ad.table(spark, sf, "documents"), 10, ["doc_id"]).select("doc_id", "text")


@query("ingest_hard_cap", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 1001")
def ingest_hard_cap(spark, sf):
    return corpus.ingest_hard_cap(ad.table(spark, sf, "documents"), None, ["doc_id"]).select("doc_id", "n_chars")


@query("page_scan", "SELECT page_id, url, html FROM pages")
def page_scan(spark, sf):
    ad.ship(spark)
    return corpus.page_scan(spark, f"{sf}/pages.parquet")


def _document_files(spark, sf) -> str:
    """A folder tree with a text file for each document; its id is in the name.

    The tasks write the files, each into folders of its own. A folder for every document, as a writer by
    partition makes, takes far longer to make and to list than the files; a few large ones are listed by the driver alone.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(scratch_path(spark, "document-files"))
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    where = store.makeQualified(folder).toString()
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = ad.table(spark, sf, "documents").select(F.col("doc_id").cast("string"), text).sortWithinPartitions("doc_id")
    rows.mapInPandas(partial(_write_files, where), "n_files long").agg(F.sum("n_files")).collect()
    return where


def _write_files(folder: str, batches):
    """Files ``doc_id=<id>.txt`` of rows sorted by id; rows that share an id are lines of one file. Each is put in place whole."""
    store, root = FileSystem.from_uri(re.sub("^file:/+", "/", folder))
    context = TaskContext.get()
    own, hidden = "", f".{context.taskAttemptId()}"
    rows = ((i or "", t) for b in batches for i, t in zip(b["doc_id"], b["text"]))
    n = 0
    for n, (id_, same) in enumerate(groupby(rows, itemgetter(0)), 1):
        if n % FOLDER_FILES == 1:
            own = f"{root}/{context.partitionId()}-{n // FOLDER_FILES}"
            store.create_dir(own)
        with store.open_output_stream(f"{own}/{hidden}") as out:
            out.writelines(part for _, text in same for part in (text, b"\n"))
        store.move(f"{own}/{hidden}", f"{own}/doc_id={id_}.txt")
    yield pd.DataFrame({"n_files": [n]})


def _doc_id():
    return F.regexp_extract("path", r"doc_id=(-?[0-9]+)\.txt$", 1).try_cast("bigint").alias("doc_id")


@query(
    "file_scan",
    """SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size_bytes, '.txt' AS extension,
      md5(coalesce(text, '') || chr(10)) AS content_md5 FROM documents""",
)
def file_scan(spark, sf):
    """Files with their bytes; a file ends with a line feed."""
    scanned = fl.file_info(corpus.file_scan(spark, _document_files(spark, sf), glob="*.txt"))
    return scanned.select(_doc_id(), "size_bytes", "extension", F.md5("content").alias("content_md5"))


@query(
    "line_scan",
    "SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents",
)
def line_scan(spark, sf):
    return corpus.line_scan(spark, _document_files(spark, sf), "*.txt").select(_doc_id(), "line")


@query(
    "tree_scan_excluding",
    f"""WITH {ad.LINES_SQL}
    SELECT path, contains(path, 'src1') OR contains(path, 'src7/') AS skipped, count(*) AS n_lines
    FROM lines GROUP BY ALL""",
)
def tree_scan_excluding(spark, sf):
    flagged = ad.lines(spark, sf).withColumn("skipped", excluded(F.col("path"), EXCLUDED))
    return flagged.groupBy("path", "skipped").agg(F.count(F.lit(1)).alias("n_lines"))


def _rows(spark, sf) -> DataFrame:
    made = ps.passages_base(ad.samples(spark, sf)).withColumn(
        "metadata", ps.metadata_default(F.col("type"), F.col("level"))
    )
    return embed(made, "document", ad.FULL.embedding_model).select("id", "document", "vector", "metadata", "type")


def _stored(store: Collection, spark) -> DataFrame:
    return store.read(spark).select("id", "document", F.col("metadata")["type"].alias("type"))


STORED_SQL = f"WITH {ad.BASE_SQL} SELECT id, document, lang AS type FROM p"


@query("collection_replace", STORED_SQL)
def collection_replace(spark, sf):
    store = Collection(scratch_path(spark, "collection"))
    rows = _rows(spark, sf).drop("type")
    store.replace(rows.withColumn("document", F.lit("old")))
    store.replace(rows)
    return _stored(store, spark)


@query("collection_append_batched", STORED_SQL)
def collection_append_batched(spark, sf):
    store = Collection(scratch_path(spark, "collection"))
    rows = _rows(spark, sf)
    store.create(spark, rows.drop("type"))
    store.append(rows.where("type = 'en'").drop("type"), max_records_per_file=1000)
    store.append(rows.where("type <> 'en'").drop("type"), max_records_per_file=1000)
    return _stored(store, spark)


@query("collection_fill_if_empty", STORED_SQL)
def collection_fill_if_empty(spark, sf):
    store = Collection(scratch_path(spark, "collection"))
    rows = _rows(spark, sf).drop("type")
    store.fill_if_empty(rows)
    store.fill_if_empty(rows.withColumn("id", F.concat("id", F.lit("again"))))
    return _stored(store, spark)


@query("collection_count", f"WITH {ad.BASE_SQL} SELECT count(*) AS n_rows FROM p")
def collection_count(spark, sf):
    store = Collection(scratch_path(spark, "collection"))
    store.fill_if_empty(_rows(spark, sf).drop("type"))
    return store.read(spark).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "flat_index",
    """SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pos, vec_id, CAST(len(embedding) AS BIGINT) AS width,
       round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM embeddings""",
)
def flat(spark, sf):
    rows = ad.table(spark, sf, "embeddings").withColumnRenamed("embedding", "vector")
    index, _ = flat_index(rows, ["vec_id"])
    return index.select(
        "pos", "vec_id", F.size("vector").cast("bigint").alias("width"),
        F.round(F.col("vector")[0].cast("double"), 6).alias("first_value"),
    )


@query("csv_to_pipe", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_to_pipe(spark, sf):
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "pipe")
    rows = ad.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    rows.write.option("header", True).csv(source)
    corpus.csv_to_pipe(spark, source, target)
    return corpus.read_pipe(spark, target, rows.schema)


@query(
    "batch_number",
    """SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 + 1 AS batch,
       CAST(ceil(count(*) OVER () / 100.0) AS BIGINT) AS batches FROM documents""",
)
def batch_number(spark, sf):
    return batch_numbers(ad.table(spark, sf, "documents").select("doc_id"), ["doc_id"], 100)


# Projections


@query("passages_base", f"WITH {ad.BASE_SQL} SELECT id, document, lang AS type FROM p")
def passages_base(spark, sf):
    return ps.passages_base(ad.samples(spark, sf)).select("id", "document", "type")


@query("passages_ctx", f"WITH {ad.CTX_SQL} SELECT id, document, lang AS type FROM p")
def passages_ctx(spark, sf):
    return ps.passages_ctx(ad.samples(spark, sf)).select("id", "document", "type")


@query(
    "context_ordinal",
    f"WITH {ad.ENTRIES_SQL} SELECT id AS sample_id, pos AS ordinal_0, pos + 1 AS ordinal_1, title FROM parts",
)
def context_ordinal(spark, sf):
    rows = ps.passages_base(ad.samples(spark, sf))
    return rows.select(
        "sample_id", F.col("ordinal").alias("ordinal_0"), (F.col("ordinal") + 1).alias("ordinal_1"),
        F.split_part("document", F.lit(" : "), F.lit(1)).alias("title"),
    )


@query("sample_document", f"WITH {ad.SAMPLE_SQL} SELECT id, document FROM p")
def sample_document(spark, sf):
    return ps.sample_document(ad.samples(spark, sf)).select("id", "document")


@query("sample_document_list_text", f"WITH {ad.LIST_TEXT_SQL} SELECT id, document FROM p")
def sample_document_list_text(spark, sf):
    return ps.sample_document_list_text(ad.samples(spark, sf)).select("id", "document")


@query(
    "sample_document_pairs",
    f"""WITH {ad.ENTRIES_SQL}
    SELECT id, string_agg(CASE WHEN lang = 'de' THEN 'title[' || CAST(pos AS VARCHAR) || ']' ELSE title END || ' : ' ||
           CASE WHEN entry = '' THEN '' ELSE array_to_string(sentences, ' ') END, ', ' ORDER BY pos) AS document
    FROM parts GROUP BY id""",
)
def sample_document_pairs(spark, sf):
    """Titles missing for one language, sentences missing for empty lines."""
    base = ad.samples(spark, sf).withColumns({"t": F.col("context.title"), "s": F.col("context.sentences")})
    empty = F.array(F.lit(""))
    pairs = F.zip_with(
        "t", "s",
        lambda t, s: F.struct(
            F.when(F.col("type") != "de", t).alias("title"), F.when(s != empty, s).alias("sentences")
        ),
    )
    return ps.sample_document_pairs(base.select("id", pairs.alias("context"))).select("id", "document")


@query(
    "derive_id",
    """SELECT doc_id, CASE lang WHEN 'en' THEN CAST(doc_id AS VARCHAR) WHEN 'de' THEN '_' || source
       ELSE 'hotpot_' || CAST(doc_id AS VARCHAR) END AS id FROM documents""",
)
def derive_id(spark, sf):
    lang = F.col("lang")
    id_ = F.when(lang == "en", F.col("doc_id").cast("string")).when(lang == "de", F.lit(""))
    other = F.when(lang == "de", F.concat(F.lit("_"), "source")).when(lang == "fr", F.lit(""))
    return ad.table(spark, sf, "documents").select(
        "doc_id", ps.derive_id(F.col("doc_id"), "hotpot_", id_, other).alias("id")
    )


LEVEL_SQL = "CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 THEN 'hard' ELSE 'easy' END"
LABELLED_SQL = f"""labelled AS (SELECT doc_id, nullif(lang, 'en') AS type, {LEVEL_SQL} AS level, text, source
  FROM documents LEFT JOIN labels USING (doc_id))"""


def _labelled(spark, sf) -> DataFrame:
    docs, marks = ad.table(spark, sf, "documents"), ad.table(spark, sf, "labels")
    level = F.when(F.col("quality") == 1, "hard").when(F.col("quality").isNotNull(), "easy")
    return docs.join(marks, "doc_id", "left").select(
        "doc_id", F.nullif("lang", F.lit("en")).alias("type"), level.alias("level"), "text", "source"
    )


@query(
    "passage_metadata",
    f"""WITH {LABELLED_SQL} SELECT doc_id, CAST(json_object('type', coalesce(type, 'unknown'),
    'level', coalesce(level, 'unknown')) AS VARCHAR) AS metadata FROM labelled""",
)
def passage_metadata(spark, sf):
    meta = ps.metadata_default(F.col("type"), F.col("level"))
    return _labelled(spark, sf).select("doc_id", F.to_json(meta).alias("metadata"))


@query(
    "passage_metadata_sparse",
    f"""WITH {LABELLED_SQL} SELECT doc_id, CASE
      WHEN type IS NULL AND level IS NULL THEN NULL
      WHEN type IS NULL THEN CAST(json_object('level', level) AS VARCHAR)
      WHEN level IS NULL THEN CAST(json_object('type', type) AS VARCHAR)
      ELSE CAST(json_object('type', type, 'level', level) AS VARCHAR) END AS metadata FROM labelled""",
)
def passage_metadata_sparse(spark, sf):
    meta = ps.metadata_sparse(F.col("type"), F.col("level"))
    return _labelled(spark, sf).select("doc_id", F.to_json(meta).alias("metadata"))


@query(
    "passage_metadata_qa",
    f"""WITH {LABELLED_SQL} SELECT doc_id, CAST(json_object('question', source, 'answer', '',
    'level', coalesce(level, 'unknown'), 'type', coalesce(type, 'unknown')) AS VARCHAR) AS metadata,
    '{{"source":"hotpot_qa","split":"train"}}' AS source_metadata FROM labelled""",
)
def passage_metadata_qa(spark, sf):
    meta = ps.metadata_qa(F.col("source"), F.lit(None).cast("string"), F.col("type"), F.col("level"))
    return _labelled(spark, sf).select(
        "doc_id", F.to_json(meta).alias("metadata"),
        F.to_json(ps.metadata_source("hotpot_qa", "train")).alias("source_metadata"),
    )
