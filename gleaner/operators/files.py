"""File intake: describe, validate, convert, and build content parts.

``files``: ``path, length, content`` as read by the ``binaryFile`` source.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import base_name, file_extension, line_count, size_mb, strip_text, to_base64
from .models import with_file_type
from .ordinals import with_key_totals

# Limits.
MAX_BATCH_BYTES = 20 * 1024 * 1024
CONFIDENCE_NEEDED = 0.6

# Leading bytes (hex), MIME type and confidence.
MAGIC = [
    ("89504E470D0A1A0A", "image/png", 0.9),
    ("FFD8FF", "image/jpeg", 0.8),
    ("47494638", "image/gif", 0.8),
    ("25504446", "application/pdf", 0.9),
    ("504B0304", "application/zip", 0.8),
    ("424D", "image/bmp", 0.6),
    ("49492A00", "image/tiff", 0.8),
    ("4D4D002A", "image/tiff", 0.8),
]
OFFICE_ZIP = ("ms-wordx", "ms-excelx")

PART = "struct<type:string,text:string,source_type:string,mime_type:string,data:string>"


def file_info(files: DataFrame) -> DataFrame:
    path, n = F.col("path"), F.col("length").cast("bigint")
    return files.withColumns(
        {
            "name": base_name(path),
            "size_bytes": n,
            "size_mb": size_mb(n),
            "extension": file_extension(path),
        }
    )


def sniff(files: DataFrame) -> DataFrame:
    """Confidence of text and of binary content, from validity and leading bytes."""
    content = F.col("content")
    head = F.hex(F.substring(content, 1, 8))
    mime, conf = F.lit(None).cast("string"), F.lit(0.0)
    for prefix, name, c in reversed(MAGIC):
        hit = F.startswith(head, F.lit(prefix))
        mime, conf = F.when(hit, F.lit(name)).otherwise(mime), F.when(hit, F.lit(c)).otherwise(conf)
    as_text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
    ascii_only = F.octet_length(content) == F.length(as_text)
    encoding = F.when(F.octet_length(content) == 0, F.lit(None)).when(ascii_only, F.lit("ascii")).when(
        as_text.isNotNull(), F.lit("utf-8")
    )
    text_conf = F.when(encoding.isNull(), 0.0).when(ascii_only, 1.0).otherwise(0.99)
    # A recognised binary signature outweighs bytes that merely happen to be readable.
    return files.withColumns(
        {
            "bin_mime": mime,
            "bin_conf": conf,
            "encoding": encoding,
            "text_conf": F.when(conf > 0, F.lit(0.0)).otherwise(text_conf),
        }
    )


def actual_mime() -> Column:
    """Text when its confidence is not below the binary one, else the binary type."""
    text = (F.col("text_conf") >= F.col("bin_conf")) & F.col("encoding").isNotNull()
    return F.when(text, F.concat(F.lit("text/"), F.col("encoding"))).otherwise(F.col("bin_mime"))


def confident(threshold: float = CONFIDENCE_NEEDED) -> Column:
    return F.coalesce(
        actual_mime().isNotNull() & (F.greatest("text_conf", "bin_conf") >= threshold), F.lit(False)
    )


def matches_extension(strict: bool = False) -> Column:
    """Major type from the extension equals the detected one.

    Text under an ``application/*`` or ``image/*`` guess passes unless ``strict``,
    as do office files, which are zip archives.
    """
    major = F.split_part(F.col("mime_type"), F.lit("/"), F.lit(1))
    same = F.col("mime_type").isNull() | F.startswith(actual_mime(), major)
    if not strict:
        readable = (F.col("file_type") == "text") | (F.col("extension") == ".svg")
        same = same | (readable & F.startswith(actual_mime(), F.lit("text/")))
    return F.coalesce(same, F.lit(False))


def invalid_reason(strict: bool = False, threshold: float = CONFIDENCE_NEEDED) -> Column:
    """First rule a file breaks, NULL when it is valid."""
    path = F.col("path")
    return (
        F.when(~F.col("exists"), F.concat(F.lit("File not found: "), path))
        .when(~F.col("is_file"), F.concat(F.lit("Path is not a file: "), path))
        .when(F.col("size_bytes") <= 0, F.concat(F.lit("File is empty: "), path))
        .when(F.col("file_type").isNull(), F.concat(F.lit("Unsupported file type: "), F.col("extension")))
        .when(
            ~(confident(threshold) & matches_extension(strict)),
            F.concat(F.lit("Invalid file content for: "), path),
        )
    )


def validated(files: DataFrame, strict: bool = False) -> DataFrame:
    """Files with type, confidences and ``reason``."""
    return sniff(with_file_type(file_info(files))).withColumn("reason", invalid_reason(strict))


def size_gate(files: DataFrame, batch: str, cap: int = MAX_BATCH_BYTES) -> DataFrame:
    """Add the batch total and whether the whole batch is accepted.

    Run it on a scan without ``content``: only the lengths are summed.
    """
    totals = with_key_totals(files, [batch], ["path"], total_bytes=F.sum("length").cast("bigint"))
    return totals.withColumn("accepted", F.col("total_bytes") <= cap)


def best_mime(candidates: DataFrame) -> DataFrame:
    """MIME type of highest confidence per path; the first wins ties, none when all are 0."""
    rank = F.struct("conf", (-F.col("pos")).alias("neg"))
    best = F.max_by("mime", F.when(F.col("conf") > 0, rank))
    top = F.coalesce(F.max(F.when(F.col("conf") > 0, F.col("conf"))), F.lit(0.0))
    return candidates.groupBy("path").agg(best.alias("mime"), top.alias("conf"))


WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Most bytes of a docx's main part that are unpacked.
DOCX_BYTES = 64 * 1024 * 1024


def _docx_text(data: bytes, most: int = DOCX_BYTES) -> str | None:
    """Paragraph texts joined by newline; NULL when the archive cannot be read or unpacks to more than ``most`` bytes.

    The size is taken from the archive's directory, beyond which the reader does not go. Paragraphs are
    pulled from the stream one by one and dropped behind their end.
    """
    marks = {f"{WORD}t": None, f"{WORD}tab": "\t", f"{WORD}br": "\n"}
    out, above = [], []
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            if z.getinfo("word/document.xml").file_size > most:
                return None
            with z.open("word/document.xml") as part:
                for event, node in ElementTree.iterparse(part, ("start", "end")):
                    if event == "start":
                        above.append(node)
                        continue
                    above.pop()
                    if len(above) == 2 and above[1].tag == f"{WORD}body":
                        if node.tag == f"{WORD}p":
                            out.append("".join((marks[n.tag] or n.text or "") for n in node.iter() if n.tag in marks))
                        above[1].remove(node)
    except (zipfile.BadZipFile, zlib.error, KeyError, EOFError, NotImplementedError, RuntimeError, ElementTree.ParseError):
        return None
    return "\n".join(out)


def docx_text(content: Column, most: int = DOCX_BYTES) -> Column:
    @F.pandas_udf(StringType())
    def read(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in frames:
            yield s.map(lambda b: None if b is None else _docx_text(b, most))

    return read(content)


def files_to_text(files: DataFrame, docx_bytes: int = DOCX_BYTES) -> DataFrame:
    """Add ``text, encoding_out, line_count``: decoded text, docx paragraphs or base64.

    Only docx bytes go to Python workers; other rows send NULL there. A docx that is broken or unpacks to more
    than ``docx_bytes`` has no text.
    """
    content, kind = F.col("content"), F.col("file_type")
    decoded = F.try_validate_utf8(content.cast("string"))
    word = docx_text(F.when(kind == "ms-wordx", content), docx_bytes)
    text = (
        F.when(kind == "text", decoded)
        .when(kind.isin("pdf", "image"), to_base64(content))
        .when(kind == "ms-wordx", F.col("__docx"))
    )
    return (
        files.withColumn("__docx", word)
        .withColumn("text", text)
        .drop("__docx")
        .withColumn("encoding_out", F.when((kind == "text") & F.col("text").isNotNull(), F.lit("utf-8")))
        .withColumn("line_count", F.when(kind == "text", line_count(F.col("text"))))
    )


def file_metadata(extra: Column | None = None) -> Column:
    """Type, MIME, content length and file facts as one map; later keys win."""
    base = F.create_map(
        F.lit("file_type"), F.col("file_type"),
        F.lit("mime_type"), F.col("mime_type"),
        F.lit("content_length"), F.length("text").cast("string"),
        F.lit("name"), F.col("name"),
        F.lit("size_bytes"), F.col("size_bytes").cast("string"),
        F.lit("size_mb"), F.col("size_mb").cast("string"),
        F.lit("extension"), F.col("extension"),
    )
    if extra is None:
        return base
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(extra, k))
    return F.map_concat(kept, extra)


def nonempty_content(files: DataFrame) -> DataFrame:
    return files.where(F.length("text") > 0).withColumn("text", strip_text(F.col("text")))


def content_part() -> Column:
    """The content part of a converted file; NULL when the model cannot take it."""
    kind, text = F.col("file_type"), F.col("text")
    none = F.lit(None).cast("string")

    def part(type_: str, text_: Column, source: Column, mime: Column, data: Column) -> Column:
        return F.struct(
            F.lit(type_).alias("type"), text_.alias("text"), source.alias("source_type"),
            mime.alias("mime_type"), data.alias("data"),
        ).cast(PART)

    return (
        F.when(kind.isin("text", "ms-wordx"), part("text", text, none, none, none))
        .when(
            (kind == "pdf") & F.col("raw_pdf_support"),
            part("file", none, F.lit("base64"), F.lit("application/pdf"), text),
        )
        .when(
            (kind == "image") & F.col("image_support"),
            part("image", none, F.lit("base64"), F.lit("image/jpeg"), text),
        )
    )
