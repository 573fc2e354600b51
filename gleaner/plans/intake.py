"""File intake for requests: gate, validate, convert, build content parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import files as fl
from ..operators.models import with_model
from ..operators.ordinals import THIN_KEYS, join_hot


def for_requests(files: DataFrame, requests: DataFrame, batch: str) -> DataFrame:
    """Files with the request of their batch and its model; requests are unique per batch."""
    return join_hot(files, with_model(requests), [batch], ["path"], "inner", thin_keys=THIN_KEYS)


def content_form() -> Column:
    """How a file reaches the model: text, base64, or dropped."""
    kind = F.col("file_type")
    return (
        F.when((kind == "image") & ~F.col("image_support"), F.lit("dropped"))
        .when((kind == "image") | ((kind == "pdf") & F.col("raw_pdf_support")), F.lit("base64"))
        .otherwise(F.lit("text"))
    )


def gate_error(cap: int) -> Column:
    return F.concat(
        F.lit("FATAL ERROR: Total size "), F.col("total_bytes").cast("string"),
        F.lit(f" exceeds max allowed {cap}. Delete some files."),
    )


def file_intake(
    files: DataFrame, requests: DataFrame, batch: str, cap: int = fl.MAX_BATCH_BYTES, strict: bool = False
) -> DataFrame:
    """Every file of a request whose model takes attachments, with ``part`` or ``error``.

    The size gate sums lengths on a scan without ``content``; its verdict is one
    thin row per batch, and contents of rejected batches are not looked at.
    """
    able = with_model(requests).where("supports_file_attachments")
    sums = files.groupBy(batch).agg(F.sum("length").cast("bigint").alias("total_bytes"))
    verdict = able.join(sums, batch).withColumn("accepted", F.col("total_bytes") <= cap)
    joined = join_hot(files, verdict, [batch], ["path"], "inner", thin_keys=THIN_KEYS)
    joined = joined.withColumn("content", F.when(F.col("accepted"), F.col("content")))
    checked = fl.files_to_text(fl.validated(joined, strict))
    text = fl.strip_text(F.col("text"))
    ready = checked.withColumn("text", text)
    usable = F.col("accepted") & F.col("reason").isNull() & (F.length("text") > 0)
    part = F.when(usable, fl.content_part())
    error = (
        F.when(~F.col("accepted"), gate_error(cap))
        .when(F.col("reason").isNotNull(), F.col("reason"))
        .when(part.isNull(), F.lit("not accepted by model"))
    )
    return ready.withColumns({"part": part, "error": error})
