"""Token files of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from .registry import query, table
from .token_files import read_tokens, write_tokens


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
