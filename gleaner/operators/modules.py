"""Imported modules over a tree of source lines ``path, line``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, import_name

# Path fragments skipped unless the caller says otherwise.
EXCLUDED = ("scratch", "__pycache__", ".gitignore", ".yaml", "__init__.py")


def excluded(path: Column, fragments: Sequence[str] = EXCLUDED) -> Column:
    return contains_any(path, fragments)


def processed_and_skipped(paths: DataFrame, fragments: Sequence[str] = EXCLUDED) -> DataFrame:
    """Each path with its status, from one scan."""
    status = F.when(excluded(F.col("path"), fragments), F.lit("skipped")).otherwise(F.lit("processed"))
    return paths.select("path", status.alias("status"))


def distinct_modules(lines: DataFrame, fragments: Sequence[str] = EXCLUDED) -> DataFrame:
    kept = lines.where(~excluded(F.col("path"), fragments))
    return kept.select(import_name(F.col("line")).alias("module")).where("module IS NOT NULL").distinct()
