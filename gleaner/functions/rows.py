"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest_rows(df: DataFrame, array: Column | str, pos: str, item: str, *keep: Column | str) -> DataFrame:
    """One row per element with its position; a missing or empty array gives none.

    The outer form is used on purpose: for the inner one the optimizer adds a
    filter on the array's size, which works out a costly array a second time.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, item)).where(F.col(pos).isNotNull())
    return rows.withColumn(pos, F.col(pos).cast("bigint"))
