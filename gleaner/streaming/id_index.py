"""Which ids were stored already: a membership index by hash bucket, for streams.

Ids lie in folders by batch and bucket. Beside them each batch leaves one table of marks: a bit for every id
of its own and all earlier batches, a fixed number of 64-bit words per bucket (a Bloom filter of one hash per bucket).
A batch looks at the marks first and opens only the buckets in which some of its ids may
be known; new ids rarely open any. Every answer is exact: marks only tell where to look.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.collection import path_missing


@dataclass(frozen=True)
class IdIndex:
    """``buckets * words`` rows of marks at most: 262,144 by default, 4 MB, so they are broadcast. Beyond some four million
    ids raise ``words``: marks that are mostly set open buckets for nothing."""

    path: str
    buckets: int = 256
    words: int = 1024

    def _places(self, id_: Column) -> list[Column]:
        h = F.xxhash64(id_)
        inside = F.pmod(F.shiftright(h, 16), F.lit(self.words * 64))
        return [
            F.pmod(h, F.lit(self.buckets)).cast("int").alias("bucket"), F.shiftright(inside, 6).cast("int").alias("word"),
            F.pmod(inside, F.lit(64)).cast("int").alias("bit"),
        ]

    def marks(self, spark: SparkSession, before: int) -> DataFrame | None:
        """``bucket, word, marks`` of all batches before ``before``; None when there is none."""
        schema = "bucket int, word int, marks long, batch_id long"
        try:
            rows = spark.read.schema(schema).option("basePath", f"{self.path}/marks").parquet(f"{self.path}/marks/batch_id=*")
        except AnalysisException as e:
            if not path_missing(e):
                raise
            return None
        last = rows.where(F.col("batch_id") < before).agg(F.max("batch_id")).first()[0]
        return None if last is None else rows.where(F.col("batch_id") == last).drop("batch_id")

    def known(self, spark: SparkSession, before: int, buckets: list[int], column: T.StructField) -> DataFrame:
        """The ids of batches before ``before`` in ``buckets``; no other file is read."""
        schema = T.StructType([column, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])
        wanted = f"{self.path}/ids/batch_id=*/bucket={{{','.join(map(str, buckets))}}}"
        rows = spark.read.schema(schema).option("basePath", f"{self.path}/ids").parquet(wanted)
        return rows.where(F.col("batch_id") < before).select(column.name)

    def buckets_to_open(self, rows: DataFrame, before: int) -> list[int]:
        """Buckets in which some id of ``rows`` may be known."""
        marks = self.marks(rows.sparkSession, before)
        if marks is None:
            return []
        asked = rows.select(*self._places(F.col("id"))).join(F.broadcast(marks), ["bucket", "word"])
        hit = F.call_function("shiftright", F.col("marks"), F.col("bit")).bitwiseAND(F.lit(1)) == 1
        return sorted(r[0] for r in asked.where(hit).select("bucket").distinct().collect())

    def unknown(self, rows: DataFrame, before: int) -> DataFrame:
        """The rows whose ``id`` no batch before ``before`` has stored."""
        buckets = self.buckets_to_open(rows, before)
        if not buckets:
            return rows
        return rows.join(self.known(rows.sparkSession, before, buckets, rows.schema["id"]), "id", "left_anti")

    def add(self, ids: DataFrame, batch_id: int) -> None:
        """Store the ``id`` column of a batch, and the marks of this and all earlier batches. Run again, it replaces both."""
        own = ids.select("id", *self._places(F.col("id")))
        own.select("id", "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path}/ids/batch_id={batch_id}"
        )
        new = own.select("bucket", "word", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")).alias("marks"))
        old = self.marks(ids.sparkSession, batch_id)
        both = new if old is None else new.unionByName(old)
        merged = both.groupBy("bucket", "word").agg(F.bit_or("marks").alias("marks"))
        merged.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/batch_id={batch_id}")
