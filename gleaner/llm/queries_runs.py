"""Periodic runs in all documents; every tenth, by a hash of its id, has its end made periodic first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE
from .registry import query, table
from .runs import with_runs


def made_periodic(key: Column, text: Column) -> Column:
    """The text; for one key in ten its words from ``a`` on are replaced by the first ``p`` of them, repeated."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")

    def repeat(given: Column) -> Column:
        h = F.crc32(key.cast("string"))
        g, n = F.floor(h / 10), F.size(given).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get(given, i.cast("int"))), " ")).otherwise(F.lit(""))

    chosen = F.pmod(F.crc32(key.cast("string")), F.lit(10)) == 0
    return F.when(chosen, F.get(F.transform(F.array(words), repeat), 0)).otherwise(text)


@query("op13_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = with_runs(docs, keep_text=False)
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    best = found.withColumn("top", F.array_min(order))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    length = -F.col("top.l")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.s").alias("start"), length.alias("length"),
        F.col("top.p").alias("period"), F.floor(1000 * length / F.col("top.p")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
