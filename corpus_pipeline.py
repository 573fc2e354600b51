"""From documents to training shards: quality, near-duplicates, benchmark passages, mixing, sharding.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last one adds
the shards. A mixed corpus holds a document once for each time it is taken, in training order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm.decontaminate import benchmark_hits
from gleaner.llm.kneser_ney import score_quality
from gleaner.llm.mixing import mix
from gleaner.llm.packing import assign_shards
from gleaner.llm.registry import table
from gleaner.llm.simhash import near_duplicates
from gleaner.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above their language's threshold."""
    return score_quality(docs, table(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at three bits or fewer, that with the least id."""
    return near_duplicates(docs).where("representative").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return benchmark_hits(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for, sorted by training position."""
    return mix(docs).select(docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot there."""
    return assign_shards(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-duplicates", near_duplicate_groups),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]
#: The classifier and the fingerprints are beyond SQL; tests/llm/test_pipeline.py holds run() against plain versions of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
