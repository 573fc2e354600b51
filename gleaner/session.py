"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


@dataclass(frozen=True)
class JobConfig:
    """Parameters of a retrieval job; read on the driver, never shipped as a table."""

    ingest_limit: int | None = None
    top_k: int = 5
    max_context_chars: int | None = None
    embed_width: int = 256
    metric: str = "cosine"
    embedding_model: str = "hash-256"


def local_session(name: str = "gleaner", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local-mode session without the setting gets a folder of its own: a
    machine-local path would lose data on a cluster.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = "file:" + tempfile.mkdtemp(prefix="gleaner-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/gleaner/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; results read from them end with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage without relying on executor-local blocks, and keeps column
    pruning for the readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession, *others: Path) -> None:
    """Send this package, and those in the folders ``others``, to the Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_gleaner_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="gleaner-ship-")) / "gleaner.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for root in (Path(__file__).resolve().parent, *others):
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._gleaner_shipped = True
