"""Table-backed vector collections ``id, document, vector, metadata``.

A collection is a folder of Parquet tables and numbered versions. A version is a small file that names the
tables, their schema and the settings (metric, model, width). A writer first writes its table, which no version
names yet, and then the next version, put in place by one rename: whatever fails before leaves the old version as
it was, and a reader stays on the version that it opened. One writer at a time; a second one is told so.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.vectors import fits_width
from ..operators.ordinals import with_late_position


def path_missing(error: AnalysisException) -> bool:
    """Whether nothing is stored at a path, as against any other reason not to read it."""
    return (error.getCondition() or "") == "PATH_NOT_FOUND"


@dataclass(frozen=True)
class Version:
    """What a version's file says."""

    number: int
    metric: str
    model: str
    width: int
    schema: StructType
    tables: tuple[str, ...]


@dataclass(frozen=True)
class Collection:
    path: str
    metric: str = "cosine"
    model: str = "hash-256"
    width: int = 256

    def check(self, model: str, metric: str, width: int) -> None:
        """Questions must be embedded and compared as the collection was."""
        self._differ((self.model, self.metric, self.width), (model, metric, width))

    def check_stored(self, spark: SparkSession) -> None:
        """The settings on disk, where there are any, must be those of this object."""
        held = self.version(spark)
        if held is not None:
            self._differ((held.model, held.metric, held.width), (self.model, self.metric, self.width))

    @staticmethod
    def _differ(held: tuple, asked: tuple) -> None:
        if held != asked:
            raise ValueError(f"collection holds {'/'.join(map(str, held))}, asked with {'/'.join(map(str, asked))}")

    def version(self, spark: SparkSession) -> Version | None:
        """The newest version; None where there is none."""
        folder, fs = self._folder(spark, "versions")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        done = [n for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not done:
            return self._unversioned(spark)
        text = spark.read.text(f"{self.path}/versions/{max(done)}", wholetext=True).first()[0]
        held = json.loads(text)
        schema = StructType.fromJson(held["schema"])
        return Version(int(max(done)[:-5]), held["metric"], held["model"], held["width"], schema, tuple(held["tables"]))

    def _unversioned(self, spark: SparkSession) -> Version | None:
        """A collection from before there were versions: tables ``rows`` and ``settings``."""
        rows, fs = self._folder(spark, "rows")
        if not fs.exists(rows):
            return None
        settings, _ = self._folder(spark, "settings")
        held = spark.read.parquet(f"{self.path}/settings").first() if fs.exists(settings) else None
        metric, model, width = (held["metric"], held["model"], held["width"]) if held else (self.metric, self.model, self.width)
        return Version(0, metric, model, width, spark.read.parquet(f"{self.path}/rows").schema, ("rows",))

    def _folder(self, spark: SparkSession, name: str) -> tuple:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _commit(self, spark: SparkSession, after: Version | None, schema: StructType, tables: list[str]) -> None:
        """Put the version behind ``after`` in place."""
        says = {"metric": self.metric, "model": self.model, "width": self.width, "schema": schema.jsonValue(), "tables": tables}
        target, fs = self._folder(spark, f"versions/{(after.number if after else 0) + 1:010d}.json")
        draft, _ = self._folder(spark, f"versions/_{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(says).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"another writer changed the collection at {self.path}")

    def _write(self, rows: DataFrame, max_records_per_file: int = 1_000_000) -> str:
        name = f"rows-{uuid.uuid4().hex}"
        rows.write.option("maxRecordsPerFile", max_records_per_file).parquet(f"{self.path}/{name}")
        return name

    def create(self, spark: SparkSession, empty: DataFrame) -> None:
        """Replace: start empty with these settings."""
        self._commit(spark, self.version(spark), empty.schema, [])

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the newest version, also after later ones."""
        held = self.version(spark)
        if held is None:
            raise ValueError(f"no collection at {self.path}")
        if not held.tables:
            return spark.createDataFrame([], held.schema)
        return spark.read.schema(held.schema).parquet(*[f"{self.path}/{t}" for t in held.tables])

    def exists(self, spark: SparkSession) -> bool:
        return self.version(spark) is not None

    def drop_unused(self, spark: SparkSession) -> None:
        """Delete the tables that the newest version does not name; readers of older ones end with them."""
        held = self.version(spark)
        root, fs = self._folder(spark, "")
        for file in fs.listStatus(root) if held else ():
            name = file.getPath().getName()
            if name.startswith("rows-") and name not in held.tables:
                fs.delete(file.getPath(), True)

    def append_counted(self, rows: DataFrame, valid: Column) -> dict[str, int]:
        """Append the rows that are ``valid``; ``uploaded, valid, skipped`` are counted by the write itself.

        A null condition skips a row.
        """
        counts = Observation()
        good = F.coalesce(valid, F.lit(False))
        self.append(
            rows.observe(
                counts, F.count(F.lit(1)).alias("uploaded"), F.count_if(good).alias("valid"), F.count_if(~good).alias("skipped")
            ).where(good)
        )
        return dict(counts.get)

    def append(self, rows: DataFrame, max_records_per_file: int = 1_000_000) -> None:
        spark = rows.sparkSession
        held = self.version(spark)
        table = self._write(rows, max_records_per_file)
        self._commit(spark, held, held.schema if held else rows.schema, [*(held.tables if held else ()), table])

    def replace(self, rows: DataFrame) -> None:
        held = self.version(rows.sparkSession)
        self._commit(rows.sparkSession, held, rows.schema, [self._write(rows)])

    def fill_if_empty(self, rows: DataFrame) -> bool:
        """Ingest only into an empty collection; tells whether it did."""
        spark = rows.sparkSession
        self.check_stored(spark)
        if not self.exists(spark):
            self.create(spark, rows)
        if not self.read(spark).isEmpty():
            return False
        self.append(rows)
        return True

    def append_new(self, rows: DataFrame) -> None:
        """Add the rows whose id is not there yet, one per id: that whose contents have the least hash."""
        spark = rows.sparkSession
        self.check_stored(spark)
        if not self.exists(spark):
            self.create(spark, rows)
        known = self.read(spark).select("id")
        whole = F.struct(*rows.columns)
        one = rows.groupBy("id").agg(F.min_by(whole, F.md5(F.to_json(whole))).alias("row")).select("row.*")
        self.append(one.join(known, "id", "left_anti").select(rows.columns))


def open_collection(spark: SparkSession, path: str) -> Collection:
    held = Collection(path).version(spark)
    if held is None:
        raise ValueError(f"no collection at {path}")
    return Collection(path, held.metric, held.model, held.width)


def flat_index(df: DataFrame, order: list[str], width: int | None = None) -> tuple[DataFrame, int]:
    """``pos, vector`` and the other columns: positions 0..n-1 and one checked width.

    The width comes from the first vector in order; another width is an error.
    """
    if width is None:
        first = df.where("vector IS NOT NULL").orderBy(*order).select(F.size("vector")).first()
        width = first[0] if first else 0
    wrong = F.format_string("vector is not %d wide", F.lit(width))
    checked = df.withColumn(
        "vector",
        F.when(fits_width(F.col("vector"), width), F.col("vector").cast("array<float>")).otherwise(
            F.raise_error(wrong).cast("array<float>")
        ),
    )
    return with_late_position(checked, order), width


def batch_numbers(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``batch, batches``: batch k of n for each row in ``order``, a unique one."""
    n = df.select(*order).count()
    placed = with_late_position(df, order, "__pos")
    return placed.select(
        *df.columns,
        (F.floor(F.col("__pos") / size) + 1).cast("bigint").alias("batch"),
        F.lit(-(-n // size)).cast("bigint").alias("batches"),
    )
