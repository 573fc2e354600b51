"""Approximate nearest neighbours: vectors in coarse cells, a few cells per question.

The cells are folders of a partitioned table, so a search reads only those that
some question probes. One scan serves all questions; inside a cell the comparison
is exact. A cell knows its radius, so no vector of it is nearer to a question than the
centre less the radius: a question is done, certified, when its k-th hit is nearer than
that bound of every cell it has not probed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import fits_width, l2_squared, normalize
from ..session import materialise
from .nearest import top_k


@dataclass(frozen=True)
class CellIndex:
    spark: SparkSession
    path: str
    width: int

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def cells(self) -> DataFrame:
        """``id, vector, radius``: a row for each cell."""
        return self.spark.read.parquet(f"{self.path}/centres")

    def bounds(self, queries: DataFrame) -> DataFrame:
        """``query_id, cell, bound, turn`` for every cell: no vector of it is nearer than ``bound`` to the
        question, both of unit length; turns begin at 1 with the least bound, then the nearest centre."""
        cells = self.cells()
        unit = queries.withColumn("vector", normalize(F.col("vector")))
        near = top_k(cells, unit, cells.count(), self.width, "l2").join(F.broadcast(cells.select("id", "radius")), "id")
        away = F.sqrt("distance")
        bounded = near.select("query_id", F.col("id").alias("cell"), away.alias("away"), F.greatest(away - F.col("radius"), F.lit(0.0)).alias("bound"))
        by = Window.partitionBy("query_id").orderBy("bound", "away", "cell")
        return bounded.withColumn("turn", F.row_number().over(by)).drop("away")

    def _hits(self, queries: DataFrame, probes: DataFrame, k: int) -> DataFrame:
        asked = queries.join(probes.groupBy("query_id").agg(F.collect_list("cell").alias("cells")), "query_id")
        rows = self.rows().join(F.broadcast(probes.select("cell").distinct()), "cell", "left_semi")
        return top_k(rows, asked, k, self.width)

    def search(self, queries: DataFrame, k: int, probe: int, max_probe: int | None = None) -> DataFrame:
        """``query_id, id, distance, rank, certified``: cosine top k per question.

        The first ``probe`` cells in turn give a k-th distance, and then those of the others whose bound is not above it are
        probed, up to turn ``max_probe`` if given. ``certified`` says that no cell left out can hold a
        nearer vector: without ``max_probe`` always, and then the hits are the exact ones.
        """
        bounds = materialise(self.bounds(queries), "cell-bounds")
        first = materialise(self._hits(queries, bounds.where(F.col("turn") <= probe), k).drop("rank"), "first-hits")
        open_cells = materialise(self._within(bounds.where(F.col("turn") > probe), first, k), "open-cells")
        more = open_cells if max_probe is None else open_cells.where(F.col("turn") <= max_probe)
        hits = first.unionByName(self._hits(queries, more, k).drop("rank"))
        by = Window.partitionBy("query_id").orderBy("distance", "id")
        best = materialise(hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k), "hits")
        if max_probe is None:
            return best.withColumn("certified", F.lit(True))
        left = self._within(open_cells.where(F.col("turn") > max_probe), best, k).select("query_id").distinct()
        return best.join(left.withColumn("left", F.lit(True)), "query_id", "left").select(*best.columns, F.col("left").isNull().alias("certified"))

    @staticmethod
    def _within(cells: DataFrame, hits: DataFrame, k: int) -> DataFrame:
        """The ``cells`` that may hold a vector nearer than the k-th of ``hits``; all if there are fewer hits."""
        kth = hits.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("kth"))
        reach = F.sqrt(F.greatest(2 * F.col("kth"), F.lit(0.0))) + F.lit(1e-6)  # of unit vectors
        return cells.join(kth, "query_id", "left").where(F.col("kth").isNull() | (F.col("bound") <= reach)).drop("kth")


def build(
    corpus: DataFrame, path: str, width: int, cells: int, seed: int = 7, max_iter: int = 10,
    fit_rows: int = 1_000_000, file_rows: int = 1_000_000,
) -> CellIndex:
    """Cut ``corpus(id, vector)`` into cells by k-means on unit vectors and write them.

    The centres are as many rows as there are cells, a parameter, and are fitted on a sample of about
    ``fit_rows`` vectors, taken by a hash of the id; every row is indexed. A cell, however large,
    is spread over as many tasks as it has ``file_rows``, each of which writes one file of it.
    """
    spark = corpus.sparkSession
    fit = corpus.where(fits_width(F.col("vector"), width))
    unit = fit.withColumn("features", array_to_vector(normalize(F.col("vector"))))
    total = fit.count()
    chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, fit_rows / max(total, 1)) * (1 << 30))
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, predictionCol="cell").fit(unit.where(chosen).select("features"))
    rows = model.transform(unit).drop("features")
    parts = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / file_rows).alias("__parts"))  # a row for each cell
    salted = rows.join(F.broadcast(parts), "cell").withColumn("__part", F.pmod(F.xxhash64("id"), F.col("__parts")))
    placed = salted.repartition("cell", "__part").drop("__part", "__parts")
    placed.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    table = spark.createDataFrame(centres, "id INT, vector ARRAY<DOUBLE>")
    index = CellIndex(spark, path, width)
    unit = index.rows().select("cell", normalize(F.col("vector")).alias("unit")).join(F.broadcast(table), F.col("cell") == F.col("id"))
    radii = unit.groupBy("id").agg((F.sqrt(F.max(l2_squared(F.col("unit"), F.col("vector")))) + F.lit(1e-9)).alias("radius"))
    # a cell may be empty
    table.join(radii, "id").write.mode("overwrite").parquet(f"{path}/centres")
    return index
