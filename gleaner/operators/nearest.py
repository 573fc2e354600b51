"""k nearest vectors for a whole table of questions, exact.

Corpus rows stay in their scan partitions. Each task compares Arrow batches with
a block of question vectors by a matrix product and keeps k rows per question, so
only those are shuffled; pairs are never emitted. A question table within a
checked size travels as a broadcast block; a larger one is cut into such blocks, which
pass over the corpus one after the other. No corpus row ever moves.

Rows of a batch are gathered around the nearest of a few pivots. A question whose k-th hit is
nearer than any row of a gathering can be, by the triangle inequality, passes it over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

MAX_BROADCAST_ROWS = 20_000
MAX_BROADCAST_BYTES = 64 << 20
_PAIR_BLOCK = 1 << 15
_QUERY_BLOCK = 512
# Pivots that gather the rows of a batch; batches of fewer rows are compared as a whole.
PIVOTS = 8
_GATHER_ROWS = 1024


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Dense float64 rows of a list or sparse-struct column, and the usable row numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = ~np.asarray(column.is_null())
    sparse = pa.types.is_struct(column.type)
    if not sparse:
        valid &= pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == width
    rows = np.flatnonzero(valid)
    kept = pc.take(column, pa.array(rows))
    out = np.zeros((len(rows), width))
    if not len(rows):
        return out, rows
    if sparse:
        lengths = pc.list_value_length(kept.field("values")).to_numpy(zero_copy_only=False)
        at = np.repeat(np.arange(len(rows)), lengths)
        idx = pc.list_flatten(kept.field("indices")).to_numpy(zero_copy_only=False)
        out[at, idx] = pc.list_flatten(kept.field("values")).to_numpy(zero_copy_only=False)
    else:
        flat = pc.list_flatten(kept).to_numpy(zero_copy_only=False)
        out[:] = flat.astype(np.float64).reshape(len(rows), width)
    good = np.isfinite(out).all(axis=1)
    return out[good], rows[good]


def _fold(a: np.ndarray) -> np.ndarray:
    """Row sums added left to right: the same order for every row and every engine."""
    total = np.zeros(a.shape[0])
    for column in np.ascontiguousarray(a.T):
        total += column
    return total


def _fewest_copies(x: np.ndarray, ids: pa.Array, k: int) -> np.ndarray:
    """Row numbers left when of equal vectors only the k smallest ids stay.

    Further copies cannot be hits: they are as far away and lose the tie.
    """
    whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, group = np.unique(whole, return_inverse=True)
    pairs = pa.table({"group": group, "id": ids})
    order = pc.sort_indices(pairs, sort_keys=[("group", "ascending"), ("id", "ascending")]).to_numpy()
    sorted_groups = group[order]
    place = np.arange(len(order)) - np.searchsorted(sorted_groups, sorted_groups, side="left")
    return np.sort(order[place < k])


def _exact(q: np.ndarray, x: np.ndarray, nq: np.ndarray, nx: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return 1.0 - _fold(q * x) / np.sqrt(nq * nx)
    return _fold((q - x) ** 2)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` from the few rows of ``b``."""
    return np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2.0 * (a @ b.T), 0.0))


class _Best:
    """The k nearest rows per question seen so far in one task."""

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        self.q, self.k, self.metric = queries, k, metric
        self.nq = _fold(queries**2)
        self.kth = np.full(len(queries), np.inf)
        self.table: pa.Table | None = None
        self.compared = 0

    def add(self, x: np.ndarray, ids: pa.Array, which: np.ndarray) -> None:
        """Compare corpus rows with the questions numbered ``which``, gathered around pivots if there are many."""
        nx = _fold(x**2)
        if self.metric == "cosine":
            keep = np.flatnonzero(nx > 0)
            x, nx, ids = x[keep], nx[keep], pc.take(ids, pa.array(keep))
        if not len(x):
            return
        parts = [] if self.table is None else [self.table]
        for rows, asking in self._gathered(x, nx, which) if len(x) >= _GATHER_ROWS else [(slice(None), which)]:
            own = ids if isinstance(rows, slice) else pc.take(ids, pa.array(rows))
            for at in range(0, len(asking), _QUERY_BLOCK):
                parts += self._candidates(asking[at : at + _QUERY_BLOCK], x[rows], nx[rows], own)
        if parts:
            self._shrink(pa.concat_tables(parts))

    def _gathered(self, x, nx, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows around each pivot, and those questions that may have a hit among them.

        No row is nearer to a question than the question to the pivot, less the radius. Cosine distances
        are half the squared distances of unit vectors.
        """
        unit = self.metric == "cosine"
        scaled = x / np.sqrt(nx)[:, None] if unit else x
        asked = self.q[which] / np.sqrt(self.nq[which])[:, None] if unit else self.q[which]
        pivots = scaled[:: -(-len(x) // PIVOTS)]  # any rows do: they change the work, not the hits
        away = _apart(scaled, pivots)
        nearest = away.argmin(axis=1)
        far = _apart(asked, pivots)
        slack = 1e-6 * (1.0 + np.abs(scaled).max() + np.abs(asked).max())
        for p in range(len(pivots)):
            rows = np.flatnonzero(nearest == p)
            if len(rows):
                bound = np.maximum(far[:, p] - away[rows, p].max() - slack, 0.0) ** 2 / (2.0 if unit else 1.0)
                yield rows, which[bound <= self.kth[which]]

    def _candidates(self, which: np.ndarray, x, nx, ids) -> list[pa.Table]:
        """Rows within rounding of the k nearest, with their exact distances."""
        q, nq = self.q[which], self.nq[which]
        self.compared += len(which) * len(x)
        near = q @ x.T
        if self.metric == "cosine":
            near = 1.0 - near / np.sqrt(nq)[:, None] / np.sqrt(nx)[None, :]
            slack = np.full(len(which), 1e-9)
        else:
            near = nq[:, None] + nx[None, :] - 2.0 * near
            slack = 1e-9 * (1.0 + nq + nx.max())
        k = min(self.k, len(x))
        bound = np.partition(near, k - 1, axis=1)[:, k - 1] if len(x) >= self.k else np.full(len(which), np.inf)
        bound = np.minimum(bound, self.kth[which]) + slack
        qi, xi = np.nonzero(near <= bound[:, None])
        if len(qi) > 4 * self.k * len(which) + _PAIR_BLOCK // 8:
            few = np.zeros(len(x), dtype=bool)
            few[_fewest_copies(x, ids, self.k)] = True
            qi, xi = qi[few[xi]], xi[few[xi]]
        out = []
        for s in range(0, len(qi), _PAIR_BLOCK):
            a, b = qi[s : s + _PAIR_BLOCK], xi[s : s + _PAIR_BLOCK]
            exact = _exact(q[a], x[b], nq[a], nx[b], self.metric)
            out.append(
                pa.table({"q": pa.array(which[a], pa.int64()), "distance": exact, "id": pc.take(ids, pa.array(b))})
            )
        return out

    def _shrink(self, table: pa.Table) -> None:
        order = pc.sort_indices(
            table, sort_keys=[("q", "ascending"), ("distance", "ascending"), ("id", "ascending")]
        )
        table = table.take(order)
        q = table["q"].to_numpy()
        first = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - first < self.k
        self.table = table.filter(pa.array(keep)).combine_chunks()
        kept_q = self.table["q"].to_numpy()
        counts = np.bincount(kept_q, minlength=len(self.q))
        ends = np.cumsum(counts) - 1
        full = counts >= self.k
        self.kth[full] = self.table["distance"].to_numpy()[ends[full]]


def _hits(best: _Best, query_ids: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if best.table is not None:
        t = pa.table(
            [pc.take(query_ids, best.table["q"].combine_chunks()), best.table["id"], best.table["distance"]],
            names=["query_id", "id", "distance"],
        )
        yield from t.cast(schema).combine_chunks().to_batches()


class _Questions:
    """A block of question vectors, and which of them ask which cell."""

    def __init__(self, table: pa.Table, width: int, metric: str):
        q, rows = _matrix(table["vector"], width)
        if metric == "cosine":
            some = (q != 0).any(axis=1)
            q, rows = q[some], rows[some]
        kept = table.take(pa.array(rows)).combine_chunks()
        self.vectors = q
        self.ids = kept["query_id"].combine_chunks()
        self.by_cell: dict[int, np.ndarray] | None = None
        if "cells" in table.column_names:
            cells = kept["cells"].combine_chunks()
            owner = np.repeat(np.arange(len(q)), pc.list_value_length(cells).to_numpy(zero_copy_only=False))
            flat = pc.list_flatten(cells).to_numpy(zero_copy_only=False)
            self.by_cell = {int(c): owner[flat == c] for c in np.unique(flat)}

    def scan(self, batches: Iterator[pa.RecordBatch], k: int, metric: str) -> _Best:
        best = _Best(self.vectors, k, metric)
        everyone = np.arange(len(self.vectors))
        for batch in batches:
            x, rows = _matrix(batch.column("vector"), self.vectors.shape[1])
            if not len(everyone) or not len(rows):
                continue
            ids = pc.take(batch.column("id"), pa.array(rows))
            if self.by_cell is None:
                best.add(x, ids, everyone)
                continue
            cell = np.asarray(batch.column("cell"))[rows]
            for c in np.unique(cell):
                asking = self.by_cell.get(int(c))
                if asking is not None:
                    at = np.flatnonzero(cell == c)
                    best.add(x[at], pc.take(ids, pa.array(at)), asking)
        return best


def _schemas(corpus: DataFrame, queries: DataFrame) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    spark_schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    return spark_schema, to_arrow_schema(spark_schema)


def _rank(hits: DataFrame, k: int) -> DataFrame:
    """Final k per question; the planner cuts each partition to k before the shuffle."""
    by = Window.partitionBy("query_id").orderBy("distance", "id")
    return hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def top_k(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    width: int,
    metric: str = "cosine",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows ``query_id, id, distance, rank``: the k nearest corpus rows per question.

    ``corpus(id, vector)`` and ``queries(query_id, vector)``; a vector is an array
    or a sparse struct. Ties go to the smaller id. Rows whose vector is NULL, of
    another width, or (cosine) all zero are never hits. With a column ``cell`` in
    the corpus and ``cells`` (array) in the questions, a question sees only rows of
    its cells.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric: {metric}")
    by_cell = "cell" in corpus.columns and "cells" in queries.columns
    corpus = corpus.select("id", "vector", *(["cell"] if by_cell else []))
    queries = queries.select("query_id", "vector", *(["cells"] if by_cell else []))
    row_bound = min(max_broadcast_rows, max(1, MAX_BROADCAST_BYTES // (8 * width)))
    sample = queries.limit(row_bound + 1).toArrow()
    if sample.num_rows <= row_bound:
        return _rank(_broadcast_hits(corpus, queries, sample, k, width, metric), k)
    return _block_hits(corpus, queries, k, width, metric, max(row_bound, 1))


def _broadcast_hits(corpus, queries, table: pa.Table, k: int, width: int, metric: str) -> DataFrame:
    spark_schema, arrow_schema = _schemas(corpus, queries)
    shared = corpus.sparkSession.sparkContext.broadcast(_Questions(table, width, metric))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        yield from _hits(asked.scan(batches, k, metric), asked.ids, arrow_schema)

    return corpus.mapInArrow(scan, spark_schema)


def _block_hits(corpus: DataFrame, queries: DataFrame, k: int, width: int, metric: str, block_rows: int) -> DataFrame:
    """Ranked hits of any number of questions, a block of about ``block_rows`` after the other.

    Blocks are cut by a hash of the question's id. Each is fetched, broadcast, and its hits written
    before the next one, so no more than one is held anywhere; the corpus is scanned once per block and not shuffled.
    """
    blocks = -(-queries.count() // block_rows) or 1
    number = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("__block")
    asked = materialise(queries.select("*", number), "questions")
    done = []
    for b in range(blocks):
        table = asked.where(F.col("__block") == b).drop("__block").toArrow()
        done.append(materialise(_rank(_broadcast_hits(corpus, queries, table, k, width, metric), k), "hits"))
    return reduce(DataFrame.unionByName, done)


def attach_documents(
    hits: DataFrame, corpus: DataFrame, queries: DataFrame, k: int, *columns: str, max_rows: int = 500_000
) -> DataFrame:
    """Hits with the named corpus columns.

    There are at most k hits per question, so a count of the (small) question table
    bounds them: within ``max_rows`` the thin hits are broadcast and the corpus
    stays where it is, beyond it both sides are joined by a shuffle on the unique id.
    """
    few = queries.limit(max_rows // k + 1).count() <= max_rows // k
    side = F.broadcast(hits) if few else hits
    return corpus.select("id", *columns).join(side, "id").select("query_id", "rank", "id", "distance", *columns)
