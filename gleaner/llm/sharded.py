"""A Kneser-Ney model of any size, and the log-probabilities of all texts under it.

With a word's probability written as a product over the orders that know it, a text's log-probability is
a constant for each token and a sum of weights, one for each word, pair and triple of the text that the model holds:

- a word: log P1(word) - log P1(unknown) + log gamma2(word)
- a pair: log(1 + alpha2 / (gamma2 P1)) + log gamma3(pair)
- a triple: log(1 + alpha3 / (gamma3 P2))

where gamma is what a context leaves to the lower order (1 if it was never seen). Words are 64-bit hashes. The weights are made in
slices by the triple's middle word, which also cut the counts of contexts and of pairs whole, and stored in buckets by
key. The documents, in slices too, send their keys to the buckets, packed for many documents in one row, and sums come back. The
number of slices is bounded, so work grows with the input; they only keep what is on disk at a time small.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from ..sources.corpus import file_store

#: Slices of the model and of the documents at most, characters that make a slice, n-grams of a bucket, bytes of texts packed at a time.
MODEL_SLICES, DOC_SLICES, SLICE_CHARS, BUCKET_GRAMS, PACK_BYTES = 8, 12, 8_000_000, 1_000_000, 4 << 20
ASKS = "src string, bucket long, keys binary, docs binary, times binary, ids binary"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _swept(spark: SparkSession):
    """Shuffle files go as soon as the query that made them ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words, each text between two starts and an end, and their numbers."""
    words = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False))
    flat = words.flatten()
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    coded = pc.dictionary_encode(flat)
    hashes = _hash(coded.dictionary.to_numpy(zero_copy_only=False))
    n = np.bincount(doc[real], minlength=len(texts))
    start, end = _hash(np.array(["\x02", "\x03"], object))
    seq = np.full(int(n.sum()) + 3 * len(n), start)
    inside = np.ones(len(seq), bool)
    first = np.cumsum(n + 3) - (n + 3)
    inside[first] = inside[first + 1] = inside[first + n + 2] = False
    seq[first + n + 2] = end
    if len(hashes):
        seq[inside] = hashes[coded.indices.to_numpy(zero_copy_only=False)[real]]
    return seq, n + 3


def _hash(words: np.ndarray) -> np.ndarray:
    return pd.util.hash_array(words, categorize=False).view(np.int64) if len(words) else np.empty(0, np.int64)


def _grams(slices: int, own: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Triples whose middle word is of a slice."""
    for batch in batches:
        seq, sizes = _sequences(batch.column(0))
        at = np.flatnonzero(_inner(sizes, 2) & (seq[1:-1].view(np.uint64) % np.uint64(slices) == own)) if len(sizes) else np.empty(0, int)
        yield pa.RecordBatch.from_arrays([pa.array(seq[at + i]) for i in range(3)], ["a", "b", "c"])


def _inner(sizes: np.ndarray, tail: int) -> np.ndarray:
    """Which places of all texts but the last ``tail`` have ``tail`` more in the same text."""
    inner = np.ones(int(sizes.sum()), bool)
    for i in range(1, tail + 1):
        inner[np.cumsum(sizes) - i] = False
    return inner[: len(inner) - tail]


def weigh(texts: DataFrame, chars: int) -> tuple[str, int, float]:
    """The folder of the weights of the model of ``text``, the bits of a bucket, and the log-probability of an unknown word."""
    from .kneser_ney import cut_of, cuts

    spark, slices = texts.sparkSession, min(MODEL_SLICES, -(-chars // SLICE_CHARS))
    tables = _Tables(spark)

    def triples(own: int) -> DataFrame:
        grams = texts.select("text").mapInArrow(partial(_grams, slices, own), "a long, b long, c long")
        return grams.repartition("b", "c").groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"))

    few = [F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)]
    parts = [tables.add(triples(i).groupBy("b", "c").agg(F.count(F.lit(1)).alias("m"), *few), "pairs") for i in range(slices)]
    pairs = parts[0]
    for part in parts[1:]:
        pairs = pairs.unionByName(part)
    of_pairs = [F.count_if(F.col("m") == i).alias(f"m{i}") for i in range(1, 5)]
    sums = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.sum("m").alias("triples"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(1, 5)], *of_pairs).first()
    d3, d2 = (cuts({i: sums[f"{k}{i}"] for i in range(1, 5) if sums[f"{k}{i}"]}) for k in "nm")
    singles = tables.add(pairs.groupBy(F.col("c").alias("w")).agg(F.count(F.lit(1)).alias("k")), "singles")
    few = {r[0]: r[1] for r in singles.where("k <= 4").groupBy("k").count().collect()}
    d1 = cuts(few)
    start = int(_hash(np.array(["\x02"], object))[0])
    known = singles.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("w") == start).alias("s"), F.sum(cut_of(F.col("k"), d1)).alias("cut")).first()
    unknown = known["cut"] / sums["pairs"] / (known["n"] + 1 - known["s"] + 1)
    contexts = pairs.groupBy(F.col("b").alias("w")).agg(F.sum("m").alias("total"), (F.sum(cut_of(F.col("m"), d2)) / F.sum("m")).alias("gamma"))
    p1 = F.coalesce((F.col("k") - cut_of(F.col("k"), d1)) / F.lit(sums["pairs"]), F.lit(0.0)) + F.lit(unknown)
    words = tables.add(singles.join(contexts, "w", "full").select("w", p1.alias("p"), "total", "gamma"), "words")

    where = scratch_path(spark, "weights")
    bits = max(1, (-(-(sums["pairs"] + sums["triples"]) // BUCKET_GRAMS)).bit_length())
    order, none = (lambda n: F.lit(n).alias("order")), F.lit(0).cast("long")
    single = F.log(F.col("p") / F.lit(unknown)) + F.coalesce(F.log("gamma"), F.lit(0.0))
    _store(words.select(order(1), none.alias("a"), none.alias("b"), F.col("w").alias("c"), single.alias("weight")), where, bits)
    left = Window.partitionBy("a", "b")
    for i, part in enumerate(parts):
        rows = part.select("b", "c", "m").join(words.select(F.col("w").alias("b"), "total", "gamma"), "b")
        rows = rows.join(words.select(F.col("w").alias("c"), "p"), "c")
        lower = F.col("gamma") * F.col("p")
        alpha = (F.col("m") - cut_of(F.col("m"), d2)) / F.col("total")
        two = tables.add(rows.select("b", "c", alpha.alias("alpha"), lower.alias("lower")), "two")
        _store(two.select(order(2), none.alias("a"), "b", "c", F.log1p(F.col("alpha") / F.col("lower")).alias("weight")), where, bits)
        cut = cut_of(F.col("n"), d3)
        three = triples(i).select(
            "a", "b", "c", (F.col("n") - cut).alias("own"), F.sum(cut).over(left).alias("cut"),
            F.sum("n").over(left).alias("total"), (F.min("c").over(left) == F.col("c")).alias("first"),
        ).join(two, ["b", "c"])
        # own / total over (cut / total) of the lower order
        weight = F.log1p(F.col("own") / (F.col("cut") * (F.col("alpha") + F.col("lower"))))
        context = F.struct(order(2), none.alias("a"), F.col("a").alias("b"), F.col("b").alias("c"), F.log(F.col("cut") / F.col("total")).alias("weight"))
        both = F.array(F.struct(order(3), "a", "b", "c", weight.alias("weight")), F.when(F.col("first"), context))
        _store(three.select(F.explode(both).alias("g")).where("g IS NOT NULL").select("g.*"), where, bits)
        tables.drop(two)
    for df in (*parts, singles, words):
        tables.drop(df)
    return where, bits, float(np.log(unknown))


def _store(grams: DataFrame, where: str, bits: int) -> None:
    """Add weights to the buckets."""
    rows = grams.mapInPandas(_keyed, "key long, weight float").withColumn("bucket", F.shiftright("key", 64 - bits))
    packed = rows.groupBy("bucket").applyInPandas(_packed, "bucket long, keys binary, weights binary")
    packed.write.mode("append").partitionBy("bucket").parquet(where)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from .kneser_ney import gram_keys

    for batch in batches:
        keys, order = np.empty(len(batch), np.int64), batch["order"].to_numpy()
        for n in (1, 2, 3):
            own = batch[order == n]
            keys[order == n] = gram_keys(*[own[w].to_numpy(np.int64) for w in "abc"[3 - n :]]) if len(own) else 0
        yield pd.DataFrame({"key": keys, "weight": batch["weight"].to_numpy(np.float32)})


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({
        "bucket": rows["bucket"].iloc[:1], "keys": [rows["key"].to_numpy(np.int64).tobytes()],
        "weights": [rows["weight"].to_numpy(np.float32).tobytes()],
    })


class _Tables:
    """Tables of this module's own, written below fresh scratch paths; only those paths are ever deleted, never what a caller gave."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def add(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = (table, path)
        return table

    def drop(self, table: DataFrame) -> None:
        _, path = self.paths.pop(id(table))  # a table of others is an error
        _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a path that :func:`scratch_path` gave."""
    if not path.startswith(scratch_path(spark, "").rpartition("/")[0] + "/"):
        raise ValueError(f"not a scratch path: {path}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _asks(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of many documents, sorted, in a row for each bucket, and a row of the documents themselves."""
    from .kneser_ney import gram_keys

    names = [c.split()[0] for c in ASKS.split(", ")]
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        texts = batch.column(0).cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
        chunk = np.maximum(np.arange(len(texts)) // 30_000, ends // PACK_BYTES)
        for low, high in zip(*_runs(chunk)):
            seq, sizes = _sequences(texts.slice(low, high - low))
            doc = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
            firsts = np.ones(len(seq), bool)
            firsts[np.cumsum(sizes) - sizes] = False
            one, two, three = firsts, _inner(sizes, 1), _inner(sizes, 2)
            keys = np.concatenate((gram_keys(seq[one]), gram_keys(seq[:-1], seq[1:])[two], gram_keys(seq[:-2], seq[1:-1], seq[2:])[three]))
            docs = np.concatenate((doc[one], doc[:-1][two], doc[:-2][three]))
            order = np.argsort(keys, kind="stable")
            keys, docs = keys[order], docs[order]
            begin = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1]))))
            times = np.minimum(np.diff(np.append(begin, len(keys))), 1 << 31).astype(np.uint32)
            keys, docs = keys[begin], docs[begin]
            bucket = keys >> np.int64(64 - bits)
            src, n = f"{part}-{n}", n + 1
            rows = [(src, int(bucket[i]), keys[i:j].tobytes(), docs[i:j].tobytes(), times[i:j].tobytes(), None) for i, j in zip(*_runs(bucket))]
            ids = np.concatenate([batch.column(k).to_numpy()[low:high] for k in (1, 2)])
            # dealt like the others, to any bucket
            rows.append((src, hash((part, n)) % (1 << bits) - (1 << bits - 1), None, None, (sizes - 2).astype(np.uint32).tobytes(), ids.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), *[pa.binary()] * 4))], names
            )


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal values begin and end."""
    cuts = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return ([0, *cuts], [*cuts, len(values)]) if len(values) else ([], [])


def _answers(where: str, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of weights for each row of keys: documents with any, and their sums."""
    store, start = file_store(where)
    path = f"{start}/bucket={rows['bucket'].iloc[0]}"
    out = rows[["src", "docs", "times", "ids"]].rename(columns={"times": "sums"})
    asked = rows["keys"].notna().to_numpy()
    try:
        held = pq.read_table(path, filesystem=store, columns=["keys", "weights"], partitioning=None)
    except FileNotFoundError:
        return out[~asked]
    keys = np.concatenate([np.frombuffer(k, np.int64) for k in held["keys"].to_pylist()])
    weights = np.concatenate([np.frombuffer(w, np.float32) for w in held["weights"].to_pylist()]).astype(np.float64)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    keys, weights = keys[begin], np.add.reduceat(weights, begin)
    docs, sums = list(out["docs"]), list(out["sums"])
    for i in np.flatnonzero(asked):
        wanted = np.frombuffer(rows["keys"].iloc[i], np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        doc = np.frombuffer(docs[i], np.uint16)[hit]
        times = np.frombuffer(sums[i], np.uint32)[hit]
        total = np.bincount(doc, weights[at[hit]] * times)
        own = np.unique(doc)
        docs[i], sums[i] = own.tobytes(), total[own].tobytes()
    return out.assign(docs=docs, sums=sums)


def _summed(unknown: float, rows: pd.DataFrame) -> pd.DataFrame:
    """The texts of one source: ids, tokens, log-probability."""
    is_list = rows["ids"].notna()
    (head,) = rows[is_list].itertuples()
    n = np.frombuffer(head.sums, np.uint32).astype(np.int64)
    ids, total = np.frombuffer(head.ids, np.int64).reshape(2, -1), n * unknown
    for row in rows[~is_list].itertuples():
        total[np.frombuffer(row.docs, np.uint16)] += np.frombuffer(row.sums, np.float64)
    return pd.DataFrame({"k1": ids[0], "k2": ids[1], "n_tokens": n, "log_prob": total})


def scores(docs: DataFrame, texts: DataFrame, chars: int) -> DataFrame:
    """``row, id, l, n_tokens, log_prob`` of ``docs`` (``row, id, l, t``) under the model of ``texts``. A text is told by 128 bits."""
    spark = docs.sparkSession
    ids = [F.xxhash64("t").alias("k1"), F.xxhash64(F.lit(1), "t").alias("k2")]
    with _swept(spark):
        where, bits, unknown = weigh(texts, chars)

        def answers(rows: pd.DataFrame) -> pd.DataFrame:
            return _answers(where, rows)

        def summed(rows: pd.DataFrame) -> pd.DataFrame:
            return _summed(unknown, rows)

        slices, parts = min(DOC_SLICES, -(-chars // SLICE_CHARS)), []
        for i in range(slices):
            own = docs.select("t", *ids).where(F.pmod("k1", F.lit(slices)) == i)
            asks = own.mapInArrow(partial(_asks, bits), ASKS)
            sums = asks.groupBy("bucket").applyInPandas(answers, "src string, docs binary, sums binary, ids binary")
            sums = sums.groupBy("src").applyInPandas(summed, "k1 long, k2 long, n_tokens long, log_prob double")
            parts.append(materialise(sums, "sums"))
    _delete(spark, where)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.groupBy("k1", "k2").agg(F.max("n_tokens").alias("n_tokens"), F.max("log_prob").alias("log_prob"))
    return docs.select("row", "id", "l", *ids).join(found, ["k1", "k2"]).select("row", "id", "l", "n_tokens", "log_prob")
