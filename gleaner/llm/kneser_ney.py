"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is of words, of order three, and is counted by Spark on half of all trusted text
(labelled good and not toxic). Its tables of n-grams, each with its discounted probability and the
back-off weight of the contexts, are cut into shards by key; a batch of documents is turned into sorted n-gram
keys that are merged with one shard after the other. The model of a short training text is broadcast. That of a longer one
is never in one place (``sharded``): a text's log-probability is a sum of weights of its n-grams, so the documents' keys are
sent to the shards. A document is rejected when its perplexity lies above a quantile, own to its language, of all trusted
documents the model was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import sharded
from .common import SPACE, even_hash, known, maybe_among, packed, ship, unpacked, without

RESULT = ("n_tokens", "log_prob", "perplexity", "threshold", "kept")
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class QualityModel:
    """Half of the trusted text is trained on. Up to ``train_chars`` of it, the model is broadcast; of more, it is
    sharded. ``quantile`` of the trusted documents stay. A short document
    is drawn towards its language's mean by ``prior_tokens`` tokens. ``margin`` is added to the
    threshold of the mean log-probability."""

    train_chars: int = 1_500_000
    quantile: float = 0.999
    prior_tokens: float = 30.0
    margin: float = 0.05
    shard_bits: int = 3


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def _discounts(counts: DataFrame, n: str) -> list[float]:
    """D1, D2, D3+ of one order from its counts of counts."""
    return cuts({r[0]: r[1] for r in counts.where(F.col(n) <= 4).groupBy(n).count().collect()})


def cuts(few: dict[int, int]) -> list[float]:
    n1, n2, n3, n4 = (few.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def _level(counts: DataFrame, context: list[str], n: str) -> tuple[DataFrame, DataFrame]:
    """Discounted probabilities ``alpha`` of the n-grams, and the left-over ``gamma`` of their contexts."""
    d1, d2, d3 = _discounts(counts, n)
    cut = cut_of(F.col(n), [d1, d2, d3])
    sums = counts.groupBy(*context).agg(F.sum(n).alias("total"), F.sum(cut).alias("cut"))
    if context:
        alphas = counts.join(sums.select(*context, "total"), context)
    else:
        alphas = counts.withColumn("total", F.lit(sums.first()["total"]))
    gammas = sums.select(*context, (F.col("cut") / F.col("total")).alias("gamma"))
    return alphas.withColumn("alpha", (F.col(n) - cut) / F.col("total")).drop("total", n), gammas


def cut_of(n: Column, discounts: list[float]) -> Column:
    return F.when(n == 1, discounts[0]).when(n == 2, discounts[1]).otherwise(discounts[2])


def gram_keys(*hashes: np.ndarray) -> np.ndarray:
    """64-bit keys of n-grams, given the hashes of their words."""
    key = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        key = key * np.uint64(0x9E3779B97F4A7C15) + h.astype(np.int64).view(np.uint64)
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return key.view(np.int64)


@dataclass
class Shards:
    """A table of n-gram keys and values, in shards by key range, each sorted."""

    keys: list[np.ndarray]
    values: list[np.ndarray]

    @staticmethod
    def of(grams: DataFrame, words: list[str], values: list[str], bits: int) -> "Shards":
        """Sorted and packed by Spark, a shard in a task; the model's size is bounded, so the shards are fetched."""

        def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = batch[values].astype(np.float32)
                out.insert(0, "key", gram_keys(*[batch[w].to_numpy(np.int64) for w in words]))
                yield out

        def gather(shard: pd.DataFrame) -> pd.DataFrame:
            own = shard.sort_values("key")
            packed_values = np.ascontiguousarray(own[values].to_numpy(np.float32)).tobytes()
            return pd.DataFrame({"shard": own["shard"].iloc[:1], "keys": [own["key"].to_numpy(np.int64).tobytes()], "vals": [packed_values]})

        rows = (
            grams.mapInPandas(keyed, "key long, " + ", ".join(f"{v} float" for v in values))
            .withColumn("shard", F.shiftright("key", 64 - bits))
            .groupBy("shard")
            .applyInPandas(gather, "shard long, keys binary, vals binary")
            .collect()
        )
        rows.sort(key=lambda r: r["shard"])
        return Shards(
            [np.frombuffer(r["keys"], np.int64) for r in rows],
            [np.frombuffer(r["vals"], np.float32).reshape(-1, len(values)) for r in rows],
        )

    def join(self, asked: np.ndarray, valid: np.ndarray, missing: list[float]) -> np.ndarray:
        """Values of the keys: sorted, they are merged with one shard after the other."""
        out = np.tile(np.array(missing, np.float32), (len(asked), 1))
        own = np.flatnonzero(valid)
        own = own[np.argsort(asked[own])]
        wanted = asked[own]
        for keys, values in zip(self.keys, self.values):
            low, high = np.searchsorted(wanted, keys[0], "left"), np.searchsorted(wanted, keys[-1], "right")
            at = np.searchsorted(keys, wanted[low:high])
            hit = keys[at] == wanted[low:high]
            out[own[low:high][hit]] = values[at[hit]]
        return out


@dataclass
class Model:
    """Word numbers from 1; 0 is every unknown word."""

    vocabulary: dict[bytes, int]
    hashes: np.ndarray
    base: np.ndarray
    weight: np.ndarray
    pairs: Shards
    triples: Shards

    def log_probs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens, the end among them, and natural log-probability of each text."""
        get, start, end = self.vocabulary.get, self.vocabulary.get(START.encode(), 0), self.vocabulary.get(END.encode(), 0)
        ids: list[int] = []
        sizes = []
        for text in texts:
            words = text.encode().split() if text else []
            ids += [start, start]
            ids += [get(w, 0) for w in words]
            ids.append(end)
            sizes.append(len(words) + 1)
        seq, sizes = np.array(ids, np.int64), np.array(sizes, np.int64)
        first = np.cumsum(sizes + 2) - sizes
        h, is_known = self.hashes[seq], seq > 0
        # entry i speaks of the words i and i + 1
        pair = self.pairs.join(gram_keys(h[:-1], h[1:]), is_known[:-1] & is_known[1:], [0.0, 1.0])
        all_known = is_known[:-2] & is_known[1:-1] & is_known[2:]
        triple = self.triples.join(gram_keys(h[:-2], h[1:-1], h[2:]), all_known, [0.0])
        two = pair[1:, 0] + self.weight[seq[1:-1]] * self.base[seq[2:]]
        prob = np.log(triple[:, 0] + pair[:-1, 1] * two)
        total = np.concatenate(([0.0], np.cumsum(prob, dtype=np.float64)))
        return sizes, total[first - 2 + sizes] - total[first - 2]


def train(texts: DataFrame, shard_bits: int) -> Model:
    """The model of the ``text`` column of a bounded table. N-grams are of the words' 64-bit hashes."""
    padded = F.concat(F.array(F.lit(START), F.lit(START)), _words(F.col("text")), F.array(F.lit(END)))
    # stored by a generator, so that the places below look into a column and not into the split
    words = texts.select(F.explode(F.array(padded)).alias("w"))
    names = words.select(F.explode(F.array_distinct("w")).alias("w")).distinct().select("w", F.xxhash64("w").alias("h"))
    hashes = words.select(F.explode(F.array(F.transform("w", lambda x: F.xxhash64(x)))).alias("w"))
    grams = hashes.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(2), F.size("w") - 1),
                lambda i: F.struct(F.get("w", i - 2).alias("a"), F.get("w", i - 1).alias("b"), F.get("w", i).alias("c")),
            )
        ).alias("g")
    ).select("g.*")
    triples = materialise(grams.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n")), "triples")
    pairs = materialise(triples.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n")), "pairs")
    singles = materialise(pairs.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "singles")
    alpha3, gamma3 = _level(triples, ["a", "b"], "n")
    alpha2, gamma2 = _level(pairs, ["b"], "n")
    alpha1, gamma1 = _level(singles, [], "n")
    # a context of triples that is no pair itself (two starts) has no probability as a pair
    context = gamma3.select(F.col("a").alias("b"), F.col("b").alias("c"), "gamma")
    two = alpha2.join(context, ["b", "c"], "full").na.fill({"alpha": 0.0, "gamma": 1.0})
    pair_table = Shards.of(two, ["b", "c"], ["alpha", "gamma"], shard_bits)
    triple_table = Shards.of(alpha3, ["a", "b", "c"], ["alpha"], shard_bits)
    left = gamma1.first()
    per_word = (
        names.join(alpha1.withColumnRenamed("c", "h"), "h", "left")
        .join(gamma2.withColumnRenamed("b", "h"), "h", "left")
        .select("w", "h", F.coalesce("alpha", F.lit(0.0)).cast("float").alias("alpha"), F.coalesce("gamma", F.lit(1.0)).cast("float").alias("gamma"))
        .toPandas()
    )
    base = np.full(len(per_word) + 1, (left[0] if left and left[0] is not None else 1.0) / (len(per_word) + 1), np.float32)
    base[1:] += per_word["alpha"].to_numpy(np.float32)
    first = np.ones(1, np.float32)
    return Model(
        {w.encode(): i for i, w in enumerate(per_word["w"], 1)},
        np.concatenate(([0], per_word["h"].to_numpy(np.int64))),
        base,
        np.concatenate((first, per_word["gamma"].to_numpy(np.float32))),
        pair_table,
        triple_table,
    )


def _trains() -> Column:
    """Whether a trusted document is trained on."""
    return even_hash(F.col("id"), F.lit("train")) < F.lit(float(1 << 30))


def _trusted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Thin rows of trusted documents: labelled good and not toxic by every label of theirs."""
    good = labels.groupBy(known(F.col("doc_id")).alias("id")).agg(
        F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good")
    )
    return rows.join(good.where("good = 1").select("id"), "id", "left_semi")


def score_quality(
    docs: DataFrame, labels: DataFrame, settings: QualityModel = QualityModel(), keep_text: bool = True
) -> DataFrame:
    """All rows with ``n_tokens, log_prob, perplexity, threshold, kept``.

    ``labels`` has ``doc_id, quality, toxic``. Null and empty texts have one token, their end. A null
    language is a language; one without trusted documents has the threshold of all together; without any trusted
    document everything is kept and thresholds are null. Labels count once however often repeated, and a
    label without a document, or null, is none. Repeated rows are scored alike. Columns named like the
    result's give way; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = without(docs, RESULT if keep_text else (*RESULT, "text"))
    thin = docs.select(known(docs["doc_id"]).alias("id"), known(docs["lang"]).alias("l"))
    trusted = materialise(_trusted(thin, labels.where("doc_id IS NOT NULL")).select("id").distinct(), "trusted")
    ids = trusted.where(_trains())
    text = docs.select(known(docs["doc_id"]).alias("id"), "text").where(_trains())
    text = maybe_among(text, F.xxhash64("id"), ids.select(F.xxhash64("id").alias("code"))).join(ids, "id", "left_semi")
    text = materialise(text.select("text"), "train-text")
    chars = text.agg(F.sum(F.length("text"))).first()[0] or 0
    own = docs.select(packed(kept).alias("row"), known(docs["doc_id"]).alias("id"), known(docs["lang"]).alias("l"), docs["text"].alias("t"))
    if chars > settings.train_chars:
        scored = sharded.scores(own, text, chars)
    else:
        shared = spark.sparkContext.broadcast(train(text, settings.shard_bits))

        @F.pandas_udf("n_tokens long, log_prob double")
        def score(texts: pd.Series) -> pd.DataFrame:
            out = [shared.value.log_probs(list(texts[i : i + 500])) for i in range(0, len(texts), 500)]
            return pd.DataFrame({
                "n_tokens": np.concatenate([o[0] for o in out]) if out else [],
                "log_prob": np.concatenate([o[1] for o in out]) if out else [],
            })

        scored = own.withColumn("s", score("t")).select("row", "id", "l", "s.*")
    scored = materialise(scored, "scored")
    limits = _thresholds(scored.select("id", "l", "n_tokens", "log_prob"), trusted, settings)
    whole = limits.where("l IS NULL").first()
    mean_all, threshold_all = (whole["mean"], whole["threshold"]) if whole else (None, None)
    done = scored.join(limits, "l", "left")  # a row for each language
    mean = F.coalesce("mean", F.lit(mean_all).cast("double"))
    threshold = F.coalesce("threshold", F.lit(threshold_all).cast("double"))
    drawn = _drawn(F.col("n_tokens"), F.col("log_prob"), mean, settings)
    return done.select(
        *unpacked(done), "n_tokens", "log_prob",
        F.exp(-F.col("log_prob") / F.col("n_tokens")).alias("perplexity"),
        F.exp(threshold).alias("threshold"),
        F.coalesce(drawn <= threshold, F.lit(True)).alias("kept"),
    )


def _drawn(n: Column, log_prob: Column, mean: Column, settings: QualityModel) -> Column:
    return (-log_prob + mean * settings.prior_tokens) / (n + settings.prior_tokens)


def _thresholds(scored: DataFrame, trusted: DataFrame, settings: QualityModel) -> DataFrame:
    """``l, mean, threshold`` of the mean negative log-probability per language, and for all with a null ``l``.

    The quantile is taken over counts of scores in steps of a thousandth, so a window sees no more rows than
    there are steps.
    """
    held = scored.join(trusted.where(~_trains()), "id", "left_semi").select("l", "n_tokens", "log_prob")
    both = held.unionByName(held.withColumn("l", F.lit(None).cast("string")))
    means = both.groupBy("l").agg((-F.sum("log_prob") / F.sum("n_tokens")).alias("mean"))
    means = means.withColumnRenamed("l", "own")
    steps = (
        both.join(F.broadcast(means), F.col("l").eqNullSafe(F.col("own")))
        .select("l", "mean", F.ceil(_drawn(F.col("n_tokens"), F.col("log_prob"), F.col("mean"), settings) * 1000).alias("step"))
        .groupBy("l", "mean", "step")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.expr("sum(n) OVER (PARTITION BY l ORDER BY step)")
    total = F.expr("sum(n) OVER (PARTITION BY l)")
    reached = steps.withColumn("upto", upto).withColumn("total", total).where(F.col("upto") >= F.col("total") * settings.quantile)
    return materialise(
        reached.groupBy("l", "mean").agg((F.min("step") / 1000 + settings.margin).alias("threshold")), "thresholds"
    )
