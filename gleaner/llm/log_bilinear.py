"""Log-probability of texts under a log-bilinear neural model.

The words of all training texts are counted by Spark. Words above a count, the end of a text, and one class for
all rarer words are the outputs of the model; a rarer word has its share of the class's count. Outputs are
factored: words in order of frequency are cut into about the root of their number of classes, and a word's
probability is that of its class times its own inside the class, so a normalised score needs two short sums. The
model predicts both from the two nearest words before that have an output: their vectors, each through a matrix of
its place, add up to a prediction, whose products with the class and word vectors are the scores.

Every text is cut into words once and written as the numbers of its outputs. Training texts are dealt by a hash to
rounds and, inside a round, to groups, as many as the number of tokens asks for and not the cluster. A group is
learnt in numpy with noise-contrastive estimation, from the parameters that the last round ended with; then
each parameter row is averaged over the groups that touched it, weighted by touches. Scores therefore do not depend
on the partitions of the input.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import packed, ship, unpacked, without
from .packing import size_class

RESULT = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
#: Parameter rows of a block, groups whose sums meet in one task, and the most tasks of a round.
BLOCK_ROWS, FAN, MOST_TASKS = 4096, 64, 20_000
#: Cells of the table that noise is looked up in, a power of two.
CELLS = 1 << 18


@dataclass(frozen=True)
class LblSettings:
    """``outputs``: most words with an output of their own, which bounds the model (33 numbers a word); rarer words
    are joined. ``group_tokens``: tokens of a group of one round, about. Texts whose crc32(key) mod ``folds``
    is ``held_out`` are not learnt from."""

    outputs: int = 60_000
    width: int = 16
    rounds: int = 3
    group_tokens: int = 3_000_000
    batch: int = 4096
    noise: int = 32
    noise_per_token: float = 8.0
    word_noise: int = 4
    rate: float = 0.1
    folds: int = 7
    held_out: int = 2
    flush: int = 300_000


def words_of(texts: Iterable[str | None], most: int = 8 << 20) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """For texts of about ``most`` characters at a time: distinct words, the number of each word among them, words per text."""
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= most:
            yield _cut(part)
            part, size = [], 0
    if part:
        yield _cut(part)


def _cut(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    full = pc.not_equal(cut.values, "")
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    coded = cut.values.filter(full).dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    return distinct, coded.indices.to_numpy(), np.diff(before[cut.offsets.to_numpy()])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Lbl:
    """Outputs: 0..H-1 words by falling count, H every other word, H+1 the end; H+2 is the start, a context only.

    ``rows`` holds all parameters: context vectors, word vectors and class vectors, each with a bias as its last
    number (unused in contexts), then the matrices of the two places; ``memory`` the squared steps of each row.
    """

    def __init__(self, counts: np.ndarray, settings: LblSettings) -> None:
        self.s, self.k = settings, len(counts)
        words, d = self.k - 2, settings.width
        mass = np.cumsum(np.sqrt(counts[:words]))
        cut = np.floor((mass - mass[:1]) / mass[-1] * np.ceil(np.sqrt(words))).astype(np.int64) if words else np.empty(0, np.int64)
        of = np.unique(cut, return_inverse=True)[1]
        n = int(of[-1]) + 1 if words else 0
        self.class_of = np.concatenate([of, [n, n + 1]]).astype(np.int32)
        self.starts = np.searchsorted(self.class_of, np.arange(n + 3))
        self.sizes = np.diff(self.starts)
        self.prior = counts / counts.sum()
        self.class_prior = np.add.reduceat(self.prior, self.starts[:-1])
        inside = self.prior / self.class_prior[self.class_of]
        self.log_inside = np.log(inside).astype(np.float32)
        self.log_class = np.log(self.class_prior).astype(np.float32)
        self.word_at = self.k + 1
        self.class_at = self.word_at + self.k
        self.place_at = self.class_at + n + 2
        r = np.random.default_rng(7)
        self.rows = np.zeros((self.place_at + 2 * d, d + 1), np.float32)
        self.rows[: self.word_at, :d] = r.standard_normal((self.k + 1, d)) * 0.3
        self.rows[self.word_at : self.class_at, d] = self.log_inside
        self.rows[self.class_at : self.place_at, d] = self.log_class
        self.rows[self.place_at :, :d] = np.concatenate([np.eye(d), np.eye(d) * 0.5])
        self.memory = np.full(len(self.rows), 0.1, np.float32)
        self.touched = np.zeros(len(self.rows), np.float32)
        # Rising within and over all classes: a draw inside a class is a draw between two of its steps.
        self._steps, self._class_steps = np.concatenate(([0], np.cumsum(self.prior))), np.cumsum(self.class_prior)
        self._cells = np.searchsorted(self._steps, np.arange(CELLS + 1) / CELLS, side="right").astype(np.int32)

    def sequence(self, groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Targets of texts (numbers below H+1, without the end) and the two contexts of each."""
        other, end, start = self.k - 2, self.k - 1, self.k
        seq = np.concatenate([x for g in groups for x in ((start,), g, (end,))]).astype(np.int32)
        at = np.arange(len(seq))
        last = np.maximum.accumulate(np.where(seq != other, at, 0))
        first = np.concatenate(([0], last[:-1]))
        second = np.where(seq[first] == start, first, np.concatenate(([0], last[:-1]))[first])
        real = seq != start
        return seq[real], seq[first][real], seq[second][real]

    def predict(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Predictions, with a one behind them for the bias."""
        d, place = self.s.width, self.rows[self.place_at :, : self.s.width]
        out = np.ones((len(a), d + 1), np.float32)
        out[:, :d] = self.rows.take(a, axis=0)[:, :d] @ place[:d] + self.rows.take(b, axis=0)[:, :d] @ place[d:]
        return out

    def _place(self, draw: np.ndarray) -> np.ndarray:
        """Steps up to each draw. Of even cells, all but those in which a step lies have one answer; the rest is searched."""
        cell = np.minimum(draw.ravel() * CELLS, CELLS - 1).astype(np.int32)
        out = self._cells.take(cell)
        open_ = np.flatnonzero(out != self._cells.take(cell + 1))
        out[open_] = np.searchsorted(self._steps, draw.ravel()[open_], side="right")
        return out.reshape(draw.shape)

    def learn(self, target: np.ndarray, a: np.ndarray, b: np.ndarray, r: np.random.Generator) -> None:
        """One step of noise-contrastive estimation, of classes with noise that the batch shares and of words inside
        their class with noise of their own; each touched row moves by its own rate (Adagrad)."""
        s, d = self.s, self.s.width
        h = self.predict(a, b)
        group = self.class_of[target]
        noise = np.searchsorted(self._class_steps, r.random(s.noise)).clip(0, len(self.sizes) - 1)
        own, others = self.rows.take(self.class_at + group, axis=0), self.rows[self.class_at + noise]
        log_k = np.float32(np.log(s.noise_per_token))
        up = _sigmoid(self.log_class[group] + log_k - np.einsum("nd,nd->n", h, own))
        down = np.float32(-s.noise_per_token / s.noise) * _sigmoid(h @ others.T - self.log_class[noise] - log_k)
        dh = up[:, None] * own + down @ others
        # A gradient is a factor times a row of the sources: predictions, noise of classes, contexts, places.
        n, each = len(target), np.arange(len(target))
        shared = down.T @ h
        at, source, factor = [self.class_at + group], [each], [up]

        many = np.flatnonzero(self.sizes[group] > 1)
        if len(many):
            t, c, hm = target[many], group[many], h.take(many, axis=0)
            low, high = self._steps[self.starts[c]], self._steps[self.starts[c + 1]]
            draw = low[:, None] + r.random((len(many), s.word_noise)) * (high - low)[:, None]
            wrong = self._place(draw) - 1
            wrong = np.clip(wrong, self.starts[c][:, None], self.starts[c + 1][:, None] - 1)
            log_k = np.float32(np.log(s.word_noise))
            own, others = self.rows.take(self.word_at + t, axis=0), self.rows.take(self.word_at + wrong, axis=0)
            up = _sigmoid(self.log_inside[t] + log_k - np.einsum("nd,nd->n", hm, own))
            down = -_sigmoid(np.einsum("nd,nkd->nk", hm, others) - self.log_inside[wrong] - log_k)
            dh[many] += up[:, None] * own + np.einsum("nk,nkd->nd", down, others)
            at += [self.word_at + t, (self.word_at + wrong).ravel()]
            source += [many, np.repeat(many, s.word_noise)]
            factor += [up, down.ravel()]

        dh, place = dh[:, :d], self.rows[self.place_at :, :d]
        sources = np.zeros((3 * n + s.noise + 2 * d, d + 1), np.float32)
        sources[:n], sources[3 * n : 3 * n + s.noise] = h, shared
        for i, x in enumerate((a, b)):
            sources[n * (i + 1) : n * (i + 2), :d] = dh @ place[i * d : (i + 1) * d].T
            sources[3 * n + s.noise + i * d :][:d, :d] = self.rows.take(x, axis=0)[:, :d].T @ dh
        at += [a, b, self.class_at + noise, self.place_at + np.arange(2 * d)]
        source.append(np.arange(n, len(sources)))
        factor.append(np.ones(len(sources) - n, np.float32))
        self._step(np.concatenate(at), sources, np.concatenate(source), np.concatenate(factor), n)

    def _step(self, at: np.ndarray, sources: np.ndarray, source: np.ndarray, factor: np.ndarray, weight: int) -> None:
        coded = np.sort(at.astype(np.int64) << 32 | np.arange(len(at)))
        order, at = coded & 0xFFFFFFFF, coded >> 32
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        rows, g = at[first], sources.take(source[order], axis=0)
        g *= factor[order][:, None]
        g = _sums(g, first)
        memory = self.memory[rows] + np.einsum("nd,nd->n", g, g) / g.shape[1]
        self.memory[rows] = memory
        g *= (self.s.rate / np.sqrt(memory))[:, None]
        g += self.rows.take(rows, axis=0)
        self.rows[rows] = g
        self.touched[rows] += np.diff(np.append(first, len(at)))
        self.touched[self.place_at :] += weight

    def fit(self, texts: Iterator[np.ndarray], seed: tuple[int, ...], chunk: int = 200_000) -> None:
        """Learn from texts in order, shuffled inside chunks of tokens."""
        r = np.random.default_rng(seed)
        groups, size = [], 0
        for text in texts:
            groups.append(text)
            size += len(text) + 1
            if size >= chunk:
                self._learn_all(groups, r)
                groups, size = [], 0
        if groups:
            self._learn_all(groups, r)

    def _learn_all(self, groups: list[np.ndarray], r: np.random.Generator) -> None:
        target, a, b = self.sequence(groups)
        order = r.permutation(len(target))
        for i in range(0, len(order), self.s.batch):
            own = order[i : i + self.s.batch]
            self.learn(target[own], a[own], b[own], r)

    def log_probs(self, target: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Normalised natural log-probabilities."""
        code = a.astype(np.int64) * (self.k + 1) + b
        distinct, which = np.unique(code, return_inverse=True)
        h = self.predict(distinct // (self.k + 1), distinct % (self.k + 1))
        group = self.class_of[target]
        classes, words = self.rows[self.class_at : self.place_at], self.rows[self.word_at : self.class_at]
        whole = _log_sums(h, classes)
        out = np.empty(len(target), np.float32)
        for i in range(0, len(target), 1 << 16):
            j = slice(i, i + (1 << 16))
            out[j] = np.einsum("nd,nd->n", h.take(which[j], axis=0), classes.take(group[j], axis=0))
        out -= whole[which]
        order = np.argsort(group, kind="stable")
        ends = np.searchsorted(group[order], np.arange(len(self.sizes) + 1))
        for c in np.flatnonzero((np.diff(ends) > 0) & (self.sizes > 1)):
            own = order[ends[c] : ends[c + 1]]
            for i in range(0, len(own), 1 << 16):
                j = own[i : i + (1 << 16)]
                its = h.take(which[j], axis=0)
                sums = _log_sums(its, words[self.starts[c] : self.starts[c + 1]])
                out[j] += np.einsum("nd,nd->n", its, words.take(target[j], axis=0)) - sums
        return out


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, given where each begins; most runs are single rows, which need none."""
    ends = np.append(first[1:], len(values))
    out, many = values.take(first, axis=0), np.flatnonzero(ends - first > 1)
    if len(many):
        bounds = np.column_stack([first[many], ends[many]]).ravel()
        out[many] = np.add.reduceat(values, bounds[:-1] if bounds[-1] == len(values) else bounds, axis=0)[::2]
    return out


def _log_sums(h: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials of each prediction's scores."""
    out = np.empty(len(h), np.float32)
    turned, rows = np.ascontiguousarray(vectors.T), max(64, (1 << 17) // len(vectors))
    bound = 1.01 * np.sqrt(np.einsum("nd,nd->n", h, h).max(initial=0) * np.einsum("nd,nd->n", vectors, vectors).max(initial=0))
    for i in range(0, len(h), rows):
        scores = h[i : i + rows] @ turned
        if bound < 60 or max(scores.max(initial=0), -scores.min(initial=0)) < 60:  # no sum can leave the range of a float
            out[i : i + rows] = np.log(np.exp(scores, out=scores).sum(axis=1))
        else:
            top = scores.max(axis=1)
            out[i : i + rows] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
    return out


def _count(batches: Iterator[pd.DataFrame], flush: int) -> Iterator[pd.DataFrame]:
    seen: dict[bytes, int] = {}
    for batch in batches:
        for distinct, codes, _ in words_of(batch["text"]):
            for w, c in zip(distinct, np.bincount(codes, minlength=len(distinct)).tolist()):
                seen[w] = seen.get(w, 0) + c
            if len(seen) > flush:
                yield pd.DataFrame({"word": list(seen), "c": list(seen.values())})
                seen = {}
    if seen:
        yield pd.DataFrame({"word": list(seen), "c": list(seen.values())})


def _least_count(counts: DataFrame, most: int) -> int:
    """The least count that no more than ``most`` words reach, from a histogram of bounded size."""
    classes = counts.groupBy(size_class(F.col("c")).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()
    words, least = 0, None
    for c, n in sorted(classes, reverse=True):
        words += n
        if words > most:
            break
        least = c
    return least if least is not None else (max(classes)[0] * 2 if classes else 1)


def _add(sums: pd.DataFrame) -> pd.DataFrame:
    """Touches and weighted rows of one block, added over groups in their order."""
    sums = sums.sort_values("part")
    touches = np.sum([np.frombuffer(x, np.float64) for x in sums["touches"]], axis=0)
    values = np.sum([np.frombuffer(x, np.float32).astype(np.float64) for x in sums["sums"]], axis=0)
    return pd.DataFrame({
        "block": sums["block"].iloc[:1], "part": sums["part"].iloc[:1] // FAN,
        "touches": [touches.tobytes()], "sums": [values.astype(np.float32).tobytes()],
    })


_SUMS = "block int, part long, touches binary, sums binary"


def train(numbered: DataFrame, counts: np.ndarray, settings: LblSettings) -> tuple[np.ndarray, np.ndarray] | None:
    """``(rows, memory)`` of a model of the texts ``numbers`` (bytes), dealt by the hash ``h``; None without texts."""
    spark, s = numbered.sparkSession, settings
    tokens = max(int(counts.sum()), 1)
    groups = max(1, -(-tokens // (s.rounds * s.group_tokens)))
    tasks = min(groups, MOST_TASKS)
    kind = _kind(counts)
    state = None

    for step in range(s.rounds):
        shared = spark.sparkContext.broadcast((counts, state))

        def fit(batches: Iterator[pd.DataFrame], step: int = step, shared=shared) -> Iterator[pd.DataFrame]:
            own, before = shared.value

            def texts() -> Iterator[tuple[int, np.ndarray]]:
                for batch in batches:
                    for g, x in zip(batch["part"], batch["numbers"]):
                        yield int(g), np.frombuffer(x, kind)

            rest = texts()
            ahead = next(rest, None)
            while ahead is not None:
                part, model = ahead[0], Lbl(own, s)
                if before is not None:
                    model.rows[...], model.memory[...] = before

                def of_part() -> Iterator[np.ndarray]:
                    nonlocal ahead
                    while ahead is not None and ahead[0] == part:
                        yield ahead[1]
                        ahead = next(rest, None)

                model.fit(of_part(), (11, step, part))
                values = np.column_stack([model.rows, model.memory])
                for i in range(0, len(values), BLOCK_ROWS):
                    weight = model.touched[i : i + BLOCK_ROWS]
                    if weight.any():
                        sums = weight[:, None] * values[i : i + BLOCK_ROWS]
                        raw = [weight.astype(np.float64).tobytes()], [sums.astype(np.float32).tobytes()]
                        yield pd.DataFrame({"block": i // BLOCK_ROWS, "part": part, "touches": raw[0], "sums": raw[1]})

        part = F.pmod(F.shiftright("h", 8), F.lit(groups)).alias("part")
        dealt = numbered.where(F.pmod("h", F.lit(s.rounds)) == step).select("h", part, "numbers")
        dealt = dealt.repartitionById(tasks, F.pmod("part", F.lit(tasks)).cast("int")).sortWithinPartitions("part", "h")
        sums, left = dealt.select("part", "numbers").mapInPandas(fit, _SUMS), groups
        while True:
            sums = sums.groupBy("block", F.floor(F.col("part") / FAN)).applyInPandas(_add, _SUMS)
            left = -(-left // FAN)
            if left == 1:
                break
        done = sums.select("block", "touches", "sums").collect()
        model = Lbl(counts, s)
        if state is not None:
            model.rows[...], model.memory[...] = state
        for block, touches, total in done:
            weight = np.frombuffer(touches, np.float64)
            mean = np.frombuffer(total, np.float32).reshape(len(weight), -1) / np.maximum(weight, 1)[:, None]
            at = np.flatnonzero(weight)
            model.rows[block * BLOCK_ROWS + at] = mean[at, :-1]
            model.memory[block * BLOCK_ROWS + at] = mean[at, -1]
        state = model.rows, model.memory
    return state


def _kind(counts: np.ndarray) -> type:
    return np.uint16 if len(counts) < 1 << 16 else np.uint32


def score_texts(
    docs: DataFrame, settings: LblSettings = LblSettings(), key: str = "doc_id", text: str = "text", keep_text: bool = True
) -> DataFrame:
    """All rows with ``held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10).

    Tokens are words with A-Z lower-cased, then the end. ``base_score`` is the add-one unigram model of the
    training tokens. A null or empty text is its end alone; a null key counts as the empty text. Every
    row, repeated ones too, is learnt from and scored by itself. Without any training text the score is the base's.
    Columns named like the result's give way; an empty table gives an empty result.
    """
    spark, s = docs.sparkSession, settings
    ship(spark)
    kept = without(docs, RESULT if keep_text else (*RESULT, text))
    name = F.coalesce(docs[key].cast("string"), F.lit(""))
    fold = F.pmod(F.crc32(name.cast("binary")), F.lit(s.folds)) == s.held_out
    rows = docs.select(packed(kept).alias("row"), docs[text].alias("text"), fold.alias("held_out"), F.xxhash64(name, docs[text]).alias("h"))
    training = rows.where("NOT held_out").select("text")
    counts = materialise(
        training.mapInPandas(lambda batches: _count(batches, s.flush), "word binary, c long")
        .groupBy("word").agg(F.sum("c").alias("c")),
        "word-counts",
    )
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = training.count()
    total, distinct = n_words + ends, n_distinct + (1 if ends else 0)
    least = _least_count(counts, s.outputs)
    head = sorted(((bytes(r[0]), r[1]) for r in counts.where(F.col("c") >= least).collect()), key=lambda x: (-x[1], x[0]))
    other_tokens = n_words - sum(c for _, c in head)
    other_kinds = n_distinct - len(head)
    outputs = np.array([*[c for _, c in head], other_tokens, ends], np.float64) + 0.5
    other, kind = len(head), _kind(outputs)
    logs = np.log10(np.array([c + 1.0 for _, c in head] + [1.0]))
    numbers = spark.sparkContext.broadcast(({w: i for i, (w, _) in enumerate(head)}, logs))

    def encode(texts: pd.Series) -> pd.DataFrame:
        number, log_counts = numbers.value
        out = []
        for distinct, codes, lengths in words_of(texts):
            of = np.array([number.get(w, other) for w in distinct], kind)[codes]
            ends = np.cumsum(lengths)
            for first, end in zip((ends - lengths).tolist(), ends.tolist()):
                own = of[first:end]
                rare = Counter([distinct[i] for i in codes[first:end][own == other].tolist()])
                out.append((own.tobytes(), float(log_counts[own].sum()), len(own), sum(rare.values()), list(rare), list(rare.values())))
        return pd.DataFrame(out, columns=["numbers", "base", "n", "others", "words", "times"])

    schema = "numbers binary, base double, n long, others long, words array<binary>, times array<long>"
    coded = rows.select("row", "held_out", "h", F.pandas_udf(encode, schema)("text").alias("s"), F.monotonically_increasing_id().alias("id"))
    coded = materialise(coded.select("row", "held_out", "h", "id", "s.*"), "numbered")
    state = train(coded.where("NOT held_out").select("h", "numbers"), outputs, s) if ends else None
    trained = spark.sparkContext.broadcast((outputs, state))

    def score(texts: pd.Series) -> pd.Series:
        own, (vectors, _) = trained.value
        model = Lbl(own, s)
        model.rows[...] = vectors
        out = []
        for i in range(0, len(texts), 200):
            out += _scores(model, [np.frombuffer(x, kind) for x in texts[i : i + 200]])
        return pd.Series(out, dtype="float64")

    rare = coded.select("id", F.explode(F.arrays_zip("words", "times")).alias("w")).select("id", "w.words", "w.times")
    found = (
        rare.join(counts.where(F.col("c") < least), F.col("words") == F.col("word"))
        .groupBy("id")
        .agg(F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare"))
    )
    own_score = F.pandas_udf(score, "double")("numbers") if ends else F.lit(None).cast("double")
    scored = coded.select("row", "held_out", "id", "base", "n", "others", own_score.alias("model"))
    done = scored.join(found, "id", "left")
    rare_sum = F.coalesce("rare", F.lit(0.0))
    n_tokens = F.col("n") + 1
    base = F.col("base") + rare_sum + F.when(F.lit(ends > 0), F.log10(F.lit(float(ends + 1)))).otherwise(0.0)
    base = base - n_tokens * F.log10(F.lit(float(total + distinct + 1)))
    whole = F.log10(F.lit(float(other_tokens + other_kinds + 1)))
    scores = F.col("model") + rare_sum - F.col("others") * whole
    return done.select(
        *unpacked(done), "held_out", n_tokens.alias("n_tokens"),
        (F.col("n") - F.col("others") + F.coalesce("n_rare", F.lit(0)) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (scores if ends else base).alias("score"),
    )


def _scores(model: Lbl, groups: list[np.ndarray]) -> list[float]:
    """log10 of the model's outputs of each text, its end included."""
    ln = model.log_probs(*model.sequence(groups))
    total = np.concatenate(([0.0], np.cumsum(ln, dtype=np.float64))) / np.log(10)
    ends = np.cumsum([len(g) + 1 for g in groups])
    return [float(total[e] - total[e - len(g) - 1]) for e, g in zip(ends, groups)]
