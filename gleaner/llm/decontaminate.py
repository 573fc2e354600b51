"""Benchmark passages in documents by Wu-Manber search over words.

Patterns are the windows of consecutive words of every benchmark item. For patterns of one length the
table of block shifts says, for two neighbouring words, how far the search may jump without missing an
occurrence; where it says zero, the bucket of the block (the suffix of some pattern) names the
candidates, and a direct comparison of all words confirms. The words of many documents are laid out in
one array and cut into lanes that overlap by a pattern, so one numpy step moves all lanes at once.

The patterns are broadcast in blocks of bounded size; a larger benchmark takes more passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, ship, unpacked, without

RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "hit_spans")
WINDOW = 10
#: Characters of benchmark text in one broadcast block.
BLOCK_CHARS = 8_000_000
TABLE_BITS = 20
LANE = 512
# A-Z become a-z; other ASCII that is neither digit nor letter parts words
_ASCII = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_ASCII).split() if text else []


def _block(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    code = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64)
    return ((code * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Searcher:
    """Shift table and suffix buckets of the patterns of one length."""

    def __init__(self, patterns: np.ndarray) -> None:
        self.patterns = patterns
        self.m = patterns.shape[1]
        self.b = min(2, self.m)

    @cached_property
    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        far = self.m - self.b + 1
        shift = np.full(1 << TABLE_BITS, far, np.int16)
        for j in range(far):
            np.minimum.at(shift, self._code(self.patterns, j), far - 1 - j)
        suffix = self._code(self.patterns, far - 1)
        order = np.argsort(suffix, kind="stable")
        return shift, suffix[order], order

    def _code(self, rows: np.ndarray, j: int) -> np.ndarray:
        return _block(rows[:, j], rows[:, j + self.b - 1])

    def search(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and pattern numbers of all occurrences in ``seq``."""
        shift, suffix, order = self._tables
        last = len(seq) - self.m
        if last < 0 or not len(self.patterns):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pos = np.arange(0, last + 1, LANE, dtype=np.int64)
        end = np.minimum(pos + LANE, last + 1)
        at, codes = [], []
        while len(pos):
            tail = pos + self.m - self.b
            code = _block(seq[tail], seq[tail + self.b - 1])
            jump = shift[code]
            zero = jump == 0
            if zero.any():
                at.append(pos[zero])
                codes.append(code[zero])
            pos = pos + np.maximum(jump, 1)
            more = pos < end
            pos, end = pos[more], end[more]
        if not at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        start, code = np.concatenate(at), np.concatenate(codes)
        low, high = np.searchsorted(suffix, code, "left"), np.searchsorted(suffix, code, "right")
        n = high - low
        start = np.repeat(start, n)
        which = order[np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
        same = np.ones(len(start), bool)
        for j in range(self.m):
            same &= seq[start + j] == self.patterns[which, j]
        return start[same], which[same]


class Benchmark:
    """The patterns of some benchmark items, by length, with the items of each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW) -> None:
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[int]]] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                found.setdefault(m, {}).setdefault(tuple(ids[i : i + m]), set()).add(number[name])
        self.searchers = []
        for m, patterns in sorted(found.items()):
            owners = [sorted(o) for o in patterns.values()]
            first = np.concatenate(([0], np.cumsum([len(o) for o in owners])))
            self.searchers.append(
                (Searcher(np.array(list(patterns), np.int32).reshape(-1, m)), first, np.array([i for o in owners for i in o]))
            )

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: words, disjoint spans of words that are hit, and names of the items."""
        get = self.vocabulary.get
        sizes, ids = [], []
        for text in texts:
            own = [get(w, 0) for w in words_of(text)]
            sizes.append(len(own))
            ids += own
            ids.append(0)  # in no pattern, so none reaches over it
        seq = np.array(ids, np.int32)
        first = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) + 1)))
        edge = np.zeros(len(seq) + 1, np.int32)
        pairs = []
        for searcher, owner, item in self.searchers:
            start, which = searcher.search(seq)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + searcher.m, -1)
            n = owner[which + 1] - owner[which]
            text_no = np.searchsorted(first, start, "right") - 1
            at = np.repeat(owner[which] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            pairs.append(np.stack([np.repeat(text_no, n), item[at.astype(np.int64)]]) if len(start) else np.empty((2, 0), np.int64))
        hit = np.cumsum(edge) > 0
        flips = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
        spans: dict[int, list[tuple[int, int]]] = {}
        owners = np.searchsorted(first, flips[::2], "right") - 1
        for a, b, t in zip(flips[::2], flips[1::2], owners):
            spans.setdefault(int(t), []).append((int(a - first[t]), int(b - first[t])))
        items: dict[int, list[str]] = {}
        for t, i in np.unique(np.concatenate(pairs, axis=1), axis=1).T if pairs else ():
            items.setdefault(int(t), []).append(self.names[i])
        for t, n in enumerate(sizes):
            yield n, spans.get(t, []), items.get(t, [])


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search_with(shared):
    """A search in the patterns of ``shared`` that adds to the spans and items found so far."""

    def search(texts: pd.Series, spans: pd.Series, names: pd.Series) -> pd.DataFrame:
        out = []
        for (n, new, found), old, known in zip(shared.value.hits(list(texts)), spans, names):
            if old is not None and len(old):
                new = _union([tuple(x) for x in old] + new)
            if known is not None and len(known):
                found = sorted({*known, *found})
            out.append((n, sum(b - a for a, b in new), [list(x) for x in new], found))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "spans", "items"])

    return search


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """All rows with ``n_words, n_hit, n_items, items_sha256, contaminated``, and ``items, hit_spans``.

    Words are runs of a-z, 0-9 and non-ASCII after A-Z are lower-cased. An item's windows are its runs of
    ``window`` words; an item of fewer, but not none, is one window. A word inside any occurrence is hit.
    Null and empty texts have no words; items without words occur nowhere; a null item id is the empty
    name; repeated items count once. Every row is judged by itself. Columns named like the result's
    give way; an empty table on either side gives rows without hits, or none.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.coalesce(benchmark[item].cast("string"), F.lit("")).alias("item"), benchmark[item_text].alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    kept = without(docs, RESULT)
    rows = docs.select(packed(kept).alias("row"), docs[text].alias("text"), F.lit(None).cast("array<array<int>>").alias("spans"),
                       F.lit(None).cast("array<string>").alias("items"))
    schema = "n_words long, n_hit long, spans array<array<int>>, items array<string>"
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast(Benchmark([tuple(r) for r in own], window))

        rows = rows.withColumn("f", F.pandas_udf(_search_with(shared), schema)("text", "spans", "items")).select(
            "row", "text", "f.n_words", "f.n_hit", "f.spans", "f.items"
        )
    return rows.select(
        *unpacked(rows), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items", F.col("spans").alias("hit_spans"),
    )
