"""Periodic runs of words: an online sparse dynamic program over diagonals.

A diagonal is a lag; a word that equals the word a lag before lengthens the match on that lag's diagonal,
and a diagonal that ends with a match long enough emits a run. Of a word's many earlier occurrences only
those are followed that can carry a run: on the diagonals from half of ``k`` (exclusive) to ``k`` words, the nearest earlier
place where the same ``k`` words start, for ``k`` = 1, 2, 4, ...  In a run of smallest period q, those k
words (q <= k < 2q) start again exactly q before and not nearer, as its root is no power; so the diagonal q
is lengthened all along the run, at most one diagonal per word and ``k`` is active, and one that
ends with four periods or more cannot have a smaller period or be extended. A text of n words takes
O(n log n) steps whatever it repeats, instead of the number of pairs of equal words.

Words that occur once, and blocks of words that do, leave the program at once: for most texts little is left
after two words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, ship, unpacked, without

RESULT = ("n_words", "runs", "collapsed")
#: A run has at least so many words, and at least so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Characters of the texts that are worked on together.
BLOCK_CHARS = 1 << 21


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each value among the distinct ones, and how often it occurs."""
    _, rank, times = np.unique(values, return_inverse=True, return_counts=True)
    return rank, times[rank]


def find_runs(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, period`` of every run, by start and period, for word numbers of several texts.

    ``doc`` tells the text of each word and does not fall; runs stay inside a text, and places are
    those of ``words``.
    """
    n = len(words)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # places where k words start that occur in this order twice or more in their text, and their number
    code = np.full(n, -1, np.int64)
    if n:
        rank, times = _numbered(doc.astype(np.int64) * (int(words.max()) + 1) + words)
        code = np.where(times > 1, rank, -1)
    places = np.flatnonzero(code >= 0)
    last = np.searchsorted(doc, doc, side="right") if n else np.empty(0, np.int64)  # the end of each word's text
    k = 1
    while len(places):
        order = np.argsort(code[places], kind="stable")
        at, own = places[order], code[places][order]
        near = np.zeros(len(at), np.int64)
        near[1:] = np.where(own[1:] == own[:-1], at[1:] - at[:-1], 0)
        active = (near > k // 2) & (near <= k)
        found.extend(_ended(at[active], near[active], k))
        # twice as many words: those k and the k behind them
        follow = places + k
        inside = follow + k <= last[places]
        places, follow = places[inside], follow[inside]
        both = code[follow] >= 0
        places, follow = places[both], follow[both]
        rank, times = _numbered(code[places] * (n + 1) + code[follow])
        code = np.full(n, -1, np.int64)
        code[places[times > 1]] = rank[times > 1]
        places = places[times > 1]
        k *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, end, period = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _ended(at: np.ndarray, lag: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of the diagonals that were lengthened at ``at`` by ``k`` words each: those whose match was long enough."""
    if not len(at):
        return []
    order = np.argsort(at)
    at, lag = at[order], lag[order]
    new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(lag) != 0)])
    start, period = at[new] - lag[new], lag[new]
    end = at[np.r_[new[1:] - 1, len(at) - 1]] + k
    long = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
    return [(start[long], end[long], period[long])]


def _block(texts: list[str]) -> list[tuple[int, list[tuple[int, int, int]], str]]:
    """Words, runs and collapsed text of each text."""
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]  # bytes split at ASCII white space only
    sizes = np.array([len(w) for w in split], np.int64)
    first = np.r_[0, np.cumsum(sizes)]
    number: dict[bytes, int] = {}
    words = np.fromiter((number.setdefault(w, len(number)) for own in split for w in own), np.int64, int(first[-1]))
    start, end, period = find_runs(words, np.repeat(np.arange(len(texts)), sizes))
    of = np.searchsorted(first, start, side="right") - 1
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for d, own in enumerate(split):
        a, b = cut[d], cut[d + 1]
        runs = [(int(s - first[d]), int(e - s), int(p)) for s, e, p in zip(start[a:b], end[a:b], period[a:b])]
        if runs:
            keep = np.ones(len(own), bool)
            for s, length, p in runs:
                keep[s + p : s + length] = False
            own = [own[i] for i in np.flatnonzero(keep)]
        out.append((int(sizes[d]), runs, b" ".join(own).decode("utf-8", "surrogatepass")))
    return out


def with_runs(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """All rows with ``n_words``, ``runs`` and the ``collapsed`` text: words joined by one space, without those
    that some run holds after its first period.

    A run ``start, length, period`` is a stretch of words with that smallest period which neither neighbour
    extends, of six words and four periods at least; runs come by start, then period. Words are cut at ASCII
    white space. Null and empty texts have no words, no runs and an empty collapsed text. Rows are looked at
    one by one: repeated rows and null keys stay as they are, no shuffle is needed, and an empty table gives
    an empty result. Columns named like the result's give way, the text too unless it is to be kept.
    """
    ship(docs.sparkSession)
    kept = without(docs, RESULT if keep_text else (*RESULT, text))
    result = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

    @F.pandas_udf(result)
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch]
            ends = np.cumsum([len(t) for t in texts]) // BLOCK_CHARS
            cuts = np.flatnonzero(np.diff(ends)) + 1
            out = []
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(texts)]):
                out += _block(texts[a:b])
            yield pd.DataFrame(
                {"n_words": [x[0] for x in out], "runs": [[dict(zip(("start", "length", "period"), r)) for r in x[1]] for x in out], "collapsed": [x[2] for x in out]}
            )

    # generators keep the call apart from what makes the text and from what reads the result
    rows = docs.select(packed(kept).alias("row"), F.explode(F.array(docs[text])).alias("text"))
    rows = rows.select("row", look("text").alias("found")).select("row", F.inline(F.array("found")))
    return rows.select(*unpacked(rows), *RESULT)
