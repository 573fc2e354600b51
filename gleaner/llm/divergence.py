"""Divergence of sources: how the terms of a language are shared out among its sources.

Chunk factorization: the whitespace chunks of a document are counted, every globally distinct chunk is cut
into terms once, and its terms are joined back to the counts. What a term occurs in is summed over chunks.
How many documents hold a term follows from the chunks almost always: in each source it is at least the
largest and at most the sum of the documents of its chunks. Only where the least number wanted lies between the two
are documents looked at again, and then only at chunks of those terms, each of which few documents hold.

Shares are whole billionths, and every sum is exact. Terms by sources are a dense matrix by definition
(a term that a source lacks has a share too): tasks work on blocks of terms against all sources of the language and hand
back one sum per pair of sources, never a row per pair and term.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinals import THIN_KEYS, join_hot, key_counts
from ..session import materialise
from .common import lower_ascii, marks_of, ship

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
#: Numbers of a block's matrix of shares, terms by sources.
BLOCK_CELLS = 1 << 20
#: Bytes of the texts whose chunks are counted together.
BLOCK_BYTES = 1 << 23


@dataclass(frozen=True)
class AuditSettings:
    """A term counts when ``min_docs`` documents of its language hold it; the ``top`` terms of a source are told."""

    min_docs: int = 10
    top: int = 10


def _share(count: Column, total: Column, terms: Column) -> Column:
    """One more than the billionths of (count + 2) in (total + 2 * terms), rounded down; decimals, as counts may be large."""
    top = (count.cast("decimal(20,0)") + 2) * F.lit(SCALE).cast("decimal(11,0)")
    below = total.cast("decimal(20,0)") + 2 * terms.cast("decimal(15,0)")
    return F.call_function("div", top, below).cast("long") + 1


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Rows of about ``BLOCK_BYTES`` of text, the row and the number of every chunk in them, and the distinct chunks."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)) // BLOCK_BYTES
        cuts = np.flatnonzero(np.diff(ends)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            block = batch.slice(int(a), int(b - a))
            lists = pc.ascii_split_whitespace(block["text"])  # cuts at ASCII white space only
            coded = pc.list_flatten(lists).dictionary_encode()
            row, chunk = pc.list_parent_indices(lists).to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64)
            real = np.append(pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False), False)[chunk]  # white space at an end leaves an empty chunk
            yield block, row[real], chunk[real], coded.dictionary


def chunk_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, chunk, docs, times`` over ``lang, source, text``: documents that hold the chunk, and
    occurrences. Blocks of documents are summed up before the shuffle, which is by chunk."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row, chunk, names in _blocks(batches):
            langs, sources = (block[c].dictionary_encode() for c in ("lang", "source"))
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            size = max(len(names), 1)
            held, times = np.unique(row * size + chunk, return_counts=True)  # a document's chunk and its count
            key = group[held // size] * size + held % size
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
            of = key[first] // size
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(of // len(sources.dictionary))), sources.dictionary.take(pa.array(of % len(sources.dictionary))),
                    names.take(pa.array(key[first] % size)), pa.array(np.diff(np.r_[first, len(key)])),
                    pa.array(np.add.reduceat(times, first) if len(first) else times.astype(np.int64)),
                ], ["lang", "source", "chunk", "docs", "times"],
            )

    counted = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, chunk string, docs long, times long")
    spread = counted.repartition("chunk")  # serves these sums and the gathering of a chunk's rows
    return spread.groupBy("lang", "source", "chunk").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times"))


def join_terms(counts: DataFrame) -> DataFrame:
    """``lang, source, chunk, term, docs, times, once`` for every term of a chunk, a row for each time it is there;
    ``once`` is true for one of them.

    A chunk's counts are gathered beside it, one per source at most, so that it is cut into terms once and
    these meet its counts without another shuffle. The result has a row for every two sources anyhow.
    """
    own = F.struct("lang", "source", "docs", "times")
    chunks = counts.groupBy("chunk").agg(F.collect_list(own).alias("own"))
    terms = F.regexp_extract_all(lower_ascii(F.col("chunk")), F.lit(TERM), F.lit(0))
    cut = chunks.select("chunk", "own", terms.alias("terms"))
    # the outer generator, as the inner one has the optimizer cut the chunks a second time in a filter
    each = cut.select("chunk", "own", "terms", F.posexplode_outer("terms").alias("at", "term")).where("term IS NOT NULL")
    once = F.array_position("terms", F.col("term")) == F.col("at") + 1
    return each.select("chunk", "term", once.alias("once"), F.inline("own"))


def term_sums(joined: DataFrame, min_docs: int) -> DataFrame:
    """``lang, source, term, n, least, most`` of terms that ``min_docs`` documents of the language may hold: ``n``
    occurrences, and the bounds of the number of documents: sources have no document in common, and in each at least
    those of the most frequent chunk hold the term."""
    spread = joined.repartition("lang", "term")  # serves the sums and the windows
    docs = F.when(F.col("once"), F.col("docs")).otherwise(F.lit(0))
    sums = spread.groupBy("lang", "term", "source").agg(F.sum("times").alias("n"), F.max("docs").alias("least"), F.sum(docs).alias("most"))
    whole = Window.partitionBy("lang", "term")
    bounds = sums.select("lang", "source", "term", "n", F.sum("least").over(whole).alias("least"), F.sum("most").over(whole).alias("most"))
    return bounds.where(F.col("most") >= min_docs)


def kept_terms(docs: DataFrame, joined: DataFrame, sums: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term`` of the terms that at least ``min_docs`` documents of the language hold; exact."""
    sure = F.col("least") >= min_docs
    open_terms = sums.where(~sure).select("lang", "term").distinct()
    # each of their chunks has fewer documents than wanted
    rare = joined.where(F.col("once") & (F.col("docs") < min_docs)).select("lang", "chunk", "term")
    asked = materialise(rare.join(open_terms, ["lang", "term"], "left_semi").distinct(), "open-terms")
    held = _documents_with(docs, asked.select("chunk").distinct())
    docs_of = held.join(asked, ["lang", "chunk"]).select("lang", "term", "doc").distinct().groupBy("lang", "term").count()
    enough = docs_of.where(F.col("count") >= min_docs).select("lang", "term")
    return materialise(sums.where(sure).select("lang", "term").distinct().unionByName(enough), "kept-terms")


def _documents_with(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """``lang, chunk, doc``: the documents of ``chunks``, and of a few others; a table of marks of bounded size picks them."""
    marks, words = marks_of(chunks.select(F.xxhash64("chunk").alias("code")))
    found = marks.toPandas()
    table = np.zeros(words, np.uint64)
    table[found["word"].to_numpy()] = found["marks"].to_numpy(np.int64).view(np.uint64)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row, chunk, names in _blocks(batches):
            code = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in names.to_pylist()), np.uint64, len(names))
            slot = code % np.uint64(words * 64)
            marked = (table[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
            size = max(len(names), 1)
            held = np.unique((row * size + chunk)[marked[chunk]])
            own = pa.array(held // size)
            yield pa.RecordBatch.from_arrays([block["lang"].take(own), names.take(pa.array(held % size)), block["doc"].take(own)], ["lang", "chunk", "doc"])

    numbered = docs.select("lang", "text", F.monotonically_increasing_id().alias("doc"))
    return numbered.mapInArrow(pick, "lang string, chunk string, doc long")


def _pair_sums(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, q, value`` summed over the terms of the language, for every two of its sources by their places.

    ``terms``: ``lang, held`` with an array of (place, count); ``groups``: ``lang, totals, terms``.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, own in batch.groupby("lang", sort=False):
                base = np.array([_plain_shares(int(t), int(own["terms"].iloc[0])) for t in own["totals"].iloc[0]], object)
                total = sums.setdefault(lang, np.zeros((len(base), len(base)), np.int64))
                step = max(1, BLOCK_CELLS // len(base))
                for i in range(0, len(own), step):
                    _add_block(total, own["places"].iloc[i : i + step], own["shares"].iloc[i : i + step], base.astype(np.int64))
        for lang, total in sums.items():
            a, b = np.nonzero(~np.eye(len(total), dtype=bool))
            yield pd.DataFrame({"lang": lang, "a": a, "b": b, "value": total[a, b]})

    sums = terms.join(groups, "lang").mapInPandas(add, "lang string, a int, b int, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _plain_shares(total: int, terms: int) -> int:
    """The share of a term that does not occur."""
    return SCALE * 2 // (total + 2 * terms) + 1


def _add_block(total: np.ndarray, places: pd.Series, shares: pd.Series, base: np.ndarray) -> None:
    """Add to ``total[a, b]`` the gaps between the shares of sources a and b over a block of terms."""
    block = np.tile(base, (len(places), 1))
    row = np.repeat(np.arange(len(places)), [len(x) for x in places])
    block[row, np.concatenate(places.to_list())] = np.concatenate(shares.to_list())
    for a in range(len(base) - 1):
        p, q = block[:, a : a + 1], block[:, a + 1 :]
        gap = ((p - q) * (p - q) // (p + q)).sum(axis=0)
        total[a, a + 1 :] += gap
        total[a + 1 :, a] += gap


def audit_sources(
    docs: DataFrame, settings: AuditSettings = AuditSettings(), lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far apart the sources of a language are.

    A term is a run of letters A-Z and characters beyond ASCII, with A-Z in lower case. Part ``pair`` has
    one row for every other source of the language, its value summed over all kept terms; part ``term``
    the terms by which a source exceeds its language most. Values fall with the rank, ties by item.

    Null language, source and text count as empty strings, and those are a language and a source like
    any other. A source without terms is compared all the same; a language without kept terms has pairs
    of value 0. Repeated rows are documents of their own. Other columns are not looked at; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    joined = materialise(join_terms(chunk_counts(rows)), "chunk-terms")
    sums = materialise(term_sums(joined, settings.min_docs), "term-sums")
    kept = kept_terms(rows, joined, sums, settings.min_docs)
    # what is left of them: a row per source and kept term that occurs there
    held = materialise(sums.join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "n"), "kept-counts")
    terms = key_counts(kept, ["lang"]).withColumnRenamed("__n", "terms")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, ["lang"], "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))
    place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int")
    groups = materialise(groups.withColumn("place", place), "groups")
    shared = join_hot(held, groups, ["lang", "source"], ["term"], how="inner", thin_keys=THIN_KEYS).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("terms"))
    )
    shared = materialise(shared.select("lang", "source", "place", "term", "n", "p"), "shares")
    return _pairs(shared, groups).unionByName(_terms(shared, groups, settings.top))


def _pairs(shared: DataFrame, groups: DataFrame) -> DataFrame:
    by_term = shared.groupBy("lang", "term").agg(F.collect_list("place").alias("places"), F.collect_list("p").alias("shares"))
    lists = groups.groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "total"))), lambda x: x["total"]).alias("totals"),
        F.any_value("terms").alias("terms"),
    )
    sums = _pair_sums(by_term.select("lang", "places", "shares"), lists)
    one = groups.select("lang", "source", F.col("place").alias("a"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"))
    # every two sources of a language are a row of the result
    pairs = one.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    return _ranked(pairs.withColumn("value", F.coalesce("value", F.lit(0)).cast("long")), "pair")


def _terms(shared: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.any_value("terms").alias("terms"))
    of_lang = shared.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(F.broadcast(whole), "lang")
    of_lang = of_lang.select("lang", "term", _share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
    over = shared.join(of_lang, ["lang", "term"]).where("p > q")
    found = over.select("lang", "source", F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    return _ranked(found, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(by))
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
