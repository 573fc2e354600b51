"""Token ids in patched frame-of-reference blocks.

A file is a Parquet table of segments; a segment holds the ids of consecutive documents in blocks of
128. A block stores its least id, and the differences to it packed at a width that one of several
percentiles of the block needs, whichever makes it smallest; differences that need more bits go into a
list of exceptions (place, whole difference) behind it. ``block_starts`` has the byte at which each
block begins, so single blocks can be read.

Block: least id (4 bytes, little-endian), width (1), exceptions (1), 128 differences of ``width`` bits,
exceptions of 1 + 4 bytes.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import ship

BLOCK = 128
HEAD = 6
#: Ranks of the differences, of 128, whose width a block may take.
RANKS = np.array([63, 79, 95, 103, 111, 115, 119, 121, 123, 124, 125, 126, 127])
SEGMENT_IDS = 1 << 18
END_ID = 2
#: Ids in a worker's memory of pieces, bytes of text that it encodes at a time, new pieces in one text, pieces gathered at a time.
MEMORY, CHUNK, TOGETHER, GATHER = 4_000_000, 8 << 20, 1024, 1 << 18
# Fixed value: white space.
_WHITE = r"\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: ``before`` counts the ids of the part's earlier segments.
ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("block_starts", pa.binary()), ("blocks", pa.binary()),
])
SEGMENTS = from_arrow_schema(ARROW)


def pack(ids: np.ndarray) -> tuple[bytes, bytes]:
    """``(block_starts, blocks)`` of ids below 2^32."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return b"", b""
    rows = np.concatenate([ids, np.repeat(ids[-1:], n * BLOCK - len(ids))]).astype(np.uint32).reshape(n, BLOCK)
    least = rows.min(axis=1)
    diff = rows - least[:, None]
    need = _bits(np.sort(diff, axis=1)[:, RANKS])
    cost = need * BLOCK + (BLOCK - 1 - RANKS) * 40
    width = need[np.arange(n), cost.argmin(axis=1)]
    outlier = (diff.astype(np.uint64) >> width[:, None].astype(np.uint64)) > 0
    count = outlier.sum(axis=1)
    size = HEAD + BLOCK // 8 * width + 5 * count
    start = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(start[-1], np.uint8)
    head = start[:-1, None]
    out[head + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(n, 4)
    out[start[:-1] + 4] = width
    out[start[:-1] + 5] = count
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            packed = _squeeze(diff[own].reshape(-1, 8), w).reshape(len(own), -1)
            out[head[own] + HEAD + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(outlier)
    if len(row):
        nth = np.arange(len(row)) - np.concatenate(([0], np.cumsum(count)))[row]
        at = start[row] + HEAD + BLOCK // 8 * width[row] + 5 * nth
        out[at] = place
        out[at[:, None] + 1 + np.arange(4)] = diff[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return start[:-1].astype("<u4").tobytes(), out.tobytes()


def unpack(block_starts: bytes, blocks: bytes, n_ids: int) -> np.ndarray:
    """The ids that :func:`pack` was given."""
    data = np.frombuffer(blocks, np.uint8)
    start = np.frombuffer(block_starts, "<u4").astype(np.int64)
    n = len(start)
    if not n:
        return np.empty(0, np.uint32)
    least = data[start[:, None] + np.arange(4)].view("<u4").ravel()
    width, count = data[start + 4].astype(np.int64), data[start + 5].astype(np.int64)
    diff = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            packed = data[start[own, None] + HEAD + np.arange(BLOCK // 8 * w)]
            diff[own] = _spread(packed.reshape(-1, w), w).reshape(len(own), BLOCK)
    row = np.repeat(np.arange(n), count)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = start[row] + HEAD + BLOCK // 8 * width[row] + 5 * nth
        diff[row, data[at]] = data[at[:, None] + 1 + np.arange(4)].view("<u4").ravel()
    return (diff + least[:, None]).ravel()[:n_ids]


def _squeeze(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of eight values a row, highest bit first, as ``width`` bytes."""
    out = np.zeros((width, len(values)), np.uint8)
    low = values.T & np.uint32((1 << width) - 1)
    for j in range(8):
        first, last = j * width, (j + 1) * width
        for byte in range(first // 8, (last + 7) // 8):
            right = last - 8 * (byte + 1)
            out[byte] |= (low[j] >> np.uint32(right) if right >= 0 else low[j] << np.uint32(-right)).astype(np.uint8)
    return out.T


def _spread(packed: np.ndarray, width: int) -> np.ndarray:
    """The eight values a row that :func:`_squeeze` put into ``width`` bytes."""
    column = np.ascontiguousarray(packed.T)
    out = np.zeros((8, len(packed)), np.uint32)
    for j in range(8):
        first, last = j * width, (j + 1) * width
        for byte in range(first // 8, (last + 7) // 8):
            right, have = last - 8 * (byte + 1), column[byte]
            if first > 8 * byte:
                have = have & np.uint8(0xFF >> (first - 8 * byte))
            wide = have.astype(np.uint32)
            out[j] |= wide << np.uint32(right) if right >= 0 else wide >> np.uint32(-right)
    return out.T


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the other bytes for 256, 257 and so on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _byte_letters()
_SPACE = _SHOWN[32]


def parts_at_spaces(vocabulary: str) -> bool:
    """Whether a tokenizer file is byte-level with the usual pattern, whole alphabet and nothing before it."""
    made = json.loads(vocabulary)
    before, model = made.get("pre_tokenizer") or {}, made.get("model") or {}
    level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space", True) and before.get("use_regex", True)
    plain = not any(made.get(k) for k in ("normalizer", "truncation", "padding"))
    pairs = model.get("type") == "BPE" and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")
    )
    return bool(level and plain and pairs) and all(c in model["vocab"] for c in _byte_letters().values())


#: Marks that the tokenizer's pattern parts from letters before them.
MARKS = ".,;:!?"
#: Words of letters below this need no parting: the pattern takes them as letters in every version of Unicode.
LETTERS = "\u0250"
#: Pieces, all their ids, and how many each has.
Learnt = tuple[Sequence[str], np.ndarray, np.ndarray]


class Encoder:
    """Ids of texts, each followed by ``end_id``, with a memory of the pieces between spaces.

    A byte-level tokenizer parts a text before every space that has no white space on both sides and does
    not end the text after white space. So the pieces between spaces are encoded alike by themselves, and a
    distinct piece of a batch once: many new ones in one text, told apart by the tokens that begin with a
    space. Texts with other spaces or with an added token are encoded whole, as is every text where the
    tokenizer file is of another kind (:func:`parts_at_spaces`).
    """

    def __init__(self, vocabulary: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_str(vocabulary)
        self._merges = Tokenizer(self._tokenizer.model)
        self._merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._parts = parts_at_spaces(vocabulary)
        tokens = self._tokenizer.get_vocab()
        self._opens = np.zeros(max(tokens.values(), default=0) + 1, bool)
        self._opens[[i for t, i in tokens.items() if t.startswith(_SPACE)]] = True
        added = [re.escape(t["content"]) for t in json.loads(vocabulary).get("added_tokens") or ()]
        self._odd = "|".join([rf"[{_WHITE}] ([{_WHITE}]|\z)", *added])
        self._end = np.array([end_id], np.uint32)
        self._forget()

    def _forget(self) -> None:
        # texts' first pieces, pieces behind a space; a piece's number gives its place in the pool of ids
        self._known: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self._pool, self._starts, self._sizes = self._end, np.zeros(1, np.int64), np.ones(1, np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty) one after the other, and how many each has, its end included."""
        if len(self._pool) > MEMORY:
            self._forget()
        texts = pc.fill_null(texts, "")
        odd = np.ones(len(texts), bool)
        if self._parts:
            odd = pc.match_substring_regex(texts, self._odd).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        count = np.ones(len(texts), np.int64)
        count[~odd] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        pieces, own = split.flatten(), count[~odd]
        first = np.zeros(len(pieces), bool)
        first[np.cumsum(own) - own] = True
        inner = np.empty(len(pieces), np.int64)
        inner[~first] = self._numbers(pieces.filter(pa.array(~first)), True)
        inner[first] = self._numbers(pieces.filter(pa.array(first)), False)
        numbers = np.empty(count.sum(), np.int64)
        alone = np.repeat(odd, count)
        numbers[~alone] = inner
        numbers[alone] = self._numbers(texts.filter(pa.array(odd)), False)
        ends = np.cumsum(count)
        numbers = np.insert(numbers, ends, 0)
        sizes = self._sizes[numbers]
        lengths = np.add.reduceat(sizes, ends - count + np.arange(len(count))) if len(count) else count
        out = [self._gather(numbers[i : i + GATHER], sizes[i : i + GATHER]) for i in range(0, len(numbers), GATHER)]
        return np.concatenate(out) if out else self._end[:0], lengths

    def _gather(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        at = np.repeat(self._starts[numbers] - np.cumsum(sizes) + sizes, sizes)
        return self._pool[at + np.arange(len(at))]

    def _numbers(self, pieces: pa.Array, behind_space: bool) -> np.ndarray:
        """The number of each piece; new ones are learnt."""
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_pylist()
        known = self._known[behind_space]
        new = [p for p in names if p not in known]
        if new:
            self._learn(new, known, behind_space)
        number = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        return number[coded.indices.to_numpy(zero_copy_only=False)]

    def _learn(self, new: list[str], known: dict[str, int], behind_space: bool) -> None:
        """Remember pieces; one of letters and marks at its end is put together from the two, as the tokenizer parts it there."""
        if not behind_space:
            return self._add([self._each(new[i : i + TOGETHER], new[i : i + TOGETHER]) for i in range(0, len(new), TOGETHER)], known)
        marked, own, marks, words, joined, rest = [], [], [], [], [], []
        for p in new:
            w = p.rstrip(MARKS)
            if w.isalpha() and (w.isascii() or max(w) < LETTERS):
                words.append(w)
                if len(w) < len(p):
                    marked.append(p)
                    own.append(w)
                    marks.append(p[len(w) :])
            else:
                (joined if p and not p[0].isspace() else rest).append(p)
        words = list(set(words).difference(known))
        learnt = []
        for pieces, tokenizer, gap in ((words, self._merges, _SPACE), (joined, self._tokenizer, "")):
            for i in range(0, len(pieces), TOGETHER):
                some = pieces[i : i + TOGETHER]
                ids = self._together(some, tokenizer, gap)
                if ids:
                    learnt.append(ids)
                else:
                    rest += some
        for i in range(0, len(rest), TOGETHER):
            learnt.append(self._each([" " + p for p in rest[i : i + TOGETHER]], rest[i : i + TOGETHER]))
        self._add(learnt, known)
        if marked:
            pair = np.empty(2 * len(marked), np.int64)
            pair[::2] = np.fromiter(map(known.__getitem__, own), np.int64, len(own))
            pair[1::2] = self._numbers(pa.array(marks, pa.string()), False)
            sizes = self._sizes[pair]
            self._add([(marked, self._gather(pair, sizes), sizes[::2] + sizes[1::2])], known)

    def _together(self, pieces: list[str], tokenizer: "Tokenizer", space: str) -> Learnt | None:
        """All in one text; None if the tokens that begin with a space don't tell them apart."""
        text = space + f" {space}".join(pieces) if space else " " + " ".join(pieces)
        if space and not text.isascii():
            text = " ".join(pieces).encode().decode("latin-1").translate(_SHOWN).replace(space, f" {space}")
            text = space + text
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        starts = np.flatnonzero(self._opens[ids])
        return (pieces, ids, np.diff(starts, append=len(ids))) if len(starts) == len(pieces) else None

    def _each(self, texts: list[str], pieces: list[str]) -> Learnt:
        ids = [np.array(m.ids, np.uint32) for m in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return pieces, np.concatenate(ids), np.array([len(x) for x in ids])

    def _add(self, learnt: list[Learnt], known: dict[str, int]) -> None:
        at = len(self._sizes)
        for pieces, _, _ in learnt:
            known.update(zip(pieces, range(at, at + len(pieces))))
            at += len(pieces)
        sizes = np.concatenate([self._sizes[:0], *[x[2] for x in learnt]])
        self._starts = np.concatenate([self._starts, len(self._pool) + np.cumsum(sizes) - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._pool = np.concatenate([self._pool, *[x[1] for x in learnt]])


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(vocabulary: str, end_id: int) -> Encoder:
    """One for each worker, so that its memory serves later tasks too."""
    if (vocabulary, end_id) not in _ENCODERS:
        _ENCODERS[vocabulary, end_id] = Encoder(vocabulary, end_id)
    return _ENCODERS[vocabulary, end_id]


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``CHUNK`` bytes of text; a longer text is one by itself."""
    size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    bound = np.flatnonzero(np.diff((np.cumsum(size) - size) // CHUNK)) + 1
    edges = [0, *bound.tolist(), len(size)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``doc_id, text`` with the tokenizer file ``vocabulary`` and write segments to ``path``.

    Documents are in ascending ``doc_id`` (nulls first; equal ids by a hash of the text), each followed by
    ``end_id``. A null or empty text is its end alone. Other columns are not looked at. Files and
    segments number the order: ``part`` the range of ids, ``segment`` the place inside it. Any tokenizer file
    will do; byte-level ones are fast.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(shared.value, end_id), TaskContext.get().partitionId()
        segment = before = size = 0
        docs, lengths, raw = [], [], []

        def flush() -> pa.RecordBatch:
            starts, blocks = pack(np.concatenate(raw))
            row = (part, segment, before, docs, lengths, size, starts, blocks)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, ARROW.types)], schema=ARROW)

        for batch in batches:
            for chunk in _chunks(batch):
                ids, n = encoder(chunk["text"])
                at = 0
                for doc, length in zip(chunk["doc_id"].to_pylist(), n.tolist()):
                    docs.append(doc)
                    lengths.append(length)
                    raw.append(ids[at : at + length])
                    at += length
                    size += length
                    if size >= segment_ids:
                        yield flush()
                        segment, before, size = segment + 1, before + size, 0
                        docs, lengths, raw = [], [], []
                raw = [x.copy() for x in raw]  # the rest of the chunk's ids can go
        if docs:
            yield flush()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, SEGMENTS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of a token file: ``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids``;
    ``start`` counts the ids before."""
    ship(spark)
    segments = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each task that wrote: no more than shuffle partitions
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    decoded = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")] + [("ids", pa.list_(pa.int64()))] * with_ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["block_starts"], row["blocks"], row["n_ids"]).astype("<u4", copy=False)
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                whole, edges = memoryview(ids).cast("B"), (4 * ends).tolist()
                crc = [zlib.crc32(whole[a:b]) for a, b in zip([0, *edges], edges)]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["at"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    edges = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(edges, pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, schema=decoded)

    placed = segments.join(F.broadcast(parts), "part").withColumn("at", F.col("first") + F.col("before")).drop("first", "before")
    return placed.mapInArrow(decode, from_arrow_schema(decoded))
