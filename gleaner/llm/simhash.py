"""Near-duplicates by SimHash and vantage-point trees.

Fingerprints are partitioned by their Hamming distance to vantage points. A node sends what is no
farther than its radius to the near side, the rest to the far side, and what lies at most
``max_bits`` beyond the radius to the near side as well: by the triangle inequality two fingerprints
that link meet in one of the two. The upper levels are drawn from a bounded sample and cut the
fingerprints into shards that overlap at their boundaries; each shard is split on in the same way, and
small nodes are compared pair by pair. Each shard hands back a spanning forest of its links, and the
forests are joined into components by Spark.

Only distinct fingerprints go through the trees, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinals import join_hot
from ..session import materialise
from .common import known, packed, ship, unpacked, without

RESULT = ("fingerprint", "component_id", "representative")
MAX_BITS = 3
#: Fingerprints in a shard, about; those of the sample the upper tree is drawn from.
SHARD_ROWS, SAMPLE = 50_000, 40_000
#: Nodes no larger are compared pair by pair, in blocks of rows.
SMALL = 256
SHINGLE = 3


def fingerprint(text: str | None) -> int:
    """SimHash of the 3-word shingles of ``text``, repeats counted; 0 without words."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < SHINGLE else map(b" ".join, zip(words, words[1:], words[2:]))
    h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), ">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _split(points: np.ndarray, seed: int, max_bits: int) -> tuple[int, int] | None:
    """A vantage point and a radius that part ``points`` about evenly; None if none of three does."""
    best = None
    for k in range(3):
        vantage = points[(seed * 7919 + k * 104729) % len(points)]
        far = np.bitwise_count(points ^ vantage)
        counts = np.cumsum(np.bincount(far, minlength=65))
        for radius in range(64):
            near, over = counts[min(radius + max_bits, 64)], len(points) - counts[radius]
            worst = max(near, over)
            if best is None or worst < best[0]:
                best = (worst, int(vantage), radius)
    return best[1:] if best[0] <= 0.9 * len(points) else None


def draw_tree(sample: np.ndarray, leaf: int, max_bits: int = MAX_BITS) -> list[tuple[int, int, int, int]]:
    """Nodes ``(vantage, radius, near, far)``; a child that is negative is shard ``-1 - child``."""
    nodes: list[list[int]] = []
    shards = 0

    def grow(points: np.ndarray, depth: int) -> int:
        nonlocal shards
        cut = _split(points, len(nodes) + 1, max_bits) if len(points) > leaf and depth < 40 else None
        if cut is None:
            shards += 1
            return -shards
        at = len(nodes)
        nodes.append([*cut, 0, 0])
        far = np.bitwise_count(points ^ np.uint64(cut[0]))
        nodes[at][2] = grow(points[far <= cut[1] + max_bits], depth + 1)
        nodes[at][3] = grow(points[far > cut[1]], depth + 1)
        return at

    grow(sample, 0)
    return [tuple(n) for n in nodes]


def shards_of(
    points: np.ndarray, nodes: list[tuple[int, int, int, int]], max_bits: int = MAX_BITS
) -> Iterator[tuple[int, np.ndarray]]:
    """``(shard, places in points)`` of every shard that holds some of ``points``."""
    todo = [(0 if nodes else -1, np.arange(len(points)))]
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        if node < 0:
            yield -1 - node, own
            continue
        vantage, radius, near, far = nodes[node]
        away = np.bitwise_count(points[own] ^ np.uint64(vantage))
        todo.append((near, own[away <= radius + max_bits]))
        todo.append((far, own[away > radius]))


class _Forest:
    """Union-find over places; the root is the least place."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def roots(self, places: np.ndarray) -> np.ndarray:
        got = self.up[places]
        while True:
            higher = self.up[got]
            if (higher == got).all():
                return got
            got = higher

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def link_shard(points: np.ndarray, max_bits: int = MAX_BITS) -> Iterator[tuple[int, int]]:
    """Pairs ``(place, least place of its component)`` for points of a shard that link; exact."""
    forest = _Forest(len(points))
    todo = [(np.arange(len(points)), 1)]
    while todo:
        own, depth = todo.pop()
        cut = _split(points[own], depth, max_bits) if len(own) > SMALL and depth < 60 else None
        if cut is None:
            _compare(points, own, forest, max_bits)
            continue
        away = np.bitwise_count(points[own] ^ np.uint64(cut[0]))
        todo.append((own[away <= cut[1] + max_bits], depth + 1))
        todo.append((own[away > cut[1]], depth + 1))
    for i in np.flatnonzero(forest.up != np.arange(len(points))):
        yield int(i), int(forest.root(i))


def _compare(points: np.ndarray, own: np.ndarray, forest: _Forest, max_bits: int) -> None:
    """All pairs of a node, in blocks of rows; links inside a component that is known already are passed over."""
    values = points[own]
    step = max(1, (SMALL * SMALL) // max(len(own), 1))
    for i in range(0, len(own), step):
        a, b = np.nonzero(np.bitwise_count(values[i : i + step, None] ^ values[None, :]) <= max_bits)
        keep = a + i < b
        if not keep.any():
            continue
        roots = forest.roots(own)
        pairs = np.stack([roots[a[keep] + i], roots[b[keep]]])
        for x, y in np.unique(pairs[:, pairs[0] != pairs[1]], axis=1).T:
            forest.join(x, y)


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: least node of each node's component, for ``a, b`` edges (longs).

    Every node points to the least node it knows of; each round a node tells the others around it of
    that one, and pointers are followed. Each round is a written table; rounds grow with the logarithm
    of the longest chain.
    """
    own = edges.select("a", "b").where("a <> b")
    pairs = materialise(own.unionByName(own.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    while True:
        # large star: a node's larger neighbours go to its least; small star: the least takes all
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        spread = join_hot(pairs, least, ["a"], ["b"], how="inner")
        star = spread.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = star.unionByName(least.where("a <> m").select("a", F.col("m").alias("b")))
        star = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        new = materialise(star, "stars")
        changed = new.join(pairs, ["a", "b"], "left_anti").isEmpty() and pairs.join(new, ["a", "b"], "left_anti").isEmpty()
        pairs = new
        if changed:
            break
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node")


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def link_fingerprints(points: DataFrame, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE) -> DataFrame:
    """``fp, root`` for the distinct longs ``fp`` of ``points`` that link with another."""
    spark = points.sparkSession
    ship(spark)
    total = points.count()
    share = min(1.0, sample / max(total, 1))
    some = points.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    drawn = np.array(sorted(r[0] for r in some.collect()), np.int64).view(np.uint64)
    leaf = max(SMALL, int(shard_rows * len(drawn) / max(total, 1)))
    nodes = draw_tree(drawn, leaf) if len(drawn) else []

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            for shard, own in shards_of(fp.view(np.uint64), nodes):
                yield pd.DataFrame({"shard": np.full(len(own), shard, np.int32), "fp": fp[own]})

    def link(shard: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(shard["fp"].to_numpy(np.int64))
        pairs = np.array(list(link_shard(fp.view(np.uint64))), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": fp[pairs[:, 0]], "b": fp[pairs[:, 1]]})

    routed = points.select("fp").mapInPandas(route, "shard int, fp long")
    edges = materialise(routed.groupBy("shard").applyInPandas(link, "a long, b long"), "links")
    return components(edges).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """All rows with ``fingerprint`` (16 hex digits), ``component_id``, the least key reachable over
    fingerprints that differ in at most three bits, and ``representative``, true for one row of each component.

    Texts without words, nulls among them, have fingerprint zero, which links like any other. Null keys
    are never the least unless a component has no other. Repeated rows stay. An empty table gives an
    empty result; columns named like the result's give way, and the text unless it is to be kept.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = without(docs, RESULT if keep_text else (*RESULT, text))

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(_signed(np.array([fingerprint(t) for t in texts], np.uint64)), dtype="int64")

    rows = docs.select(
        packed(kept).alias("row"), docs[key].alias("key"), of(docs[text]).alias("fp"), F.monotonically_increasing_id().alias("id")
    )
    keyed = materialise(rows, "fingerprints")  # the row numbers are fixed by writing them
    first = F.struct(F.col("key").isNull().alias("none"), "key", "id")
    points = materialise(keyed.groupBy("fp").agg(F.min(first).alias("least"), F.count(F.lit(1)).alias("__n")), "points")
    roots = link_fingerprints(points)
    named = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialise(named.select("fp", "least", "root"), "roots")
    least = named.groupBy("root").agg(F.min("least").alias("least"))
    found = named.select("fp", "root").join(least, "root").select("fp", "least")
    done = join_hot(keyed, found, ["fp"], ["id"], how="inner", counts=points.select("fp", "__n"))
    return done.select(
        *unpacked(done), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least.key").alias("component_id"), (F.col("id") == F.col("least.id")).alias("representative"),
    )
