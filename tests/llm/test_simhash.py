"""SimHash groups against brute force."""

import re

import numpy as np
import pytest
import xxhash

from gleaner.llm import simhash
from gleaner.llm.simhash import draw_tree, fingerprint, link_fingerprints, link_shard, near_duplicates, shards_of

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(values, max_bits=3):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def clustered(n, seed):
    r = np.random.default_rng(seed)
    centres = r.integers(0, 2**63, n // 6, dtype=np.uint64)
    points = [int(c) for c in centres]
    while len(points) < n:
        p = points[r.integers(0, len(points))]
        for bit in r.choice(64, r.integers(1, 5), replace=False):
            p ^= 1 << int(bit)
        points.append(p)
    return np.unique(np.array(points, np.uint64))


@pytest.mark.parametrize("text", ["", None, "one", "Two words", "É É É", "a b c d A B C D", "x\x1cy z w q", "a b c " * 4000])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize(("small", "max_bits"), [(4, 3), (64, 3), (4, 6), (64, 6), (4, 0)])
def test_shards_and_trees_lose_no_link(monkeypatch, small, max_bits):
    monkeypatch.setattr(simhash, "SMALL", small)
    points = clustered(500, 3)
    nodes = draw_tree(points[::3], 20, max_bits)
    edges = []
    for _, own in shards_of(points, nodes, max_bits):
        edges += [(own[a], own[b]) for a, b in link_shard(points[own], max_bits)]
    assert len(nodes) > 3
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(points))] == brute_groups([int(p) for p in points], max_bits)


def test_components_of_a_long_chain(spark):
    chain = [((i * 37) % 200, ((i + 1) * 37) % 200) for i in range(150)]
    edges = spark.createDataFrame([(a, b) for a, b in chain] + [(900, 901), (901, 902), (7, 7)], "a long, b long")
    got = dict(tuple(r) for r in simhash.components(edges).collect())
    nodes = {n for e in chain for n in e}
    assert {got[n] for n in nodes} == {min(nodes)} and got[902] == got[901] == got[900] == 900 and 7 not in set(got) - nodes


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    ids = sorted(rows)
    values = [brute_fingerprint(rows[i]) for i in ids]
    groups = brute_groups(values)
    want = {(i, f"{v:016x}", ids[g]) for i, v, g in zip(ids, values, groups)}
    got = near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert len({g for g in groups}) < len(ids)


def test_small_shards(spark):
    points = clustered(900, 5)
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    got = {r.fp: r.root for r in link_fingerprints(df, shard_rows=40, sample=400).collect()}
    groups = brute_groups([int(p) for p in points])
    by = {}
    for p, g in zip(points.view(np.int64), groups):
        by.setdefault(g, []).append(int(p))
    for members in by.values():
        if len(members) > 1:
            assert {got[m] for m in members} == {min(members)}
        else:
            assert members[0] not in got


def test_edges_of_input(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "one two three four", "c"), (4, "one two three four", "d"), (4, "one two three four", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = near_duplicates(df)
    assert got.columns == ["doc_id", "text", "fingerprint", "component_id", "representative"]
    assert got.where("representative").count() == got.select("component_id").distinct().count()
    out = sorted((r.doc_id or 0, r.component_id) for r in got.collect())
    assert out == [(0, 4), (1, 1), (2, 1), (4, 4), (4, 4)]
    assert near_duplicates(df.limit(0)).count() == 0
