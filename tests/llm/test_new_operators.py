"""Exact copies, periodic runs and the divergence of sources: brute force, edges of input, SQL on made-up rows."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import divergence, exact_copies, queries_copies, queries_divergence, queries_runs, runs
from gleaner.llm.common import maybe_among
from tests.oracle import normal

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [
    (1, None, "en", "a", 7, "x"), (2, "", None, None, 7, "x"), (3, "one two three", "en", "a", 7, "x"),
    (3, "one two three", "en", "a", 7, "x"), (None, "Tie tie\n tie", "de", None, 7, "x"), (None, "Tie  tie\n tie", "de", "", 7, "x"),
    (5, "long word " * 20_000, "en", "b", 7, "x"), (6, "ünï cödé ✓ 日本\u0085x", "fr", "b", None, None), (7, "one\ttwo\x0bthree", "en", "c", 1, "y"),
    (8, "a " * 30_000, "en", "b", 7, "x"), (9, "one twothree  ", "en", "b", 7, "x"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string, kept long, place string")


def plain_runs(w):
    """Maximal stretches by every lag; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            s = i - q
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - s >= max(6, 4 * q):
                found.setdefault((s, i), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    r = plain_runs(w)
    gone = {i for s, length, q in r for i in range(s + q, s + length)}
    top = min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in r)
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)]
    return (doc_id, len(r), *top, 1000 * top[1] // top[2] if r else None, *digests)


def test_runs_of_random_words():
    r = np.random.default_rng(5)
    for _ in range(600):
        n, letters = int(r.integers(0, 70)), int(r.integers(1, 4))
        w = r.integers(0, letters, n)
        if n and r.random() < 0.7:  # a power, somewhere
            root = r.integers(0, letters, int(r.integers(1, 7)))
            a = int(r.integers(0, n))
            w[a:] = np.resize(root, n - a)
        cut = int(r.integers(0, n + 1))
        doc = np.r_[np.zeros(cut, np.int64), np.ones(n - cut, np.int64)]
        start, end, period = runs.find_runs(w, doc)
        got = sorted(zip(start.tolist(), (end - start).tolist(), period.tolist()))
        want = plain_runs(w[:cut].tolist()) + [(s + cut, length, q) for s, length, q in plain_runs(w[cut:].tolist())]
        assert got == sorted(want)


def test_runs_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries_runs.op13(spark, SF).collect())
    assert got == sorted(plain_row(d.doc_id, d.text) for d in docs)


def test_runs_edges(spark, edges, tmp_path):
    got = runs.with_runs(edges, keep_text=False).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(EDGES) and by_id[6].kept is None and by_id[7].place == "y"
    assert (by_id[1].n_words, by_id[1].runs, by_id[1].collapsed) == (0, [], "") and by_id[2].collapsed == ""
    assert [tuple(x) for x in by_id[5].runs] == [(0, 40_000, 2)] and by_id[5].collapsed == "long word"
    assert [tuple(x) for x in by_id[8].runs] == [(0, 30_000, 1)] and by_id[8].collapsed == "a"
    assert by_id[6].collapsed == "ünï cödé ✓ 日本\u0085x" and by_id[7].collapsed == "one two three"
    assert runs.with_runs(edges.limit(0)).count() == 0
    clash = edges.withColumn("Runs", F.lit(1)).withColumn("n_words", F.lit("z"))
    assert len(set(map(str.lower, runs.with_runs(clash).columns))) == len(runs.with_runs(clash).columns)
    edges.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    rows = [r for r in queries_runs.op13(spark, str(tmp_path)).collect() if r.doc_id not in (5, 8)]
    want = [plain_row(d, t) for d, t, *_ in EDGES if d not in (5, 8)]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def plain_copies(rows):
    groups = {}
    for i, (key, text) in enumerate(rows):
        groups.setdefault("".join(WORD.findall(text or "")), []).append((-len(text or ""), key is None, key or 0, i))
    out = []
    for norm, own in groups.items():
        own.sort()
        for place, (_, none, key, _) in enumerate(own):
            first = None if own[0][1] else own[0][2]
            out.append((None if none else key, first, len(own), place == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [F.md5, lambda x: F.substring(F.md5(x), 1, 1), lambda x: F.lit("same")])
def test_copies_and_collisions(spark, edges, digest):
    """With a hash of four bits, and with none at all, the bytes alone tell texts apart."""
    got = exact_copies.exact_duplicates(edges, keep_text=False, digest=digest)
    rows = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()]
    assert sorted(rows, key=repr) == plain_copies([(d, t) for d, t, *_ in EDGES])
    assert [f.name for f in got.schema] == ["doc_id", "lang", "source", "place", "keep_id", "group_size", "kept", "text_sha256"]


def test_copies_of_a_hot_group(spark):
    rows = [(i, "hot  text" if i % 3 == 0 else f"text {i // 2}") for i in range(9_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = exact_copies.exact_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=repr) == plain_copies(rows)
    assert exact_copies.exact_duplicates(docs.limit(0)).count() == 0


def test_copies_are_native(spark):
    plan = queries_copies.op11(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_marked_keys_lose_nothing(spark):
    keys = spark.range(0, 4_000, 2).select(F.xxhash64("id").alias("code"))
    for words in (1 << 20, 4):
        left = {r.id for r in maybe_among(spark.range(4_000), F.xxhash64("id"), keys, most_words=words).collect()}
        assert left >= set(range(0, 4_000, 2)) and (words == 4 or len(left) < 2_400)
    assert maybe_among(spark.range(10), F.col("id"), keys.limit(0)).count() == 0


def audit_both(spark, df):
    con = duckdb.connect()
    table = df.select("doc_id", "lang", "source", "text").toArrow()
    con.register("documents", table)
    cur = con.execute(queries_divergence.SQL)
    names = [d[0] for d in cur.description]
    got = divergence.audit_sources(df)
    return normal(got.columns, [tuple(r) for r in got.collect()]), normal(names, cur.fetchall())


def test_divergence_against_sql(spark, edges):
    got, want = audit_both(spark, edges)
    assert got == want and any(r for r in got)  # no term is in ten documents: pairs of value 0
    # terms near the limit of ten documents, in forms that are other chunks
    r = np.random.default_rng(3)
    words = ["Tide", "tide,", "TIDE", "sea", "sea-bed", "a1b", "é", "日本", "1", "...", "ebb"]
    rows = [
        (i, ["en", "de", None][i % 3], f"s{i % 4}", " ".join(words[j] for j in r.integers(0, len(words), int(r.integers(0, 5)))))
        for i in range(150)
    ]
    got, want = audit_both(spark, spark.createDataFrame(rows, "doc_id long, lang string, source string, text string"))
    assert got == want and {x[2] for x in got} == {"pair", "term"}
    assert divergence.audit_sources(edges.limit(0)).count() == 0


def test_divergence_ignores_other_columns(spark, edges):
    more = edges.withColumn("term", F.lit("x")).withColumn("chunk", F.lit(1)).withColumn("n", F.lit(2))
    assert sorted(map(tuple, divergence.audit_sources(more).collect())) == sorted(map(tuple, divergence.audit_sources(edges).collect()))
