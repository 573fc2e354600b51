import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.functions import hashed as hs
from gleaner.functions import vectors as vc
from gleaner.operators import ann, nearest

VEC = "id BIGINT, vector ARRAY<FLOAT>"


def brute(corpus, queries, k, metric):
    out = []
    for qid, q in queries:
        scored = []
        for i, x in corpus:
            q64, x64 = np.asarray(q, "f4").astype("f8"), np.asarray(x, "f4").astype("f8")
            if metric == "cosine":
                if not x64.any() or not q64.any():
                    continue
                d = 1 - sum(q64 * x64) / math.sqrt(sum(q64 * q64) * sum(x64 * x64))
            else:
                d = sum((q64 - x64) ** 2)
            scored.append((d, i))
        out += [(qid, r + 1, i) for r, (d, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def data(n=300, copies=120, width=8):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=width).astype("f4")]) for i in range(n)]
    hot = rows[5][1]
    rows += [(1000 + i, hot) for i in range(copies)]
    queries = [(i, [float(v) for v in rng.normal(size=width).astype("f4")]) for i in range(15)] + [(99, hot)]
    return rows, queries


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("limit", [1000, 0])
def test_top_k_matches_brute_force(spark, metric, limit):
    rows, queries = data()
    c = spark.createDataFrame(rows, VEC).repartition(5)
    q = spark.createDataFrame(queries, "query_id BIGINT, vector ARRAY<FLOAT>")
    hits = nearest.top_k(c, q, 7, 8, metric, max_broadcast_rows=limit)
    got = sorted((r.query_id, r["rank"], r.id) for r in hits.collect())
    assert got == brute(rows, queries, 7, metric)


def test_a_third_of_the_rows_are_copies(spark):
    rows, queries = data(n=4000, copies=3000)
    c = spark.createDataFrame(rows, VEC).coalesce(1)
    q = spark.createDataFrame(queries, "query_id BIGINT, vector ARRAY<FLOAT>")
    got = sorted((r.query_id, r["rank"], r.id) for r in nearest.top_k(c, q.where("query_id = 99"), 5, 8).collect())
    assert got == [(99, 1, 5)] + [(99, r, 998 + r) for r in range(2, 6)]


def test_fewest_copies():
    import pyarrow as pa

    x = np.array([[1.0, 0.0], [2.0, 0.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0]])
    kept = nearest._fewest_copies(x, pa.array([9, 1, 3, 5, 0]), 2)
    assert kept.tolist() == [1, 2, 3, 4]


def test_several_blocks_give_the_same(spark):
    rows, queries = data()
    c, q = spark.createDataFrame(rows, VEC), spark.createDataFrame(queries, "query_id BIGINT, vector ARRAY<FLOAT>")
    hits = nearest._block_hits(c, q, 4, 8, "cosine", block_rows=6)
    assert sorted((r.query_id, r["rank"], r.id) for r in hits.collect()) == brute(rows, queries, 4, "cosine")


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_gathered_rows_are_passed_over_without_loss(metric):
    """Clusters far apart: most gatherings cannot hold a hit of most questions."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    middles = rng.normal(size=(6, 16)) * 20
    x = np.concatenate([middles[rng.integers(0, 6, 2_000)] + rng.normal(size=(2_000, 16)) for _ in range(4)])
    x[::7] = x[3]
    q = middles[rng.integers(0, 6, 40)] + rng.normal(size=(40, 16))
    best = nearest._Best(q, 5, metric)
    for i in range(0, len(x), 2_000):
        best.add(x[i : i + 2_000], pa.array(np.arange(i, i + 2_000)), np.arange(40))
    exact = nearest._exact(q.repeat(len(x), 0), np.tile(x, (40, 1)), (q**2).sum(1).repeat(len(x)), np.tile((x**2).sum(1), 40), metric).reshape(40, -1)
    for i in range(40):
        want = np.lexsort((np.arange(len(x)), exact[i].round(12)))[:5]
        own = best.table.filter(pa.compute.equal(best.table["q"], i))
        assert np.allclose(own["distance"].to_numpy(), exact[i][want], atol=1e-9)
    assert best.compared < 0.6 * 40 * len(x)


def test_blocks_move_no_corpus_row(spark, monkeypatch):
    plans = []

    def kept(df, label, real=nearest.materialise):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, label)

    monkeypatch.setattr(nearest, "materialise", kept)
    rows, queries = data()
    c, q = spark.createDataFrame(rows, VEC), spark.createDataFrame(queries, "query_id BIGINT, vector ARRAY<FLOAT>")
    nearest.top_k(c, q, 4, 8, max_broadcast_rows=5)
    hits = [plan for label, plan in plans if label == "hits"]
    assert len(hits) == 4
    for plan in hits:  # the one exchange deals out hits: k a question and task
        assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("MapInArrow")


def test_odd_vectors_are_never_hits(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0]), (4, None), (5, [float("nan"), 1.0])], VEC)
    q = spark.createDataFrame([(1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None)], "query_id BIGINT, vector ARRAY<FLOAT>")
    assert [(r.query_id, r.id) for r in nearest.top_k(c, q, 9, 2).collect()] == [(1, 1)]
    l2 = sorted((r.query_id, r.id) for r in nearest.top_k(c, q, 9, 2, "l2").collect())
    assert l2 == [(1, 1), (1, 2), (2, 1), (2, 2)]
    with pytest.raises(ValueError):
        nearest.top_k(c, q, 1, 2, "dot")


def test_string_ids_and_empty_sides(spark):
    c = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0])], "id STRING, vector ARRAY<FLOAT>")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "query_id STRING, vector ARRAY<FLOAT>")
    assert [(r["rank"], r.id) for r in nearest.top_k(c, q, 5, 2).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
    assert nearest.top_k(c.limit(0), q, 5, 2).count() == 0
    assert nearest.top_k(c, q.limit(0), 5, 2).count() == 0


def test_plan_shuffles_only_the_hits(spark):
    rows, queries = data(20, 1)
    c, q = spark.createDataFrame(rows, VEC), spark.createDataFrame(queries, "query_id BIGINT, vector ARRAY<FLOAT>")
    plan = nearest.top_k(c, q, 3, 8)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert plan.count("Exchange") == 1


def test_hashed_counts(spark):
    texts = ["a b a", "Élan élan 12!", "", "...", None, "x" * 50 + " y"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", hs.hashed_counts(F.col("t"), 16).alias("v"))
    for r in df.collect():
        words = [w for w in re.split(r"[^\w]+|_", (r.t or "").lower()) if w]
        want = Counter(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16 for w in words)
        got = None if r.v is None else dict(zip(r.v.indices, r.v["values"]))
        assert got == (dict(want) or None)


def test_densify(spark):
    df = spark.createDataFrame([("a b c a",), ("",)], "t STRING").select(hs.hashed_counts(F.col("t"), 8).alias("v"))
    for r in df.select("v", hs.densify(F.col("v"), 8).alias("d")).collect():
        if r.v is None:
            assert r.d is None
        else:
            want = [0.0] * 8
            for i, x in zip(r.v.indices, r.v["values"]):
                want[i] = x
            assert r.d == want


def test_vector_functions(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 2.0])]
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame(rows, "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>").select(
        vc.cosine_distance(a, b).alias("c"), vc.l2_squared(a, b).alias("l"), vc.normalize(a).alias("n"),
        vc.fits_width(a, 2).alias("f"), vc.limit_dimensions(b, 1).alias("d"),
    )
    r = df.collect()
    assert abs(r[0].c - 0.04) < 1e-12 and r[0].l == 2.0 and r[0].n == [0.6, 0.8] and r[0].f and r[0].d == [4.0]
    assert r[1].c is None and r[1].n == [0.0, 0.0]
    assert r[2].c is None and r[2].l is None and not r[2].f


def test_ann_recall(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(800)]
    c = spark.createDataFrame(rows, VEC)
    q = c.where("id < 40").selectExpr("id AS query_id", "vector")
    index = ann.build(c, str(tmp_path / "cells"), 8, cells=10)
    true = {(r.query_id, r.id) for r in nearest.top_k(c, q, 5, 8).collect()}
    some = index.search(q, 5, probe=4, max_probe=7).collect()
    assert len({(r.query_id, r.id) for r in some} & true) / len(true) >= 0.9
    for r in some:  # what is certified is exact
        assert not r.certified or (r.query_id, r.id) in true
    every = index.search(q, 5, probe=1).collect()
    assert {(r.query_id, r.id) for r in every} == true and all(r.certified for r in every)


def test_ann_leaves_far_cells_alone(spark, tmp_path):
    rng = np.random.default_rng(7)
    middles = np.eye(8)[:6] * 10
    rows = [(i, [float(v) for v in middles[i % 6] + rng.normal(size=8) * 0.1]) for i in range(600)]
    c = spark.createDataFrame(rows + [(9_000 + i, rows[4][1]) for i in range(200)], VEC)
    q = c.where("id < 30").selectExpr("id AS query_id", "vector")
    index = ann.build(c, str(tmp_path / "cells"), 8, cells=6)
    found = index.search(q, 5, probe=1, max_probe=1).collect()
    assert all(r.certified for r in found)
    assert {(r.query_id, r.id) for r in found} == {(r.query_id, r.id) for r in nearest.top_k(c, q, 5, 8).collect()}
    assert index.search(q.limit(0), 5, probe=1).count() == 0
    few = index.search(q.limit(1), 1_000, probe=1, max_probe=2).collect()  # more than there are: nothing is certified
    assert not any(r.certified for r in few)
    assert index.search(q.limit(1), 1_000, probe=1).count() == 800
