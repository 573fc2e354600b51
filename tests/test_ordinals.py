import pytest
from pyspark.sql import functions as F

from gleaner.operators import ordinals as od
from gleaner.sources import collection as co
from gleaner.sources import corpus


def rows(spark):
    """Key 0 holds a third of the rows."""
    data = [(0 if i % 3 == 0 else i % 50, (i * 7919) % 3001, i % 2) for i in range(3000)]
    return data, spark.createDataFrame(data, "k INT, o INT, v INT").repartition(6)


@pytest.mark.parametrize("min_rows", [0, 100, 10**6])
def test_ordinal_per_key_and_global(spark, min_rows):
    data, df = rows(spark)
    placed = od.with_ordinal(df, ["o"], ["k"], min_rows=min_rows)
    got = {(r.k, r.o): r.pos for r in placed.collect()}
    want, seen = {}, {}
    for k, o, _ in sorted(data, key=lambda r: (r[0], r[1])):
        want[(k, o)] = seen.get(k, 0)
        seen[k] = want[(k, o)] + 1
    assert got == want
    flat = [r.pos for r in od.with_ordinal(df, ["o"], (), "pos", 5).orderBy("o").collect()]
    assert flat == list(range(5, 3005))


@pytest.mark.parametrize("min_rows", [0, 1, 10])
def test_null_keys_are_a_group(spark, min_rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k STRING, o INT")
    got = sorted((str(r.k), r.o, r.pos) for r in od.with_ordinal(df, ["o"], ["k"], min_rows=min_rows).collect())
    assert got == [("None", 1, 0), ("None", 2, 1), ("a", 1, 0)]


@pytest.mark.parametrize("min_rows", [0, 100, 10**6])
def test_running_sum(spark, min_rows):
    data, df = rows(spark)
    got = {(r.k, r.o): r.s for r in od.with_running_sum(df, "v", ["o"], ["k"], "s", min_rows).collect()}
    total, want = {}, {}
    for k, o, v in sorted(data, key=lambda r: (r[0], r[1])):
        total[k] = total.get(k, 0) + v
        want[(k, o)] = total[k]
    assert got == want


@pytest.mark.parametrize("min_rows", [100, 10**6])
def test_pages_hold_everything_in_order(spark, min_rows):
    data, df = rows(spark)
    pages = od.paged_text(df, ["k"], ["o"], F.col("o").cast("string"), "t", ",", 10, min_rows).collect()
    joined = {}
    for r in sorted(pages, key=lambda r: (r.k, r.page)):
        assert len(r.t.split(",")) <= 10
        joined.setdefault(r.k, []).extend(r.t.split(","))
    for k in joined:
        assert joined[k] == [str(o) for kk, o, _ in sorted(data) if kk == k]


@pytest.mark.parametrize("min_rows", [10, 1_000_000])
def test_pages_are_bounded_by_bytes(spark, min_rows):
    data = [(k, o, "x" * n) for k in (1, None) for o, n in enumerate([3, 3, 9, 2, 30, 4, 4, 4, 1, 0, 11, 5, 5, 5, 5, 1] * 3)]
    df = spark.createDataFrame(data, "k INT, o INT, t STRING")
    pages = od.paged_lists(df, ["k"], ["o"], F.struct("o", "t"), "e", 6, min_rows, F.octet_length("t"), 20).collect()
    for key in (1, None):
        own = [[(e.o, e.t) for e in r.e] for r in sorted((r for r in pages if r.k == key), key=lambda r: r.page)]
        assert [e for page in own for e in page] == [(o, t) for k, o, t in data if k == key]
        assert all(len(page) <= 6 and (len(page) == 1 or sum(len(t) for _, t in page) <= 20) for page in own)
    free = od.paged_lists(df, ["k"], ["o"], F.col("o"), "e", 100, min_rows, F.octet_length("t"))
    assert sorted(r.page for r in free.collect()) == [0, 0]


def test_positions_move_thin_keys_only(spark, tmp_path):
    data = [(i * 7 % 101, f"{i}" * 5) for i in range(101)] + [(None, "none")]
    spark.createDataFrame(data, "i INT, t STRING").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    want = {t: p + 5 for p, (_, t) in enumerate(sorted(data, key=lambda r: -1 if r[0] is None else r[0]))}
    got = od.with_late_position(df, ["i"], start=5)
    assert {r.t: r.pos for r in got.collect()} == want and got.columns == ["i", "t", "pos"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "rangepartitioning" in line]
    assert "t" not in od.key_positions(df, ["i"]).columns
    twice = df.unionByName(df)
    assert od.key_positions(twice, ["i"]) is None
    assert sorted(r.pos for r in od.with_late_position(twice, ["i"]).collect()) == list(range(204))


def test_join_hot_salts_and_keeps_rows(spark):
    data, df = rows(spark)
    small = spark.createDataFrame([(k, k * 10) for k in range(40)], "k INT, w INT")
    plain = sorted(map(repr, df.join(small, "k", "left").collect()))
    hot = od.join_hot(df, small, ["k"], ["o"], min_rows=0, share=0.1)
    assert "__salt" in hot._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, hot.select("k", "o", "v", "w").collect())) == plain
    inner = od.join_hot(df, small, ["k"], ["o"], "inner", min_rows=0, share=0.1)
    assert inner.count() == df.join(small, "k").count()


def test_scratch_is_dropped(spark):
    from gleaner.session import drop_scratch, materialise

    kept = materialise(spark.range(3), "x")
    path = kept.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    import os

    assert os.path.exists(path)
    drop_scratch(spark)
    assert not os.path.exists(path)


@pytest.mark.parametrize("thin", [0, 1000])
def test_key_totals(spark, thin):
    data, df = rows(spark)
    totals = od.with_key_totals(df, ["k"], ["o"], min_rows=0, thin_keys=thin, t=F.sum("v"))
    got = {(r.k, r.o): r.t for r in totals.collect()}
    want = {}
    for k, _, v in data:
        want[k] = want.get(k, 0) + v
    assert all(got[(k, o)] == want[k] for k, o, _ in data) and len(got) == 3000


@pytest.mark.parametrize("thin", [0, 1000])
def test_key_totals_of_a_null_key(spark, thin):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("", 3, 7)], "k STRING, o INT, v INT")
    totals = od.with_key_totals(df, ["k"], ["o"], min_rows=0, thin_keys=thin, t=F.sum("v"))
    assert totals.columns == ["k", "o", "v", "t"]
    assert sorted((r.o, r.t) for r in totals.collect()) == [(1, 11), (2, 11), (3, 7)]


def test_join_hot_spreads_null_keys_and_keeps_them(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(200)], "k STRING, o INT")
    small = spark.createDataFrame([("a", 1)], "k STRING, w INT")
    got = od.join_hot(df, small, ["k"], ["o"], min_rows=0, share=0.1)
    assert sorted((r.o, r.w) for r in got.collect()) == [(i, None if i % 2 else 1) for i in range(200)]


def test_flat_index_and_batches(spark):
    df = spark.createDataFrame([(3, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "i INT, vector ARRAY<DOUBLE>")
    index, width = co.flat_index(df, ["i"])
    assert width == 2 and sorted((r.i, r.pos) for r in index.collect()) == [(1, 0), (2, 1), (3, 2)]
    bad = df.unionByName(spark.createDataFrame([(9, [1.0])], "i INT, vector ARRAY<DOUBLE>"))
    with pytest.raises(Exception, match="not 2 wide"):
        co.flat_index(bad, ["i"])[0].collect()
    got = sorted((r.i, r.batch, r.batches) for r in co.batch_numbers(df, ["i"], 2).collect())
    assert got == [(1, 1, 2), (2, 1, 2), (3, 2, 2)]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "id STRING, document STRING")
    store = co.Collection(str(tmp_path / "c"))
    store.replace(rows)
    opened = store.read(spark)
    bad = rows.withColumn("document", F.when(F.col("id") == "b", F.raise_error(F.lit("broken"))).otherwise(F.col("document")))
    for write in (store.replace, store.append):  # the table is not whole
        with pytest.raises(Exception, match="broken"):
            write(bad)
    for step in ("_write", "_commit"):  # the table, then the version is never written
        with monkeypatch.context() as m:
            m.setattr(co.Collection, step, lambda *a, **k: 1 / 0)
            for write in (store.replace, store.append):
                with pytest.raises(ZeroDivisionError):
                    write(rows.limit(1))
        assert store.read(spark).count() == 2 and store.version(spark).number == 1
    before = store.version(spark)
    store.replace(rows.limit(1))
    assert store.read(spark).count() == 1 and opened.count() == 2  # a reader stays on its version
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit(spark, before, rows.schema, [])
    other = co.Collection(store.path, "l2", "hash-8", 8)
    other.replace(rows)  # rows and settings change together
    assert co.open_collection(spark, store.path) == other
    other.drop_unused(spark)
    assert other.read(spark).count() == 2 and len(list((tmp_path / "c").glob("rows-*"))) == 1


def test_collections_without_versions_are_read_on(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x")], "id STRING, document STRING")
    rows.write.parquet(str(tmp_path / "c/rows"))
    spark.sql("SELECT 'l2' metric, 'hash-8' model, 8 width").write.parquet(str(tmp_path / "c/settings"))
    store = co.open_collection(spark, str(tmp_path / "c"))
    assert store == co.Collection(store.path, "l2", "hash-8", 8) and store.version(spark).number == 0
    store.append(rows)
    assert store.read(spark).count() == 2 and store.version(spark).number == 1


def test_collection(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "id STRING, document STRING")
    store = co.Collection(str(tmp_path / "c"), model="hash-8", width=8)
    assert not store.exists(spark)
    assert store.fill_if_empty(rows) and not store.fill_if_empty(rows)
    more = spark.createDataFrame([("b", "z"), ("c", "z"), ("c", "z")], "id STRING, document STRING")
    store.append_new(more)
    store.append_new(more)
    assert sorted(tuple(r) for r in store.read(spark).collect()) == [("a", "x"), ("b", "y"), ("c", "z")]
    assert co.open_collection(spark, store.path) == store
    store.check("hash-8", "cosine", 8)
    with pytest.raises(ValueError, match="asked with"):
        store.check("hash-16", "cosine", 16)
    store.replace(rows.limit(1))
    assert store.read(spark).count() == 1


@pytest.mark.parametrize("last", [20_000, 10])
def test_the_first_rows_by_their_nth_key(spark, monkeypatch, last):
    """One way for every number of rows; keys with nulls, copies, and a key of a third of all rows."""
    monkeypatch.setattr(corpus, "LAST_KEYS", last)
    monkeypatch.setattr(corpus, "BOUND_SAMPLE", 400)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{i * 7919 % 1000:03d}", i, "x" * 50) for i in range(1_000)]
    df = spark.createDataFrame(rows, "k STRING, i INT, text STRING").repartition(5)
    by_both = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for n in (500,) if last == 10 else (20, 500, 1_000):
        assert sorted(r.i for r in corpus.ingest_limit(df, n, ["k", "i"]).collect()) == sorted(r[1] for r in by_both[:n])
        assert sorted(r.i for r in corpus.ingest_limit(df, n, ["i"]).collect()) == list(range(n))
        some = corpus.ingest_limit(df, n, ["k"]).collect()
        assert len(some) == n and sorted((r.k or "") for r in some) == sorted((r[0] or "") for r in by_both[:n])
    assert corpus.ingest_limit(df, 1_001, ["i"]).count() == 1_000 and corpus.ingest_limit(df.limit(0), 3, ["k"]).count() == 0


def test_a_limit_moves_no_row(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = corpus.ingest_limit(df, 150, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "PushedFilters: [Or(" in plan
