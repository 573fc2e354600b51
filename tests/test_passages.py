from pyspark.sql import functions as F

from gleaner.operators import passages as ps

SCHEMA = "id STRING, type STRING, level STRING, context STRUCT<title: ARRAY<STRING>, sentences: ARRAY<ARRAY<STRING>>>"


def samples(spark):
    rows = [
        ("a", "t", None, (["T0", "T1"], [["s1", "s2"], ["it's"]])),
        ("b", None, None, ([], [])),
        ("c", None, "l", (["T0", "T1", "T2"], [["x"], []])),
        ("d", None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_unnest(spark):
    got = sorted((r.id, r.document) for r in ps.passages_base(samples(spark)).collect())
    assert got == [("a_0", "T0 : s1; s2"), ("a_1", "T1 : it's"), ("c_0", "T0 : x"), ("c_1", "T1 : ")]
    got = sorted((r.id, r.document) for r in ps.passages_ctx(samples(spark)).collect())
    assert got == [("a_ctx1", "T0 : s1 s2"), ("a_ctx2", "T1 : it's"), ("c_ctx1", "T0 : x"), ("c_ctx2", "T1 : ")]


def test_one_document(spark):
    got = {r.id: r.document for r in ps.sample_document(samples(spark)).collect()}
    assert got["a"] == "T0 : s1 s2, T1 : it's" and got["b"] == "" and got["c"] == "T0 : x, T1 : "
    got = {r.id: r.document for r in ps.sample_document_list_text(samples(spark)).collect()}
    sentences = [["s1", "s2"], ["it's"]]
    assert got["a"] == f"T0 : {sentences[0]} T1 : {sentences[1]}"


def test_pairs(spark):
    rows = [("a", [("T", ["x", "y"]), (None, ["z"]), ("U", None)]), ("b", [])]
    df = spark.createDataFrame(rows, "id STRING, context ARRAY<STRUCT<title: STRING, sentences: ARRAY<STRING>>>")
    got = {r.id: r.document for r in ps.sample_document_pairs(df).collect()}
    assert got == {"a": "T : x y, title[1] : z, U : ", "b": ""}


def test_ids_and_metadata(spark):
    rows = [("x", "y", 0), ("", "y", 1), (None, None, 2), ("", "", 3)]
    df = spark.createDataFrame(rows, "id STRING, _id STRING, idx BIGINT")
    out = df.select(ps.derive_id(F.col("idx"), "hotpot_", F.col("id"), F.col("_id")).alias("v"))
    assert [r.v for r in out.collect()] == ["x", "y", "hotpot_2", "hotpot_3"]
    m = samples(spark).select(
        "id", ps.metadata_default(F.col("type"), F.col("level")).alias("d"),
        ps.metadata_sparse(F.col("type"), F.col("level")).alias("s"),
    )
    got = {r.id: (r.d, r.s) for r in m.collect()}
    assert got["a"] == ({"type": "t", "level": "unknown"}, {"type": "t"})
    assert got["b"] == ({"type": "unknown", "level": "unknown"}, None)
    assert got["c"][1] == {"level": "l"}
