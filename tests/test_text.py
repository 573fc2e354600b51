import random

from pyspark.sql import functions as F

from gleaner.functions import text as tx


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def test_fixed_3_rounds_as_python_does(spark):
    rng = random.Random(1)
    xs = [rng.uniform(-1, 1) for _ in range(3000)] + [j / 16 for j in range(-16, 17)]
    xs += [0.1235, 0.3125, 0.0005, 0.9995, 0.99949999, 1.0005, -0.0001, 0.0, 1.0, 2.0, 0.2675, 0.0015]
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE").select("x", tx.fixed_3(F.col("x")).alias("v"))
    for r in df.collect():
        assert r.v == f"{r.x:.3f}", r.x


def test_size_mb_rounds_as_python_does(spark):
    rng = random.Random(2)
    sizes = [0, 1, 5242, 5243, 1048576, 5242880, 1310720, 655360, 20971520]
    sizes += [rng.randrange(0, 10**9) for _ in range(2000)]
    df = spark.createDataFrame([(n,) for n in sizes], "n BIGINT").select("n", tx.size_mb(F.col("n")).alias("v"))
    for r in df.collect():
        assert r.v == round(r.n / (1024 * 1024), 2), r.n


def test_strip_is_unicode_aware(spark):
    rows = ["  a b ", "\n\t x\r\n", "  é　", "\x1cq\x1f", "", "   ", "a\x0b\x0c"]
    df = spark.createDataFrame([(s,) for s in rows], "s STRING").select("s", tx.strip_text(F.col("s")).alias("v"))
    for r in df.collect():
        assert r.v == r.s.strip()


def test_truncation_at_the_cap(spark):
    rows = ["abc", "abcd", "abcde", "ab😀de", ""]
    df = spark.createDataFrame([(s,) for s in rows], "s STRING").select(
        tx.truncate_ellipsis(F.col("s"), 4).alias("e"),
        tx.truncate_marker(F.col("s"), 4).alias("m"),
        tx.truncate_hard(F.col("s"), 4).alias("h"),
        tx.truncate_hard(F.col("s"), None).alias("n"),
    )
    got = [tuple(r) for r in df.collect()]
    assert got[0] == ("abc", "abc", "abc", "abc")
    assert got[1] == ("abcd", "abcd", "abcd", "abcd")
    assert got[2] == ("abcd...", "abcd\n[Context truncated]", "abcd", "abcde")
    assert got[3] == ("ab😀d...", "ab😀d\n[Context truncated]", "ab😀d", "ab😀de")
    assert got[4] == ("", "", "", "")


def test_small_functions(spark):
    row = spark.range(1).select(
        tx.line_count(F.lit("a\nb\n")).alias("lines"),
        tx.page_join(F.array(F.lit("p1"), F.lit("p2"))).alias("pages"),
        tx.file_extension(F.lit("/a.b/c.TXT")).alias("ext"),
        tx.file_extension(F.lit("/a.b/noext")).alias("none"),
        tx.file_extension(F.lit("/a/.hidden")).alias("hidden"),
        tx.base_name(F.lit("/a.b/c.TXT")).alias("base"),
        tx.encoding_rule(F.lit("ascii")).alias("enc"),
        tx.contains_any(F.lit("abc"), ["x", "bc"]).alias("hit"),
        tx.contains_any(F.lit("abc"), []).alias("nohit"),
        tx.first_present(F.lit(""), F.lit("b")).alias("first"),
        tx.to_base64(F.lit(b"x" * 100)).alias("b64"),
    ).first()
    assert row.lines == 3 and row.pages == "p1\n--- Page Break ---\np2"
    assert (row.ext, row.none, row.hidden, row.base) == (".txt", "", "", "c.TXT")
    assert row.enc == "utf-8" and row.hit is True and row.nohit is False and row["first"] == "b"
    assert "\n" not in row.b64 and len(row.b64) == 136


def test_import_names(spark):
    lines = ["import a.b", "from x import y", "  import z", "from eder thes", "fromage is", "import  été.1x", "imports q", ""]
    df = spark.createDataFrame([(s,) for s in lines], "s STRING").select(tx.import_name(F.col("s")).alias("v"))
    assert values(df) == ["a.b", "x", None, "eder", None, "été.1x", None, None]


def test_response_text(spark):
    block = "array<struct<type:string,text:string>>"
    rows = [("plain", None), (None, [("text", "a"), ("tool", "x"), ("text", "b")]), ("", [("tool", "x")]), (None, None)]
    df = spark.createDataFrame(rows, f"p STRING, b {block}").select(tx.response_text(F.col("p"), F.col("b")).alias("v"))
    assert values(df) == ["plain", "a\nb", None, None]
