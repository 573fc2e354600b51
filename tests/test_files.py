import gzip
import hashlib
import io
import os
import zipfile
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleaner.operators import files as fl
from gleaner.operators import models as md
from gleaner.plans import intake
from gleaner.sources import corpus
from suite import scans

SCHEMA = "path STRING, batch STRING, content BINARY, length BIGINT, exists BOOLEAN, is_file BOOLEAN"


def docx(*paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{ns}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def table(spark, *files):
    rows = [(p, "b", bytearray(c), len(c), True, True) for p, c in files]
    return spark.createDataFrame(rows, SCHEMA)


PNG = b"\x89PNG\r\n\x1a\nxx"


def test_docx_is_read_piecewise_within_its_budget():
    data = docx("one", "", "two")
    assert fl._docx_text(data) == "one\n\ntwo"
    size = zipfile.ZipFile(io.BytesIO(data)).getinfo("word/document.xml").file_size
    assert fl._docx_text(data, size) == "one\n\ntwo" and fl._docx_text(data, size - 1) is None
    for broken in (b"", data[:40], data[: len(data) // 2], data.replace(b"<w:p>", b"<w:q>", 1), b"PK\x03\x04" + b"x" * 50):
        assert fl._docx_text(broken) is None
    nested = docx("a</w:t><w:tab/><w:t>b</w:t><w:br/><w:t>c")
    assert fl._docx_text(nested) == "a\tb\nc"


def test_reasons(spark):
    rows = [
        ("/d/gone.txt", "b", bytearray(b"x"), 1, False, True),
        ("/d/dir.txt", "b", bytearray(b"x"), 1, True, False),
        ("/d/empty.txt", "b", bytearray(b""), 0, True, True),
        ("/d/a.exe", "b", bytearray(b"x"), 1, True, True),
        ("/d/bad.txt", "b", bytearray(b"\xff\xfe\xfa"), 3, True, True),
        ("/d/ok.TXT", "b", bytearray("é".encode()), 2, True, True),
        ("/d/ok.json", "b", bytearray(b"{}"), 2, True, True),
        ("/d/fake.png", "b", bytearray(b"text"), 4, True, True),
        ("/d/ok.png", "b", bytearray(PNG), len(PNG), True, True),
        ("/d/text.txt", "b", bytearray(PNG), len(PNG), True, True),
        ("/d/ok.docx", "b", bytearray(docx("x")), 9, True, True),
        ("/d/pic.svg", "b", bytearray(b"<svg/>"), 6, True, True),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.name: r.reason for r in fl.validated(df).collect()}
    assert got["gone.txt"] == "File not found: /d/gone.txt"
    assert got["dir.txt"] == "Path is not a file: /d/dir.txt"
    assert got["empty.txt"] == "File is empty: /d/empty.txt"
    assert got["a.exe"] == "Unsupported file type: .exe"
    for bad in ("bad.txt", "fake.png", "text.txt"):
        assert got[bad] == f"Invalid file content for: /d/{bad}"
    assert all(got[n] is None for n in ("ok.TXT", "ok.json", "ok.png", "ok.docx", "pic.svg"))
    strict = {r.name: r.reason for r in fl.validated(df, strict=True).collect()}
    assert strict["ok.json"] and strict["pic.svg"] and strict["ok.TXT"] is None


def test_gate_at_the_cap(spark):
    rows = [("a", "x", None, 15 << 20, True, True), ("b", "x", None, 5 << 20, True, True),
            ("c", "y", None, 20 << 20, True, True), ("d", "y", None, 1, True, True)]
    got = {r.path: (r.total_bytes, r.accepted) for r in fl.size_gate(spark.createDataFrame(rows, SCHEMA), "batch").collect()}
    assert got["a"] == got["b"] == (20 << 20, True) and got["c"] == got["d"] == ((20 << 20) + 1, False)


def test_conversion(spark):
    df = table(spark, ("/a.txt", "l1\nl2".encode()), ("/b.docx", docx("p1", "p2")), ("/c.png", PNG), ("/d.docx", b"junk"))
    out = fl.files_to_text(md.with_file_type(fl.file_info(df)))
    got = {r.name: (r.text, r.line_count) for r in out.collect()}
    assert got["a.txt"] == ("l1\nl2", 2) and got["b.docx"] == ("p1\np2", None) and got["d.docx"] == (None, None)
    assert got["c.png"][0].startswith("iVBOR")


def test_intake(spark):
    df = table(spark, ("/a.txt", b" hi \n"), ("/c.png", PNG), ("/p.pdf", b"%PDF-1.4 x"), ("/n.txt", b"  \n"))
    schema = "batch STRING, chat_id BIGINT, model_nm STRING"
    full = intake.file_intake(df, spark.createDataFrame([("b", 1, "claude-sonnet-4-0")], schema), "batch")
    got = {r.name: (r.error, r.part) for r in full.collect()}
    assert got["a.txt"][1].text == "hi" and got["c.png"][1].type == "image" and got["p.pdf"][1].mime_type == "application/pdf"
    assert got["n.txt"][1] is None
    plain = intake.file_intake(df, spark.createDataFrame([("b", 1, "gpt-4o-mini")], schema), "batch")
    got = {r.name: r.error for r in plain.collect()}
    assert got["a.txt"] is None and got["c.png"] == "not accepted by model"
    small = intake.file_intake(df, spark.createDataFrame([("b", 1, "gpt-4o")], schema), "batch", cap=3)
    assert all(r.error.startswith("FATAL ERROR: Total size") and r.part is None for r in small.collect())
    assert intake.file_intake(df, spark.createDataFrame([("b", 1, "llama3.2")], schema), "batch").count() == 0


def test_best_mime(spark):
    rows = [("a", "m1", 0.5, 2), ("a", "m0", 0.5, 1), ("a", "m2", 0.4, 0), ("b", "z", 0.0, 0)]
    got = {r.path: (r.mime, r.conf) for r in fl.best_mime(spark.createDataFrame(rows, "path STRING, mime STRING, conf DOUBLE, pos INT")).collect()}
    assert got == {"a": ("m0", 0.5), "b": (None, 0.0)}


def test_scans(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.py").write_text("import os\nx = 1\n")
    (tmp_path / "in" / "sub" / "b.py").write_text("from re import sub\n")
    folder = str(tmp_path / "in")
    files = fl.file_info(corpus.file_scan(spark, folder)).collect()
    assert sorted((r.name, r.size_bytes) for r in files) == [("a.py", 16), ("b.py", 19)]
    assert "content" not in corpus.file_scan(spark, folder, content=False).columns
    lines = corpus.line_scan(spark, folder, "*.py")
    assert sorted(r.line for r in lines.collect()) == ["from re import sub", "import os", "x = 1"]
    from gleaner.plans.pages import module_inventory

    got = sorted((r.kind, r["name"].rsplit("/", 1)[-1]) for r in module_inventory(lines, ["sub/"]).collect())
    assert got == [("module", "os"), ("processed", "a.py"), ("skipped", "b.py")]


def test_pipe(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x|y, ""q"""\n2,\n')
    corpus.csv_to_pipe(spark, str(tmp_path / "t.csv"), str(tmp_path / "out"))
    got = sorted(tuple(r) for r in corpus.read_pipe(spark, str(tmp_path / "out"), "a INT, b STRING").collect())
    assert got == [(1, 'x|y, "q"'), (2, None)]


def test_limits(spark):
    df = spark.range(2000).repartition(4)
    assert sorted(r.id for r in corpus.ingest_limit(df, 3, ["id"]).collect()) == [0, 1, 2]
    assert corpus.ingest_limit(df, 0, ["id"]).count() == corpus.ingest_limit(df, None, ["id"]).count() == 2000
    assert corpus.ingest_hard_cap(df, None, ["id"]).count() == 1001
    old, corpus.LAST_KEYS = corpus.LAST_KEYS, 100
    assert sorted(r.id for r in corpus.ingest_limit(df, 700, ["id"]).collect()) == list(range(700))
    corpus.LAST_KEYS = old
    assert corpus.ingest_hard_cap(df, 10, ["id"]).count() == 10


def test_files_of_documents_lie_in_a_folder_for_each_task(spark, tmp_path):
    texts = {7: "a\nb", -3: None, 12: "", None: "é", 2**60 + 1: "x\n"}
    rows = [(i, t, "en", "s", 0) for i, t in texts.items()] + [(i, str(i), "en", "s", 0) for i in range(100, 400)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").coalesce(1).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    want = {i: t or "" for i, t, *_ in rows}
    folder = scans._document_files(spark, str(tmp_path)).removeprefix("file:")
    found = [(where, name) for where, _, names in os.walk(folder) for name in names]
    assert len(found) == len(want) and len({where for where, _ in found}) <= 8
    got = {r.doc_id: (r.size_bytes, r.content_md5) for r in scans.file_scan(spark, str(tmp_path)).collect()}
    assert got == {i: (len(t.encode()) + 1, hashlib.md5(t.encode() + b"\n").hexdigest()) for i, t in want.items()}
    lines = sorted((str(r.doc_id), r.line) for r in scans.line_scan(spark, str(tmp_path)).collect())
    assert lines == sorted((str(i), line) for i, t in want.items() for line in t.split("\n"))


def test_a_task_parts_its_documents_into_folders(monkeypatch, tmp_path):
    monkeypatch.setattr(scans, "FOLDER_FILES", 10)
    monkeypatch.setattr(scans.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 3, taskAttemptId=lambda: 5))
    rows = pd.DataFrame({"doc_id": [str(i) for i in range(25)], "text": [b"t"] * 25})
    assert [n["n_files"][0] for n in scans._write_files(f"file:{tmp_path}", [rows[:7], rows[7:]])] == [25]
    found = {where.removeprefix(f"{tmp_path}/"): sorted(names) for where, _, names in os.walk(tmp_path) if names}
    assert {where: len(names) for where, names in found.items()} == {"3-0": 10, "3-1": 10, "3-2": 5}
    assert sorted(sum(found.values(), [])) == sorted(f"doc_id={i}.txt" for i in range(25))
    assert [n["n_files"][0] for n in scans._write_files(f"file:{tmp_path}/none", [])] == [0]


def test_a_tree_of_small_files_is_read_by_few_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"{i}.txt").write_text(f"{i}\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a split for each file
    try:
        most = 8 * spark.sparkContext.defaultParallelism
        names = ("path", "content"), ("path", "line")
        for (path, value), scan in zip(names, (corpus.file_scan(spark, str(tmp_path)), corpus.line_scan(spark, str(tmp_path)))):
            assert scan.rdd.getNumPartitions() == most < 200
            got = {(os.path.basename(r[path]), bytes(r[value]) if value == "content" else r[value].encode() + b"\n") for r in scan.collect()}
            assert got == {(f"{i}.txt", f"{i}\n".encode()) for i in range(200)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_lines_of_files_read_whole_are_those_of_the_text_reader(spark, tmp_path, monkeypatch):
    odd = {
        "a": b"a\nb", "b": b"a\r\nb\rc\n", "c": b"\n\n\r", "d": b"", "e": b"\xef\xbb\xbfa\n\xef\xbb\xbfb", "f": b"\xef\xbb\xbf",
        "g": b"x\xff\xfe\n\xc3\n", "h": "\u00e9\u2028\U0001f600\x00\n \t\n".encode(), "i": b"\xef\xbb\xbf\n\xff", "j k%[1]": b"\r\r\n\r",
        "long": b"line\r\n" * 50 + b"end",
    }
    for name, content in odd.items():
        (tmp_path / f"{name}.txt").write_bytes(content)
    (tmp_path / "packed.gz").write_bytes(gzip.compress(b"p\nq\n"))
    plain = spark.read.text(str(tmp_path)).selectExpr("_metadata.file_path path", "CAST(value AS BINARY) line")
    want = sorted((r.path, bytes(r.line)) for r in plain.collect())
    for most in (4 << 20, 100, 0):
        monkeypatch.setattr(corpus, "WHOLE_FILE", most)
        got = corpus.line_scan(spark, str(tmp_path))
        assert sorted((r.path, bytes(r.line)) for r in got.selectExpr("path", "CAST(line AS BINARY) line").collect()) == want
        readers = [kind for kind in ("binaryFile", "Format: Text") if kind in got._jdf.queryExecution().executedPlan().toString()]
        assert readers == ["binaryFile", "Format: Text"]
    monkeypatch.setattr(corpus, "WHOLE_FILE", 4 << 20)
    plan = corpus.line_scan(spark, str(tmp_path), "*.txt")._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "Format: Text" not in plan


@pytest.mark.parametrize("kind", ["files", "lines"])
def test_a_large_tree_is_listed_by_tasks(spark, tmp_path, monkeypatch, kind):
    """The names of its files are not on the driver, and the rows are those of Spark's readers."""
    for name in ("a b.txt", "j k%[1]*.txt", "é#? {x}.txt", "_h.txt", "_a=b.txt", ".h.txt", "x.txt._COPYING_", "y.py", "empty.txt"):
        (tmp_path / name).write_bytes(b"" if name == "empty.txt" else f"{name}\r\n\rend".encode())
    for sub in ("s=1/deep/er", "_s", ".s", "none/none", "many"):
        (tmp_path / sub).mkdir(parents=True)
        (tmp_path / sub / "in.txt").write_bytes(b"x\xff\n" if sub != "many" else b"line\n" * 500)
    for i in range(40):
        (tmp_path / "many" / f"{i}.txt").write_text(f"{i}\n")
    (tmp_path / "many" / "p.txt.gz").write_bytes(gzip.compress(b"p\nq\n"))
    for most, where, glob in ((4 << 20, "", "*.txt"), (1_000, "", None), (0, "/[ms]*", "[!ye]*.{txt,txt.gz}")):
        monkeypatch.setattr(corpus, "WHOLE_FILE", most)
        path = f"{tmp_path}{where}"
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob or "*")
        if kind == "files":
            plain = reader.format("binaryFile").load(path).select("path", "length", "modificationTime", "content")
        else:
            plain = reader.text(path).selectExpr("_metadata.file_path path", "CAST(value AS BINARY) line")
        monkeypatch.setattr(corpus, "DRIVER_FILES", 0, raising=False)
        got = corpus.file_scan(spark, path, glob=glob) if kind == "files" else corpus.line_scan(spark, path, glob)
        rows = got if kind == "files" else got.select("path", F.col("line").cast("binary"))
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, plain.collect())) != []
        known = [f for f in got.inputFiles() if f.startswith(f"file://{tmp_path}")]
        assert len(known) < plain.select("path").distinct().count() or most == 0
        if kind == "files":
            names = corpus.file_scan(spark, path, False, glob)
            assert sorted(map(tuple, names.collect())) == sorted(tuple(r)[:3] for r in plain.collect())
            assert not [f for f in names.inputFiles() if f.startswith(f"file://{tmp_path}")]


def test_a_small_tree_and_other_stores_are_left_to_the_reader(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("a\n")
    assert corpus._tree(spark, str(tmp_path), None) is None
    monkeypatch.setattr(corpus, "DRIVER_FILES", 0)
    assert corpus._tree(spark, f"{tmp_path}/a.txt", None) is None and corpus._tree(spark, f"{tmp_path}/none", None) is None
    assert corpus._tree(spark, str(tmp_path), None) is not None
    monkeypatch.setattr(corpus, "_store", lambda base: corpus.FileSystem.from_uri("viewfs-like://store/"))
    assert corpus._tree(spark, str(tmp_path), None) is None
    assert [r.line for r in corpus.line_scan(spark, str(tmp_path)).collect()] == ["a"]
