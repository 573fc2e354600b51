"""Corpus, page and line sources, and row limits."""

from __future__ import annotations

import os
import re
import stat
import unicodedata
from collections.abc import Iterator, Sequence
from functools import partial, reduce
from urllib.parse import quote

import pandas as pd
from pyarrow import ArrowException
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import unnest_rows
from ..session import materialise, ship_package

# Fixed value: the widest ingest of the one-document-per-sample job (rows 0..1000).
HARD_CAP = 1001
# Keys drawn to set bounds, and keys among which the last step looks.
BOUND_SAMPLE, LAST_KEYS = 1_000, 20_000
# Splits of a tree of files that one task reads at most, and tasks that each core keeps.
TASK_SPLITS, CORE_TASKS = 32, 8
# Bytes of a file that is cut into lines in one piece, and where a line ends.
WHOLE_FILE, LINE_END = 4 << 20, "\r\n|\r|\n"
# Files of a tree that the driver lists and keeps; a larger tree is listed and read by tasks.
DRIVER_FILES = 50_000
# What a file counts for beside its bytes, least and most bytes of a task that reads files, and bytes that it hands on at a time.
FILE_COST, TASK_LEAST, TASK_MOST, BATCH_BYTES = 64 << 10, 4 << 20, 256 << 20, 8 << 20


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores.

    A small table in few row groups would be worked on by few tasks. A large one
    has splits enough and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def gathered(df: DataFrame) -> DataFrame:
    """A scan of many small files in fewer tasks.

    A file counts as 4 MB at least, so a split of small ones is some 32 files, and a large tree would
    make as many tasks, and output files, as it has such splits. Rows are read one by one, so a task may take several.
    """
    splits = df.rdd.getNumPartitions()
    tasks = max(splits // TASK_SPLITS, CORE_TASKS * df.sparkSession.sparkContext.defaultParallelism)
    return df.coalesce(tasks) if tasks < splits else df


def corpus_scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    spread_by: Sequence[str] = (),
    **partition: str,
) -> DataFrame:
    """Rows of a corpus, e.g. ``subset='distractor', split='train'``.

    The equality filters reach the scan: partition pruning on partition columns,
    pushed row-group filters on others.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    for column, value in partition.items():
        df = df.where(F.col(column) == value)
    return spread(df, *spread_by) if spread_by else df


def nth_key(df: DataFrame, n: int, order: Sequence[str]) -> Row | None:
    """The ``n``-th least key of ``order`` columns (from 1; nulls first, copies counted); None if there are fewer rows.

    Two drawn keys that should lie around it are held against all keys by counting, and what lies between
    them is looked at again until little is left. Each step is a scan of the key columns that
    brings back four counts; nothing is sorted but the last keys, and nothing shuffled.
    """
    span, left = df.select(*order), n
    while True:
        size = span.count()
        if left > size:
            return None
        if size <= LAST_KEYS:
            return span.orderBy(*order).offset(left - 1).first()
        drawn = span.sample(min(1.0, BOUND_SAMPLE / size), seed=7).orderBy(*order).collect() or span.take(1)
        at, margin = len(drawn) * left // size, 1 + int(3 * len(drawn) ** 0.5)
        low, high = drawn[max(0, at - margin)], drawn[min(len(drawn) - 1, at + margin)]
        below = [_compared(df, order, low), _compared(df, order, high)]
        tests = [t for less, up_to in below for t in (less, up_to)]
        under_low, to_low, under_high, to_high = span.agg(*[F.count_if(t) for t in tests]).first()
        if under_low < left <= to_low:
            return low
        if under_high < left <= to_high:
            return high
        if left <= under_low:
            span = span.where(tests[0])
        elif left <= under_high:
            span, left = span.where(~tests[1] & tests[2]), left - to_low
        else:
            span, left = span.where(~tests[3]), left - to_high


def _compared(df: DataFrame, order: Sequence[str], key: Row) -> tuple[Column, Column]:
    """Whether a row's key is less than ``key``, and whether it is not greater; never null."""
    bound = [F.lit(value).cast(df.schema[c].dataType) for c, value in zip(order, key)]
    if len(order) == 1 and key[0] is not None:  # a plain comparison reaches the scan
        own = F.col(order[0])
        return own.isNull() | (own < bound[0]), own.isNull() | (own <= bound[0])
    own, other = F.struct(*order), F.struct(*[b.alias(c) for c, b in zip(order, bound)])
    return own < other, own <= other


def ingest_limit(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in ``order``; none or 0 keeps all.

    Apply it before any unnesting: it counts samples. The ``n``-th key is looked for, and rows are
    filtered by it where they are, whatever ``n`` is. Of rows that share it as many stay as are wanted.
    """
    bound = nth_key(df, n, order) if n else None
    if bound is None:
        return df
    less, up_to = _compared(df, order, bound)
    before, through = df.agg(F.count_if(less), F.count_if(up_to)).first()
    if through == n:
        return df.where(up_to)
    return df.where(less).unionByName(df.where(up_to & ~less).limit(n - before))


def ingest_hard_cap(df: DataFrame, n: int | None, order: Sequence[str], cap: int = HARD_CAP) -> DataFrame:
    return ingest_limit(df, min(n, cap) if n else cap, order)


def page_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def file_scan(spark: SparkSession, path: str, content: bool = True, glob: str | None = None) -> DataFrame:
    """Files below ``path``. Without ``content`` only names and lengths are read.

    Spark's reader keeps each file's name and state on the driver. A tree of more than ``DRIVER_FILES`` files is
    listed and read by tasks instead, but for files longer than ``WHOLE_FILE``, of which bytes leave few.
    """
    columns = ["path", "length", "modificationTime"] + (["content"] if content else [])
    tree = _tree(spark, path, glob)
    if tree is None:
        return gathered(_reader(spark, glob).format("binaryFile").load(path).select(*columns))
    files, base = tree
    time = F.timestamp_millis("modified").alias("modificationTime")
    if not content:
        return files.select("path", "length", time)
    own = _contents(files.where(F.col("length") <= WHOLE_FILE), base).select("path", "length", time, "content")
    long = _patterns(files.where(F.col("length") > WHOLE_FILE))
    if not long:
        return own
    return own.unionByName(gathered(_reader(spark).format("binaryFile").load(long).select(*columns)))


def line_scan(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, line`` of text files below ``path``.

    The reader of text makes its settings, and looks for its codecs, anew for each file, which takes many times
    longer than a small file itself. So files of up to ``WHOLE_FILE`` bytes are read whole and cut here as that reader
    cuts lines; longer and compressed ones are left to it. A tree of more than ``DRIVER_FILES`` files is listed and read by
    tasks, and the driver knows the names of the longer and compressed ones only.
    """
    file, packed = F.col("_metadata.file_path").alias("path"), _compressed(spark)
    tree = _tree(spark, path, glob)
    if tree is None:
        reader = _reader(spark, glob)
        whole = (F.col("_metadata.file_size") <= WHOLE_FILE) & ~F.col("_metadata.file_path").rlike(packed)
        files = reader.format("binaryFile").load(path)
        found = files.where((F.col("length") <= WHOLE_FILE) & whole).select(file, F.col("content").cast("string").alias("content"))
        lines = _lines(gathered(found))
        if files.where(~whole).select("path").isEmpty():
            return lines
        left = reader.text(path).where(~whole)
    else:
        files, base = tree
        whole = (F.col("length") <= WHOLE_FILE) & ~F.col("path").rlike(packed)
        lines = _lines(_contents(files.where(whole), base).select(F.col("uri").alias("path"), F.col("content").cast("string").alias("content")))
        others = _patterns(files.where(~whole))
        if not others:
            return lines
        left = _reader(spark).text(others)
    return lines.unionByName(gathered(left.select(file, F.col("value").alias("line"))))


def _lines(contents: DataFrame) -> DataFrame:
    # stored by a generator, so that the last line is looked up in a column and the bytes are cut once
    cut = contents.select("path", F.explode_outer(F.array(_cut(F.col("content")))).alias("cut"))
    own = F.slice("cut", F.lit(1), F.size("cut") - (F.element_at("cut", -1) == "").cast("int"))
    return unnest_rows(cut, own, "pos", "line", "path").drop("pos")


def _reader(spark: SparkSession, glob: str | None = None):
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", glob) if glob else reader


def _tree(spark: SparkSession, path: str, glob: str | None) -> tuple[DataFrame, str] | None:
    """``path, length, modified`` of the files that Spark's reader finds below ``path``, listed level by level by tasks,
    and the store that they lie in; the driver sees the names of no file and of no folder but the first.

    None for what is left to Spark's reader: a tree of up to ``DRIVER_FILES`` files, single files, and stores that Arrow
    does not open. One task lists a folder, so one with very many files is listed by one.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    asked = jvm.org.apache.hadoop.fs.Path(path)
    tops = asked.getFileSystem(conf).globStatus(asked)
    if not tops or not all(t.isDirectory() for t in tops):
        return None
    roots = [t.getPath().toString() for t in tops]
    base = re.match("[^:/]+:(//[^/]*)?", roots[0])[0]
    try:
        if not _more_files(base, roots, DRIVER_FILES):
            return None
    except (ArrowException, OSError):  # a kind of store that Arrow does not know or cannot reach
        return None
    ship_package(spark)
    wanted = F.lit(True)
    if glob:
        wanted = F.col("name").rlike(f"(?s)^(?:{jvm.org.apache.hadoop.fs.GlobPattern.compile(glob).pattern()})\\z")
    most = CORE_TASKS * spark.sparkContext.defaultParallelism
    folders, found = spark.createDataFrame([(r,) for r in roots], "path string"), []
    n = len(roots)
    while n:
        rows = folders.repartition(min(n, most)).mapInPandas(
            partial(_list_folders, base), "path string, name string, folder boolean, length long, modified long"
        )
        # Spark's reader passes over files without bytes
        level = materialise(rows.where(F.col("folder") | (wanted & (F.col("length") > 0))), "tree")
        found.append(level.where("NOT folder").select("path", "length", "modified"))
        folders = level.where("folder").select("path")
        n = folders.count()
    return reduce(DataFrame.unionByName, found), base


def _store(base: str) -> tuple[FileSystem, str]:
    """The file system of a store, and what stands there before a path."""
    store, start = (LocalFileSystem(), "") if base in ("file:", "file://") else FileSystem.from_uri(f"{base}/")
    return store, start.rstrip("/")


def file_store(path: str) -> tuple[FileSystem, str]:
    """The file system of a folder and the folder's path there."""
    base = re.match("([^:/]+:(//[^/]*)?)?", path)[0]
    store, start = _store(base or "file:")
    return store, f"{start}{path.removeprefix(base)}"


def _entries(store: FileSystem, start: str, path: str) -> Iterator[tuple[str, bool, int, int]]:
    """Name, whether a folder, bytes and time in milliseconds of what lies in a folder and Spark's reader does not pass over."""
    if isinstance(store, LocalFileSystem):
        with os.scandir(path) as items:
            for item in items:
                try:
                    if _seen(item.name):
                        is_folder, own = item.is_dir(), item.stat()
                        if is_folder or stat.S_ISREG(own.st_mode):
                            yield item.name, is_folder, own.st_size, own.st_mtime_ns // 1_000_000
                except FileNotFoundError:  # taken away meanwhile, or a link to nothing
                    continue
        return
    for info in store.get_file_info(FileSelector(start + path)):
        if info.type in (FileType.File, FileType.Directory) and _seen(info.base_name):
            yield info.base_name, info.type == FileType.Directory, info.size or 0, (info.mtime_ns or 0) // 1_000_000


def _seen(name: str) -> bool:
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


def _more_files(base: str, roots: Sequence[str], most: int) -> bool:
    """Whether more than ``most`` files and folders lie below; the rest is not looked at."""
    store, start = _store(base)
    left, seen = [r.removeprefix(base) for r in roots], 0
    while left:
        folder = left.pop()
        for name, is_folder, _, _ in _entries(store, start, folder):
            seen += 1
            if seen > most:
                return True
            if is_folder:
                left.append(f"{folder.rstrip('/')}/{name}")
    return False


def _list_folders(base: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    store, start = _store(base)
    names, rows = ["path", "name", "folder", "length", "modified"], []
    for folder in (p for batch in batches for p in batch["path"]):
        for name, *facts in _entries(store, start, folder.removeprefix(base)):
            rows.append((f"{folder.rstrip('/')}/{name}", name, *facts))
            if len(rows) == 10_000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
    yield pd.DataFrame(rows, columns=names)


def _contents(files: DataFrame, base: str) -> DataFrame:
    """``path, uri, length, modified, content``, dealt to tasks by the number and the bytes of all files."""
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    cost, cores = size + n * FILE_COST, files.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-cost // TASK_MOST), min(CORE_TASKS * cores, -(-cost // TASK_LEAST)))
    return files.repartition(max(1, min(tasks, n))).mapInPandas(
        partial(_read_files, base), "path string, uri string, length long, modified long, content binary"
    )


def _read_files(base: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    store, start = _store(base)
    names, rows, size = ["path", "uri", "length", "modified", "content"], [], 0
    for path, length, modified in (r for b in batches for r in zip(b["path"], b["length"], b["modified"])):
        with store.open_input_file(start + path.removeprefix(base)) as file:
            content = file.read()
        rows.append((path, _uri(path), length, modified, content))
        size += len(content)
        if size >= BATCH_BYTES or len(rows) == 10_000:
            yield pd.DataFrame(rows, columns=names)
            rows, size = [], 0
    yield pd.DataFrame(rows, columns=names)


def _uri(path: str) -> str:
    """A path as Spark's ``_metadata.file_path`` writes it."""
    if re.fullmatch(r"[\w\-!.~'()*,;:$&+=@/]*", path, re.ASCII):
        return path
    spaces = ("Zs", "Zl", "Zp", "Cc")
    return "".join(quote(c, safe="-_!.~'()*,;:$&+=@/") if c < "\x80" or unicodedata.category(c) in spaces else c for c in path)


def _patterns(files: DataFrame) -> list[str]:
    """The paths of a few files as patterns that fit them alone, as readers take them."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", r.path) for r in files.select("path").collect()]


def _compressed(spark: SparkSession) -> str:
    """Pattern of the names that the reader of text unpacks."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    kinds = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    ends = [jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(kind, conf).getDefaultExtension() for kind in kinds]
    return f"({'|'.join(re.escape(e) for e in ends)})$" if ends else "^$"


def _cut(content: Column) -> Column:
    """A file's bytes, without a mark of byte order, cut where lines end: its lines and what is left behind the last end.

    A pattern works on characters and would replace bytes that are none; a text with such is cut with a character for each byte.
    """
    text = F.when(content.startswith("\ufeff"), F.substr(content, F.lit(2))).otherwise(content)
    bytewise = F.transform(
        F.split(F.decode(text.cast("binary"), "ISO-8859-1"), LINE_END), lambda x: F.encode(x, "ISO-8859-1").cast("string")
    )
    return F.when(F.is_valid_utf8(text), F.split(text, LINE_END)).otherwise(bytewise)


def text_lines(df: DataFrame, path: str, text: str) -> DataFrame:
    """``path, line`` from a column of whole texts."""
    return unnest_rows(df, F.split(text, "\n"), "pos", "line", F.col(path).alias("path")).drop("pos")


def csv_to_pipe(spark: SparkSession, source: str, target: str) -> None:
    """CSV with a header to pipe-delimited text with a header."""
    quoting = {"header": "true", "quote": '"', "escape": '"'}
    rows = spark.read.options(**quoting).csv(source)
    rows.write.mode("overwrite").options(**quoting).option("sep", "|").csv(target)


def read_pipe(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    quoting = {"header": "true", "quote": '"', "escape": '"'}
    return spark.read.schema(schema).options(**quoting).option("sep", "|").csv(path)
