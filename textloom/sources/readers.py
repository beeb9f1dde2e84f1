"""Sources: corpus files, indexes, lists, records and remotes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.records import RECORD_SCHEMA
from textloom.functions.text import relative_path


def read_corpus(spark: SparkSession, base_dir: str, data_dir: str = "data") -> DataFrame:
    """Documents below ``base_dir/data_dir``: path, mtime, size and content.

    Paths are relative to ``base_dir``, which lies in the default file system
    unless it names another. A plan that does not use ``content`` lists the
    files without reading them.

    Spark lists no name that begins with ``_`` or ``.``. Such files and folders
    are asked for by pattern, one call for each depth of folders, and the
    documents among them are read by tasks, each some of the files; their file
    system has to be one that Arrow opens.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(base_dir)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    base = store.makeQualified(place).toString().rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.txt")
        .load(escaped(f"{base}/{data_dir}"))
    )
    shown = files.select(
        relative_path(F.col("path"), base).alias("path"),
        F.unix_seconds("modificationTime").alias("mtime"),
        F.col("length").alias("size"),
        "content",
    )
    hidden = _hidden(spark, store, f"{base}/{data_dir}")
    if not hidden:
        return shown
    rows = [(p.removeprefix(f"{base}/"), seconds, size, p) for p, seconds, size in hidden]
    listed = spark.createDataFrame(rows, "path string, mtime long, size long, place string")
    parts = max(1, len(rows) // HIDDEN_FILES)
    return shown.union(listed.repartition(parts).mapInArrow(_contents(), "path string, mtime long, size long, content binary"))


#: Hidden files that a task reads.
HIDDEN_FILES = 1000


def _hidden(spark: SparkSession, store, folder: str) -> list[tuple[str, int, int]]:
    """Documents with a hidden name, or below a folder with one: place, seconds and bytes.

    The pattern of a depth names hidden entries only, so no other file comes to
    Python. A folder deeper than all folders ends the search.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    found, depth = [], escaped(folder)
    while len(store.globStatus(hadoop.Path(depth))):
        for entry in store.globStatus(hadoop.Path(f"{depth}/[_.]*")):
            files = store.listFiles(entry.getPath(), True)  # the file itself, or all below the folder
            while files.hasNext():
                file = files.next()
                if file.getPath().getName().endswith(".txt"):
                    found.append((file.getPath().toString(), file.getModificationTime() // 1000, file.getLen()))
        depth += "/[!_.]*"
    return found


def escaped(path: str) -> str:
    """A path in which nothing stands for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _contents():
    """A map over hidden files; being no function of a module, it needs none on the workers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place = row["place"]
                if place.startswith("file:"):
                    store, path = fs.LocalFileSystem(), "/" + place.removeprefix("file:").lstrip("/")
                else:
                    store, path = fs.FileSystem.from_uri(quote(place, safe=":/@"))
                with store.open_input_stream(path) as file:
                    columns = [row["path"]], [row["mtime"]], [row["size"]], [file.read()]
                types = pa.string(), pa.int64(), pa.int64(), pa.binary()
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["path", "mtime", "size", "content"])

    return read


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """An index written by this library; any path may stand in for the default one."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def read_filter_list(spark: SparkSession, path: str) -> DataFrame:
    """An allow or deny list: Parquet by suffix, else CSV with a header and all strings."""
    if path.endswith(".parquet"):
        return read_index(spark, path)
    return spark.read.option("recursiveFileLookup", "true").csv(path, header=True, inferSchema=False)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One stop word per line."""
    return spark.read.text(path)


def long_enough(word: Column, min_length: int) -> Column:
    """Stop words count in bytes, unlike tokens, which count in characters."""
    return F.octet_length(word) >= min_length


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Nested records, one JSON object per line; unreadable lines are skipped.

    ``read_all_records`` has them.
    """
    return readable(read_all_records(spark, path))


def read_all_records(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a file of records, with its ``file``; an unreadable one is in ``unreadable``."""
    schema = f"{RECORD_SCHEMA}, unreadable string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unreadable"}
    lines = spark.read.schema(schema).options(**options).json(path)
    return lines.withColumn("file", F.col("_metadata.file_path"))


def readable(records: DataFrame) -> DataFrame:
    """The records without the lines that can't be read."""
    return records.where("unreadable IS NULL").drop("unreadable", "file")


def records_by_file(records: DataFrame) -> DataFrame:
    """Numbers of readable and unreadable lines of each file."""
    bad = F.col("unreadable").isNotNull()
    return records.groupBy("file").agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header and inferred types."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
