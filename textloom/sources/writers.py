"""Sinks: tables by suffix, strict append, JSON summary, vocabulary and snapshots."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.keys import document_key
from textloom.operators.shrink import shrink_schema
from textloom.session import durable


def append_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows followed by new ones; columns must agree in name, order and type."""
    have = [(f.name, f.dataType) for f in existing.schema]
    got = [(f.name, f.dataType) for f in new.schema]
    if have != got:
        raise ValueError(f"schemas differ: {have} and {got}")
    return existing.unionByName(new)


def write_table(
    df: DataFrame, path: str, append: bool = False, default: str = "parquet", batch: str | None = None
) -> None:
    """Write as CSV or ZSTD Parquet, chosen by the suffix of ``path``.

    ``append`` adds files to an existing output of the same schema. The files
    already there are not rewritten, so a failed append leaves them whole. With
    a ``batch``, a name of the caller's, an append that is run again adds
    nothing: its files are complete before one rename puts them in the folder of
    the batch, which the readers of this library look into. An
    output that exists is replaced when the new one is complete, so a table may
    be written back to where it was read from.
    """
    suffix = path.rsplit("/", 1)[-1].rpartition(".")[2]
    kind = suffix if suffix in ("csv", "parquet") else default
    spark = df.sparkSession

    def save(place: str) -> None:
        save_as(place, "append" if append else "error")

    def save_as(place: str, mode: str) -> None:
        if kind == "csv":
            df.write.mode(mode).csv(place, header=True)
        else:
            df.write.mode(mode).option("compression", "zstd").parquet(place)

    if not append:
        _replace(spark, path, save)
        return
    if kind == "csv":
        have = spark.read.option("recursiveFileLookup", "true").csv(path, header=True, inferSchema=False).columns
        if have != df.columns:
            raise ValueError(f"columns differ: {have} and {df.columns}")
    else:
        append_rows(spark.read.option("recursiveFileLookup", "true").parquet(path), df)
    if batch is None:
        save(path)
        return
    if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
        raise ValueError(f"not a name of a batch: {batch}")
    store, folder = _place(spark, f"{path}/batch-{batch}")
    if store.exists(folder):
        return
    beside = f"{path}/_{batch}.{uuid.uuid4().hex}"
    save_as(beside, "error")
    if not store.rename(_place(spark, beside)[1], folder):
        raise OSError(f"can't move {beside} to {folder}")


def _replace(spark: SparkSession, path: str, save: Callable[[str], None]) -> None:
    """Save beside ``path``, then let the new output take its place.

    A save that fails leaves the old output as it was, and so does a failed
    move. Both folders are in one file system, so moving is renaming.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = store.makeQualified(target)
    beside = f"_{target.getName()}.{uuid.uuid4().hex}"
    new, old = (hadoop.Path(target.getParent(), f"{beside}.{age}") for age in ("new", "old"))
    try:
        save(new.toString())
    except Exception:
        store.delete(new, True)
        raise
    replaced = store.exists(target)
    if replaced and not store.rename(target, old):
        raise OSError(f"can't move {target}")
    if not store.rename(new, target):
        if replaced:
            store.rename(old, target)
        raise OSError(f"can't move {new} to {target}")
    if replaced:
        store.delete(old, True)


def write_index(index: DataFrame, path: str) -> None:
    """Write an index with its integer columns narrowed.

    The index is computed once, into a checkpoint; the extremes and the output
    are read from there.
    """
    write_table(shrink_schema(durable(index)), path)


def write_json(summary: DataFrame, path: str) -> None:
    """Write a frame of one string column as text."""
    _replace(summary.sparkSession, path, summary.write.text)


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """Write authorities as CSV, ordered by identifier."""
    ordered = vocabulary.orderBy("ppn").select("uri", "label", "notation")
    _replace(vocabulary.sparkSession, path, lambda place: ordered.write.csv(place, header=True))


def write_snapshot(documents: DataFrame, index: DataFrame, path: str) -> None:
    """Write the listed documents, by document type, and their index as one version.

    Both go to a folder of the version. A manifest that names it is written
    beside the current one and takes its place by one rename, so a reader has
    documents and index of the same version, whenever a write ends. The version
    before stays for readers that have begun with it; older ones are deleted.
    """
    spark = documents.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    listed = documents.write.partitionBy("doctype").option("compression", "zstd")
    listed.parquet(f"{path}/{version}/data")
    write_table(index, f"{path}/{version}/index.parquet")
    before = _version(spark, path)
    manifest = spark.range(1).select(F.lit(version).alias("value"))
    _replace(spark, f"{path}/{MANIFEST}", lambda place: manifest.coalesce(1).write.text(place))
    store, folder = _place(spark, path)
    for entry in store.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("version-") and name not in (version, before):
            store.delete(entry.getPath(), True)


MANIFEST = "manifest"


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(target)


def _version(spark: SparkSession, path: str) -> str | None:
    """The version that the manifest names; a crash between its two renames leaves the old one beside it."""
    store, folder = _place(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = store.globStatus(hadoop.Path(folder, MANIFEST)) or store.globStatus(hadoop.Path(folder, f"_{MANIFEST}.*.old"))
    if not found:
        return None
    return spark.read.text(found[0].getPath().toString()).first()["value"]


def write_bucketed(documents: DataFrame, table: str, buckets: int) -> None:
    """Save documents as a table in buckets of their key, sorted within each.

    A join with an index on that key leaves the text where it is, however long
    the index is.
    """
    key = document_key(documents)
    documents.write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key).option(
        "compression", "zstd"
    ).saveAsTable(table, format="parquet")


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents and index of a snapshot; refuses one that lacks a listed document."""
    version = _version(spark, path)
    try:
        documents = spark.read.parquet(f"{path}/{version}/data")
        index = spark.read.parquet(f"{path}/{version}/index.parquet")
    except AnalysisException as error:
        raise ValueError(f"corrupt snapshot: {path} lacks its documents or its index") from error
    key = document_key(index, documents)
    absent = index.select(key).join(documents.select(key), key, "left_anti").first()
    if absent:
        raise ValueError(f"corrupt snapshot: no document for {absent['path']}")
    return documents.withColumn("doctype", F.col("doctype").cast("string")), index
