"""Compare an index with the documents that exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import sha256
from textloom.operators.keys import document_key

MODES = ("permissive", "strict", "pedantic")


def file_facts(docs: DataFrame, key: Sequence[str] = ("path",)) -> DataFrame:
    """Digest, mtime and size of every document; the text stays in the scan."""
    return docs.select(
        *key,
        sha256(F.col("content")).alias("file_hash"),
        F.col("mtime").cast("long").alias("file_mtime"),
        F.octet_length("content").cast("long").alias("file_size"),
    )


def _entries(index: DataFrame, key: Sequence[str]) -> DataFrame:
    return index.select(
        *key, "hash", F.col("mtime").cast("long").alias("mtime"), F.col("size").cast("long").alias("size")
    )


def status(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents that are changed, missing or untracked, with the checks that passed.

    One full outer join on the document's key, which is remote and path where
    both sides have them; both sides are a few short columns.
    """
    key = document_key(index, docs)
    both = _entries(index, key).withColumn("indexed", F.lit(True)).join(
        file_facts(docs, key).withColumn("exists", F.lit(True)), key, "full_outer"
    )
    checks = {
        "hash_ok": F.col("file_hash").startswith(F.col("hash")),
        "mtime_ok": F.col("file_mtime") == F.col("mtime"),
        "size_ok": F.col("file_size") == F.col("size"),
    }
    valid = checks["hash_ok"] & checks["mtime_ok"] & checks["size_ok"]
    state = (
        F.when(F.col("exists").isNull(), "missing")
        .when(F.col("indexed").isNull(), "untracked")
        .when(~valid, "changed")
    )
    return both.select(
        state.alias("status"), *[c.alias(name) for name, c in checks.items()], *key
    ).where(F.col("status").isNotNull())


def missing(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Index entries without a document."""
    key = document_key(index, docs)
    return index.join(docs.select(key), key, "left_anti").select(*index.columns)


def untracked(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Sorted keys of documents without an index entry."""
    key = document_key(index, docs)
    return docs.select(key).join(index.select(key), key, "left_anti").orderBy(key)


def counts(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Numbers of missing entries and untracked documents, in one row."""
    key = document_key(index, docs)
    both = index.select(*key, F.lit(True).alias("indexed")).join(
        docs.select(*key, F.lit(True).alias("exists")), key, "full_outer"
    )
    return both.agg(
        F.count_if(F.col("exists").isNull()).alias("missing"),
        F.count_if(F.col("indexed").isNull()).alias("untracked"),
    )


def prune(index: DataFrame, docs: DataFrame) -> DataFrame:
    """The index without the entries whose document is missing."""
    key = document_key(index, docs)
    return index.join(docs.select(key), key, "left_semi").select(*index.columns)


def violations(index: DataFrame, docs: DataFrame, mode: str = "strict") -> DataFrame:
    """Path and first violated check of every entry that does not verify.

    permissive: the document exists and its digest starts with the hash;
    strict: the mtime agrees as well; pedantic: the size agrees as well.
    """
    if mode not in MODES:
        raise ValueError(f"invalid mode '{mode}'")
    level = MODES.index(mode)
    key = document_key(index, docs)
    joined = _entries(index, key).join(file_facts(docs, key), key, "left")
    reason = F.when(F.col("file_hash").isNull(), "file not found").when(
        ~F.col("file_hash").startswith(F.col("hash")), "hash mismatch"
    )
    if level >= 1:
        reason = reason.when(F.col("file_mtime") != F.col("mtime"), "mtime mismatch")
    if level >= 2:
        reason = reason.when(F.col("file_size") != F.col("size"), "size mismatch")
    return joined.select(*key, reason.alias("reason")).where(F.col("reason").isNotNull())


def verify(index: DataFrame, docs: DataFrame, mode: str = "strict") -> None:
    """Raise for the first violation found."""
    first = violations(index, docs, mode).limit(1).collect()
    if first:
        raise ValueError(f"verification failed: {first[0]['reason']} (path = {first[0]['path']})")
