"""Summaries of an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import human_size


def summary(index: DataFrame) -> DataFrame:
    """Documents, bytes and duplicates per remote and document type.

    The distinct count shuffles on the hash as well, so a remote with a third
    of all documents is spread over all tasks.
    """
    grouped = index.groupBy("remote", "doctype").agg(
        F.count("ppn").alias("docs"),
        F.sum("size").cast("long").alias("size"),
        F.countDistinct("hash").alias("unique"),
    )
    return grouped.select(
        "remote", "doctype", "docs", "size", (F.col("docs") - F.col("unique")).alias("dups")
    ).orderBy("doctype", "remote")


def summary_json(index: DataFrame) -> DataFrame:
    """One JSON object with docs, size and duplicates per document type, over all remotes."""
    per_type = (
        summary(index)
        .groupBy("doctype")
        .agg(F.sum("docs").alias("docs"), F.sum("size").alias("size"), F.sum("dups").alias("duplicates"))
    )
    entry = F.struct("doctype", F.struct("docs", "size", "duplicates"))
    return per_type.agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("summary")
    )


def summary_display(index: DataFrame) -> DataFrame:
    """The summary as text, with readable sizes."""
    return summary(index).select(
        "remote",
        F.col("doctype").alias("kind"),
        F.col("docs").cast("string").alias("docs"),
        human_size(F.col("size")).alias("size"),
        F.col("dups").cast("string").alias("duplicates"),
    )
