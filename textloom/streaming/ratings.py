"""Ingest rating events as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.ratings import EVENT_SCHEMA, LOG_COLUMNS, admit, latest_ratings


def rating_events(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Stream of JSON rating events dropped into a folder."""
    return (
        spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files).json(folder)
    )


def ingest_ratings(
    events: DataFrame,
    users: DataFrame,
    paths: DataFrame,
    remote: str,
    log: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Append every event to the log, in a folder per status.

    The file sink and its checkpoint give each event exactly one row, also
    when a batch is run again. ``read_log`` returns the accepted ones. With
    ``once`` the query ends when the events at hand are done.
    """
    stamped = admit(events, users, paths).select(
        F.lit(remote).alias("remote"),
        "path",
        "hash",
        "rating",
        "comment",
        "username",
        F.unix_millis(F.current_timestamp()).alias("created_at"),
        "reason",
        "status",
    )
    writer = (
        stamped.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("status")
        .option("path", log)
        .option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """Accepted ratings."""
    return spark.read.parquet(log).where(F.col("status") == "accepted").select(*LOG_COLUMNS)


def read_rejected(spark: SparkSession, log: str) -> DataFrame:
    """Rejected events with their reason."""
    return spark.read.parquet(log).where(F.col("status") != "accepted")


def log_stream(spark: SparkSession, log: str) -> DataFrame:
    """Accepted ratings as a stream of the log that ``ingest_ratings`` writes; every row comes once."""
    rows = spark.readStream.schema(spark.read.parquet(log).schema).parquet(log)
    return rows.where(F.col("status") == "accepted").select(*LOG_COLUMNS)


def track_ratings(ratings: DataFrame, progress: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keep the latest rating of every document of a stream as state, and write what changes.

    The state has one row per remote and path, so a restart goes on from it and
    reads new ratings only. The changes of a batch are one folder, which a
    batch that is run again replaces.
    """

    def put(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").option("compression", "zstd").parquet(f"{progress}/changes-{batch:012d}")

    writer = latest_ratings(ratings).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(put)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_progress(spark: SparkSession, progress: str) -> DataFrame:
    """The latest rating of every document, from the changes written so far; ``worklist`` takes it as its log."""
    return latest_ratings(spark.read.option("recursiveFileLookup", "true").parquet(progress))
