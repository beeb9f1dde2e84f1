"""Session defaults and reliable lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def spark_session(app: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Adaptive execution stays on: it coalesces small shuffles, splits skewed
    join partitions and turns sort-merge joins into broadcast joins only when
    the measured size is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder shared by the cluster.

    The result survives the loss of executors and is not computed again by the
    plans that read it. Only a local session may fall back to a temporary
    folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
            folder = tempfile.mkdtemp(prefix="textloom-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()
