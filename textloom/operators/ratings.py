"""Ratings of documents: admission, latest rating and what is left to rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.keys import document_key

# The ratings a document can get.
RATINGS = ("C", "C-", "P", "P-", "P+", "I")
# Parts that the events of one user or path are split into.
SALTS = 16
EVENT_SCHEMA = (
    "path string, hash string, rating string, comment string, username string, secret string"
)
LOG_COLUMNS = ("remote", "path", "hash", "rating", "comment", "username", "created_at")


def admit(events: DataFrame, users: DataFrame, paths: DataFrame) -> DataFrame:
    """Add ``status`` and ``reason`` to rating events, batch or stream.

    ``users`` has username and secret, ``paths`` has path. The checks run in
    order: user, secret, path, rating. The secret leaves after the first join.
    Events of a busy user or a popular path, and those without a name or a
    path, are spread: a salt is part of the key, and the short lists of users
    and paths are repeated for each of its values.
    """
    known = _salted(users.groupBy("username").agg(F.max("secret").alias("expected")), "username")
    existing = _salted(paths.select("path").distinct().withColumn("exists", F.lit(True)), "path")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in events.columns]), F.lit(SALTS)).cast("int")
    joined = events.withColumn("_salt", salt).join(known, ["username", "_salt"], "left")
    trusted = joined.withColumn("_trusted", F.col("secret").eqNullSafe(F.col("expected"))).drop("secret")
    joined = trusted.join(existing, ["path", "_salt"], "left")
    reason = (
        F.when(F.col("expected").isNull(), "unknown user")
        .when(~F.col("_trusted"), "wrong secret")
        .when(F.col("exists").isNull(), "unknown path")
        .when(~F.coalesce(F.col("rating").isin(*RATINGS), F.lit(False)), "invalid rating")
    )
    status = (
        F.when(F.col("reason").isNull(), "accepted")
        .when(F.col("reason").isin("unknown user", "wrong secret"), "unauthorized")
        .otherwise("bad request")
    )
    return (
        joined.withColumn("reason", reason)
        .withColumn("status", status)
        .drop("expected", "exists", "_trusted", "_salt")
    )


def _salted(df: DataFrame, key: str) -> DataFrame:
    """Rows with a key, once for each salt.

    Spark takes the size before the repetition for that of the table, which
    would be sent to the driver and every task; so it asks for a merge.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return df.where(F.col(key).isNotNull()).withColumn("_salt", salts).hint("merge")


def latest_ratings(log: DataFrame) -> DataFrame:
    """Last rating of every document; of those at the same time, the greatest by user, rating, comment, hash."""
    last = F.max(F.struct("created_at", "username", "rating", "comment", "hash"))
    latest = log.groupBy("remote", "path").agg(last.alias("last"))
    return latest.select(
        "remote", "path", *[f"last.{c}" for c in ("hash", "rating", "comment", "username", "created_at")]
    )


def worklist(
    index: DataFrame, log: DataFrame | None = None, chosen: DataFrame | None = None
) -> DataFrame:
    """Index rows still to be rated.

    ``chosen`` restricts the rows by remote and path, or by path if it has no
    remote. A rating counts for its own remote only.
    """
    rows = index
    if chosen is not None:
        key = document_key(index, chosen)
        rows = rows.join(chosen.select(key).distinct(), key, "left_semi")
    if log is not None:
        rows = rows.join(log.select("remote", "path").distinct(), ["remote", "path"], "left_anti")
    return rows.select(*index.columns)
