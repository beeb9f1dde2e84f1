"""Combine the indexes of several remotes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.select import select_sql
from textloom.sources.readers import read_index


@dataclass(frozen=True)
class Remote:
    """A remote: its name, its index (a frame or a path) and the SQL text after WHERE."""

    name: str
    index: DataFrame | str
    predicate: str | None = None


def remote_index(remote: Remote, spark: SparkSession | None = None) -> DataFrame:
    """Rows of one remote that pass its predicate, which is pushed into the scan."""
    index = remote.index
    if isinstance(index, str):
        index = read_index(spark or SparkSession.active(), index)
    return select_sql(index, where=remote.predicate) if remote.predicate else index


def compound_index(remotes: Sequence[Remote], spark: SparkSession | None = None) -> DataFrame:
    """All rows of all remotes; types widen to the common one."""
    if not remotes:
        raise ValueError("no remotes")
    return reduce(DataFrame.unionByName, [remote_index(r, spark) for r in remotes])


def remote_counts(remotes: Sequence[Remote], spark: SparkSession | None = None) -> DataFrame:
    """Documents per remote after its predicate, also for a remote that has none left."""
    per_remote = [
        remote_index(r, spark).agg(F.count("*").alias("docs")).select(F.lit(r.name).alias("remote"), "docs")
        for r in remotes
    ]
    return reduce(DataFrame.unionByName, per_remote)
