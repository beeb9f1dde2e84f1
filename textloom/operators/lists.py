"""Allow and deny lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.keys import document_key


def key_names(keys: str | Sequence[str]) -> list[str]:
    """Names of a comma-separated list or a sequence."""
    return [k.strip() for k in (keys.split(",") if isinstance(keys, str) else keys)]


def _filtered(
    df: DataFrame,
    listed: DataFrame,
    how: str,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str],
) -> DataFrame:
    # Duplicates of a hot list key are removed before the join. No broadcast
    # hint: Spark broadcasts the keys when their size is below its threshold,
    # and joins by sort and merge beyond it.
    left, right = key_names(left_on), key_names(right_on)
    if len(left) != len(right):
        raise ValueError("both sides need the same number of keys")
    keys = listed.select(*[F.col(b).alias(f"_key{i}") for i, b in enumerate(right)]).distinct()
    condition = reduce(and_, [F.col(a) == F.col(f"_key{i}") for i, a in enumerate(left)])
    return df.join(keys, condition, how)


def allow(
    df: DataFrame,
    listed: DataFrame | None,
    left_on: str | Sequence[str] = "ppn",
    right_on: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows that are listed; every row without a list."""
    if listed is None:
        return df
    return _filtered(df, listed, "left_semi", left_on, right_on or left_on)


def deny(
    df: DataFrame,
    listed: DataFrame | None,
    left_on: str | Sequence[str] = "ppn",
    right_on: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows that are not listed; every row without a list."""
    if listed is None:
        return df
    return _filtered(df, listed, "left_anti", left_on, right_on or left_on)


def restrict_documents(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Documents listed in the index; a document with a null key is never listed.

    Spark broadcasts the keys of the index when their size is below its
    threshold. Beyond it, documents of a table that is bucketed by the same key
    (``write_bucketed``) stay where they are; only others are shuffled.
    """
    key = document_key(docs, index)
    return docs.join(index.select(key).distinct(), key, "left_semi").select(*docs.columns)
