"""Select rows and columns of an index by SQL text and lists."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from textloom.operators.lists import allow as allow_list
from textloom.operators.lists import deny as deny_list
from textloom.operators.lists import key_names


def select_sql(index: DataFrame, columns: str = "*", where: str | None = None) -> DataFrame:
    """``SELECT columns FROM df WHERE where`` over the index.

    Both parts are free text, so the columns may hold aggregates, the predicate
    may go on with GROUP BY, ORDER BY or LIMIT, and subqueries may read ``df``.
    """
    view = f"textloom_{uuid.uuid4().hex}"
    index.createOrReplaceTempView(view)
    tail = f" WHERE {where}" if where else ""
    try:
        return index.sparkSession.sql(f"WITH df AS (SELECT * FROM {view}) SELECT {columns} FROM df{tail}")
    finally:
        index.sparkSession.catalog.dropTempView(view)


def select(
    index: DataFrame,
    columns: str = "*",
    where: str | None = None,
    allow: DataFrame | None = None,
    deny: DataFrame | None = None,
    on: str | Sequence[str] = "ppn",
    left_on: str | Sequence[str] | None = None,
    right_on: str | Sequence[str] | None = None,
) -> DataFrame:
    """Select from an index; ``allow`` keeps listed rows, ``deny`` drops them.

    The lists apply to the selected rows. When a key is not among the selected
    columns they apply to the index before the selection instead.
    """
    if (left_on is None) != (right_on is None):
        raise ValueError("left_on and right_on belong together")
    left = key_names(left_on if left_on is not None else on)
    right = key_names(right_on if right_on is not None else on)

    def listed(df: DataFrame) -> DataFrame:
        return deny_list(allow_list(df, allow, left, right), deny, left, right)

    chosen = select_sql(index, columns, where)
    if set(left) <= set(chosen.columns):
        return listed(chosen)
    return select_sql(listed(index), columns, where)
