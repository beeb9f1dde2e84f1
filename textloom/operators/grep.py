"""Find the documents that match a pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import decode, parse_doctype
from textloom.operators.keys import document_key
from textloom.operators.lists import allow as allow_list
from textloom.operators.lists import deny as deny_list
from textloom.operators.select import select_sql


def matches(
    content: Column,
    pattern: str,
    ignore_case: bool = False,
    invert: bool = False,
    max_bytes: int | None = None,
) -> Column:
    """True if the text matches, or does not when inverted.

    Classes such as ``\\w`` are Unicode classes and only a line feed ends a
    line. With ``max_bytes`` above 0, only that many bytes are searched.
    """
    flags = "(?diU)" if ignore_case else "(?dU)"
    if max_bytes:
        content = F.substring(content, 1, max_bytes)
    found = decode(content).rlike(flags + pattern)
    return ~found if invert else found


def grep(
    index: DataFrame,
    pattern: str,
    docs: DataFrame | None = None,
    *,
    ignore_case: bool = False,
    invert: bool = False,
    max_bytes: int | None = None,
    where: str | None = None,
    allow: DataFrame | None = None,
    deny: DataFrame | None = None,
    doctype: str | None = None,
    comment: str | None = None,
    header: str | None = None,
) -> DataFrame:
    """Rows of the index whose document matches.

    The text is the column ``content`` of ``docs``, or of the index itself when
    there are no ``docs``. With ``docs``, the pattern runs where the text is
    read and only the keys of matches are shuffled to the index. ``where`` is
    the SQL text after WHERE, over the table ``df``.
    """
    candidates = select_sql(index, where=where) if where else index
    candidates = deny_list(allow_list(candidates, allow), deny)

    def test(df: DataFrame) -> DataFrame:
        return df.filter(matches(F.col("content"), pattern, ignore_case, invert, max_bytes))

    if docs is None:
        found = test(candidates).drop("content")
    else:
        key = document_key(candidates, docs)
        found = candidates.join(test(docs).select(key), key, "left_semi")
        found = found.select(*candidates.columns)
    if doctype is not None:
        found = found.withColumn("doctype", F.lit(parse_doctype(doctype)))
    if comment is not None:
        found = found.withColumn("comment", F.lit(comment))
    return select_sql(found, header) if header else found
