"""Extract bibliographic identifiers with their byte positions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.references import PATTERNS, any_reference, reference_matches
from textloom.functions.text import decode_same_length
from textloom.operators.keys import document_key
from textloom.operators.select import select_sql


def references(
    docs: DataFrame, patterns: Mapping[str, str] = PATTERNS, where: str | None = None
) -> DataFrame:
    """Remote if there is one, path, type, value, start and end of every identifier.

    ``patterns`` maps a type to a pattern with one group; more types can be
    given. A map over the scan: documents without any match leave after one
    pass, and the positions of the others are found within their row.
    """
    chosen = select_sql(docs, where=where) if where else docs
    key = document_key(chosen)
    texts = chosen.select(*key, decode_same_length(F.col("content")).alias("text"))
    text = F.col("text")
    found = F.concat(*[reference_matches(text, kind, p) for kind, p in patterns.items()])
    rows = texts.where(any_reference(text, patterns)).select(*key, F.explode_outer(found).alias("m"))
    return rows.select(*key, "m.*").where(F.col("value").isNotNull())
