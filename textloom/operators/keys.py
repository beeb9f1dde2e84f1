"""What identifies a document."""

from __future__ import annotations

from pyspark.sql import DataFrame

DOCUMENT_KEY = ("remote", "path")


def document_key(*frames: DataFrame) -> list[str]:
    """Remote and path where all frames have both, else the path alone."""
    return [k for k in DOCUMENT_KEY if k == "path" or all(k in f.columns for f in frames)]
