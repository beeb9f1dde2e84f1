"""Letter counts per document over an alphabet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.letters import DEFAULT_ALPHABET, alphabet_letters, letter_counts, nfc, total
from textloom.functions.text import decode_strict
from textloom.operators.select import select_sql


def letter_table(
    docs: DataFrame, alphabet: str = DEFAULT_ALPHABET, where: str | None = None
) -> DataFrame:
    """Path, total and one count per letter; zero where a letter does not occur.

    The text is lower-cased, then composed. Ill-formed UTF-8 fails the job. A
    map over the scan: the number of columns is that of the alphabet. ``where``
    is the SQL text after WHERE, over the table ``df``; it reaches the scan,
    which a filter on the result can't.
    """
    if where:
        docs = select_sql(docs, where=where)
    letters = alphabet_letters(alphabet)
    folded = docs.select("path", nfc(F.lower(decode_strict(F.col("content")))).alias("folded"))
    counted = folded.select("path", letter_counts(F.col("folded"), "".join(letters)).alias("counts"))
    counts = F.col("counts")
    return counted.select(
        "path",
        total(counts).alias("total"),
        *[F.get(counts, F.lit(i)).alias(c) for i, c in enumerate(letters)],
    )
