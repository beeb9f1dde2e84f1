"""Build the corpus index: one row of quality statistics per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import letters, text, words
from textloom.operators.keys import document_key
from textloom.operators.select import select_sql

INDEX_COLUMNS = (
    "remote", "path", "hash", "ppn", "doctype", "lang_code", "lang_score", "lfreq",
    "alpha", "alphanum", "words", "avg_word_len", "size", "strlen", "mtime",
)


def document_stats(docs: DataFrame, remote: str | Column) -> DataFrame:
    """Statistics that need the document alone: a map over the scan, without a shuffle.

    ``docs`` has path, mtime and content. Both letter distances are computed,
    as the language is not known yet.
    """
    name = F.lit(remote) if isinstance(remote, str) else remote
    decoded = docs.select(
        name.alias("remote"),
        "path",
        "mtime",
        F.col("content"),
        text.decode(F.col("content")).alias("text"),
    )
    t = F.col("text")
    measured = decoded.select(
        "remote",
        "path",
        text.hash_prefix(text.sha256(F.col("content"))).alias("hash"),
        text.document_id(F.col("path")).alias("ppn"),
        text.doctype(F.col("path")).alias("doctype"),
        text.alpha_ratio(t).alias("alpha"),
        text.alphanum_ratio(t).alias("alphanum"),
        words.word_stats(t).alias("stats"),
        F.octet_length("content").cast("long").alias("size"),
        F.char_length(t).cast("long").alias("strlen"),
        F.col("mtime").cast("long").alias("mtime"),
        _folded_counts(t).alias("letters"),
    )
    stats = F.col("stats")
    return measured.select(
        "remote",
        "path",
        "hash",
        "ppn",
        "doctype",
        *_distances(F.col("letters")),
        "alpha",
        "alphanum",
        stats["words"].alias("words"),
        F.when(stats["words"] > 0, stats["bytes"] / stats["words"])
        .otherwise(0.0)
        .cast("float")
        .alias("avg_word_len"),
        "size",
        "strlen",
        "mtime",
    )


def _folded_counts(t: Column) -> Column:
    # Composed, then lower-cased; the letter table does it the other way round.
    return letters.letter_counts(F.lower(letters.nfc(t)), letters.GERMAN_ALPHABET)


def _distances(counts: Column) -> list[Column]:
    return [letters.letter_distance(counts, c).alias(f"dist_{c}") for c in letters.DISTRIBUTIONS]


def lfreq(lang_code: Column) -> Column:
    """Letter distance for the language; null where no distribution is known."""
    return F.when(lang_code == "ger", F.col("dist_ger")).when(
        lang_code == "eng", F.col("dist_eng")
    )


def letter_distances(docs: DataFrame) -> DataFrame:
    """Path and both letter distances."""
    counted = docs.select("path", _folded_counts(text.decode(F.col("content"))).alias("letters"))
    return counted.select("path", *_distances(F.col("letters")))


def build_index(
    docs: DataFrame,
    remote: str | Column,
    languages: DataFrame | None = None,
    where: str | None = None,
) -> DataFrame:
    """The index of a corpus.

    ``languages`` has path, lang_code and lang_score, and the remote if it
    covers several, as ``LanguageModel.detect`` gives it; without it the
    language columns and ``lfreq`` are null. Only the narrow statistics meet it
    in a join: the text stays in the scan. ``where`` is the SQL text after
    WHERE, over the documents as table ``df``; it reaches the scan, which a
    filter on the index can't.
    """
    stats = document_stats(select_sql(docs, where=where) if where else docs, remote)
    if languages is None:
        known = stats.select(
            "*",
            F.lit(None).cast("string").alias("lang_code"),
            F.lit(None).cast("double").alias("lang_score"),
        )
    else:
        known = stats.join(languages, document_key(stats, languages), "left")
    return known.withColumn("lfreq", lfreq(F.col("lang_code"))).select(*INDEX_COLUMNS)
