"""N-gram vocabulary with term and document frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import decode, document_id
from textloom.functions.words import has_category, ngrams, tokens, without, words
from textloom.operators.lists import allow as allow_list
from textloom.operators.lists import deny as deny_list
from textloom.operators.select import select_sql
from textloom.sources.readers import long_enough

#: Words of a stop-word table that become part of the plan, at most; a table of more is joined.
PLANNED_STOPWORDS = 20_000


def vocabulary(
    docs: DataFrame,
    n: int = 1,
    *,
    min_token_len: int = 2,
    min_tf: int = 1,
    min_df: int = 1,
    categories: Sequence[str] = (),
    stopwords: DataFrame | Sequence[str] | None = None,
    where: str | None = None,
    allow: DataFrame | None = None,
    deny: DataFrame | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Count the n-grams of the documents: token, tf and df.

    ``docs`` has path and content and whatever ``where`` and the lists use.
    Windows run over the tokens that are left after the filters. Stop words
    are a sequence, which becomes part of the plan, or a table of one column
    and any size: for windows of several tokens, one of at most
    ``PLANNED_STOPWORDS`` words becomes part of the plan as well, and so many
    come to the driver; a longer one is joined. ``where`` is the SQL text after
    WHERE, over the table ``df``.
    """
    chosen = select_sql(docs, where=where) if where else docs
    if (allow is not None or deny is not None) and "ppn" not in chosen.columns:
        chosen = chosen.withColumn("ppn", document_id(F.col("path")))
    chosen = deny_list(allow_list(chosen, allow), deny)

    if isinstance(stopwords, DataFrame):
        # A value that is not lower-case never equals a lower-cased token, but
        # it stays in the list, as the list is compared as it is.
        listed = stopwords.toDF("token").where(long_enough(F.col("token"), min_token_len)).distinct()
        if n == 1:
            counted = _count_in_rows(chosen, n, min_token_len, categories, ())
            counted = counted.join(listed, "token", "left_anti")
        elif len(few := listed.limit(PLANNED_STOPWORDS + 1).collect()) <= PLANNED_STOPWORDS:
            counted = _count_in_rows(chosen, n, min_token_len, categories, [r["token"] for r in few])
        else:
            counted = _count_joined(chosen, n, min_token_len, categories, listed)
    else:
        literal = [w for w in stopwords or () if len(w.encode("utf-8")) >= min_token_len]
        counted = _count_in_rows(chosen, n, min_token_len, categories, literal)
    if min_tf > 1 or min_df > 1:
        counted = counted.where((F.col("tf") >= min_tf) & (F.col("df") >= min_df))
    return counted.orderBy(F.desc("tf"), F.desc("df"), "token") if ordered else counted


def _count_in_rows(
    docs: DataFrame, n: int, min_token_len: int, categories: Sequence[str], stopwords: Sequence[str]
) -> DataFrame:
    """The tokens of a document and their filters stay inside its row."""
    kept = docs.select(tokens(decode(F.col("content")), min_token_len, categories).alias("kept"))
    return _count_windows(kept.select(without("kept", stopwords).alias("kept")) if stopwords else kept, n)


def _count_windows(kept: DataFrame, n: int) -> DataFrame:
    """Windows are formed and sorted inside the row of the document, from its tokens ``kept``.

    Equal windows are neighbours then, and the first of them counts the
    document. So a window is one row, and one shuffle is enough, on the token;
    it carries partial counts: a token of a third of all rows leaves one row
    per task. posexplode_outer keeps the optimizer from adding a size filter
    that would tokenise twice.
    """
    grams = ngrams(F.col("kept"), n)
    first = F.coalesce(F.get("grams", F.col("i") - 1) != F.col("token"), F.lit(True))
    return (
        kept.select(F.sort_array(grams).alias("grams"))
        .select("grams", F.posexplode_outer("grams").alias("i", "token"))
        .where(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.count("*").alias("tf"), F.sum(first.cast("long")).alias("df"))
    )


def _count_joined(
    docs: DataFrame, n: int, min_token_len: int, categories: Sequence[str], stopwords: DataFrame
) -> DataFrame:
    """For a stop-word list of any size: one row per token, an anti join, then the tokens of a document again.

    Tokens are put together before they are shuffled by document, where the
    join left them beside each other.
    A document is known by its number in the scan here, so documents with the
    same path, or the same in every column, never share a window.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("doc"), "content")
    rows = numbered.select("doc", F.posexplode_outer(words(decode(F.col("content")))).alias("pos", "word"))
    keep = F.char_length("word") >= min_token_len
    if categories:
        keep = keep & has_category(F.col("word"), categories)
    kept = rows.where(keep).select("doc", "pos", F.lower("word").alias("token"))
    kept = kept.join(stopwords, "token", "left_anti")
    ordered = F.sort_array(F.collect_list(F.struct("pos", "token")))
    return _count_windows(kept.groupBy("doc").agg(ordered["token"].alias("kept")), n)
