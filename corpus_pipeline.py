"""From documents to token ids: five stages, each by one operator of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import mixing, pieces, secrets, shingles, simhash
from textloom.llm import toxicity as toxic
from textloom.llm.components import components
from textloom.llm.queries import digests, tokenizer_file
from textloom.llm.ship import shared_folder
from textloom.session import durable


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model fitted on their labels does not find toxic.

    Null and empty texts have a score like any other and repeated rows stay;
    without documents or labels nothing is learned and no document goes.
    """
    model = toxic.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxic.scored(spark, model, "text") < 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, null last.

    Near are texts whose SimHash fingerprints differ in at most four bits, and
    texts with a Jaccard similarity of 0.8 of their shingles of five words,
    which fingerprints mostly miss; groups of either kind that share a document
    are one. A row is known by its id and a hash of all its columns, so repeated
    ids are told apart; of equal rows one stays.
    """
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), _mark(docs).alias("mark"))
    named = docs.select(row.alias("row"), "text")
    by_bits = simhash.near_duplicates(named, id_col="row").select("row", F.col("component_id").alias("a")).distinct()
    by_sets = shingles.near_duplicates(named, id_col="row").select("row", F.col("component_id").alias("b")).distinct()
    # Both kinds name a group by its first row, so groups that share a row are a link of two rows.
    both = durable(by_bits.join(by_sets, "row"))
    later = components(both.select("a", "b"), "a", "b").where("node <> root").select(F.col("node").alias("row"))
    first = both.where("row = a AND row = b").join(later, "row", "left_anti").select("row.mark")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _mark(docs).alias("mark"))
    kept = marked.join(first, "mark", "left_semi")
    return kept.dropDuplicates(["mark"]).select("doc.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; the length is that of the new text.

    Null and empty texts stay as they are, repeated rows stay.
    """
    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"))
    old, new = F.col("doc.text"), F.col("text")
    length = F.when(new.eqNullSafe(old), F.col("doc.n_chars")).otherwise(F.length(new)).cast("long")
    changed = F.col("doc").withField("text", new).withField("n_chars", length)
    return secrets.redact(both, "text").select(changed.alias("doc")).select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it takes the whole of them.

    Of a document that the schedule cuts, as many of its first words as it
    takes follow, as a document of that length; a long one in a small source
    neither vanishes nor is taken beyond its target. Documents without words
    are in no block and go. Rows equal in all columns are taken as one.
    """
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _mark(docs).alias("mark"))
    parts, _, _ = mixing.mix(marked.select("mark", "doc.text", "doc.source"), id_col="mark")
    taken = parts.where("taken > 0").groupBy("mark").agg(F.sum("taken").alias("taken"), F.max("size").alias("size"))
    whole = (F.col("taken") / F.col("size")).cast("long")
    times = taken.select("mark", whole.alias("whole"), (F.col("taken") - whole * F.col("size")).cast("int").alias("words"))
    several = marked.dropDuplicates(["mark"]).join(times, "mark")
    copies = several.where("whole > 0").select(F.explode(F.array_repeat("doc", F.col("whole").cast("int"))).alias("doc"))
    # Not for copies: the words of a text are taken apart only where one is cut.
    words = F.regexp_extract_all(F.col("doc.text"), F.lit(WORD), F.lit(0))
    text = F.array_join(F.slice(words, F.lit(1), F.col("words")), "")
    cut = several.where("words > 0").select("doc", text.alias("text"))
    cut = cut.select(F.col("doc").withField("text", F.col("text")).withField("n_chars", F.length("text").cast("long")).alias("doc"))
    return copies.union(cut).select("doc.*")


#: A word as the mix counts it, with the white space after it.
WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, as digests with their number; one row for each row."""
    return digests(pieces.encode_decode(docs, tokenizer_file("piece_bpe_32k.model")))


def _mark(docs: DataFrame) -> Column:
    """A row by 128 bits of hashes of all its columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: Hashes, dictionaries and merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
