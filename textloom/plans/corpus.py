"""The given tables seen as a corpus, its lists, records and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.functions.words import words
from textloom.operators.compound import Remote
from textloom.sources.readers import read_table

FOLDERS = ("article", "book", "chapter", "issue", "ft", "toc")
EPOCH = 1_704_067_200
URI_BASE = "https://authority.example/"
AUTHORITY_CODES = {
    "STANDARD": "Tb1",
    "LARGE": "Tf1",
    "MEDIUM": "Tg1",
    "ECONOMY": "Tp1",
    "PROMO": "Ts1",
    "SMALL": "Tu1",
}
EVENT_RATINGS = {"view": "C", "click": "P+", "purchase": "P", "signup": "I", "error": "bad"}


def path_of(doc_id: Column) -> Column:
    folder = F.element_at(F.array(*[F.lit(f) for f in FOLDERS]), (doc_id % 6 + 1).cast("int"))
    return F.concat(F.lit("data/"), folder, F.lit("/"), doc_id.cast("string"), F.lit(".txt"))


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a corpus: remote, path, mtime, content, lang_code."""
    docs = read_table(spark, sf, "documents")
    return docs.select(
        F.col("source").alias("remote"),
        path_of(F.col("doc_id")).alias("path"),
        (F.col("doc_id") + EPOCH).alias("mtime"),
        F.col("text").cast("binary").alias("content"),
        tx.lang_code(F.col("lang")).alias("lang_code"),
    )


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """The turns of the conversations as documents: short texts without a language."""
    key = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    return read_table(spark, sf, "conversations").select(
        F.concat(F.lit("data/chapter/"), key, F.lit(".txt")).alias("path"),
        F.col("turn").alias("mtime"),
        F.col("text").cast("binary").alias("content"),
    )


def shared_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Two remotes, documents and pages, whose documents have the same paths."""
    docs = corpus(spark, sf).withColumn("remote", F.lit("documents"))
    pages = read_table(spark, sf, "pages").select(
        F.lit("pages").alias("remote"),
        path_of(F.col("page_id")).alias("path"),
        (F.col("page_id") + EPOCH).alias("mtime"),
        F.col("html").cast("binary").alias("content"),
        F.lit(None).cast("string").alias("lang_code"),
    )
    return docs.unionByName(pages)


def entries(docs: DataFrame) -> DataFrame:
    """Index columns that need no statistics, with the content."""
    return docs.select(
        "remote",
        "path",
        tx.hash_prefix(tx.sha256(F.col("content"))).alias("hash"),
        tx.document_id(F.col("path")).alias("ppn"),
        tx.doctype(F.col("path")).alias("doctype"),
        *(["lang_code"] if "lang_code" in docs.columns else []),
        F.octet_length("content").cast("long").alias("size"),
        "mtime",
        "content",
    )


def index(spark: SparkSession, sf: str) -> DataFrame:
    return entries(corpus(spark, sf)).drop("content")


def allow_list(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of good quality; all columns are strings, as in a list file."""
    labels = read_table(spark, sf, "labels").where("quality = 1")
    return labels.select(
        F.col("doc_id").cast("string").alias("ppn"),
        F.when(F.col("toxic") == 1, "book").otherwise("article").alias("kind"),
    )


def deny_list(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "labels").where("toxic = 1").select(
        F.col("doc_id").cast("string").alias("ppn")
    )


def stopwords(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the benchmark texts."""
    found = read_table(spark, sf, "benchmark").select(
        F.explode_outer(words(F.col("text"))).alias("value")
    )
    return found.where(F.col("value").isNotNull()).distinct()


def identifier_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with identifiers before and after their whole text."""
    docs = read_table(spark, sf, "documents")
    key = F.col("doc_id").cast("string")

    def padded(width: int) -> Column:
        return F.lpad(key, width, "0")

    marked = F.concat(
        F.lit("ISSN 1234-"),
        padded(4),
        F.lit(" ISSN 123-4567 "),
        F.col("text"),
        F.lit("\nISBN 978-3-16-"),
        padded(6),
        F.lit("-0 und isbn: 3-16-148410-x, ISBN-13: 978 3 16 148410 0. issn: 4321-"),
        padded(4),
        F.lit(" DDC  "),
        padded(3),
        F.lit(".5—dc23 DDC 005.74 https://orcid.org/0000-0002-"),
        padded(4),
        F.lit("-123X HTTP://ORCID.ORG/0000-0001-5000-0007 http://isni.org/isni/"),
        padded(15),
        F.lit("X"),
    )
    return docs.select(path_of(F.col("doc_id")).alias("path"), marked.cast("binary").alias("content"))


def indexed_side(spark: SparkSession, sf: str) -> DataFrame:
    """Index of a corpus in which one source was not indexed yet."""
    return index(spark, sf).where("remote <> 'src3'")


def files_side(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the same corpus later on: one source is gone, texts were edited or touched."""
    docs = corpus(spark, sf).where("remote <> 'src5'")
    edited = F.col("lang_code") == "fre"
    touched = F.col("lang_code") == "spa"
    return docs.select(
        "path",
        (F.col("mtime") + F.when(touched, 1).otherwise(0)).alias("mtime"),
        F.when(edited, F.concat("content", F.lit("\n").cast("binary")))
        .otherwise(F.col("content"))
        .alias("content"),
    )


def remotes(spark: SparkSession, sf: str) -> list[Remote]:
    """Indexes of four tables, each with its own predicate; one has a narrower mtime."""
    documents = index(spark, sf).drop("lang_code")
    pages = read_table(spark, sf, "pages").select(
        F.lit("pages").alias("remote"),
        F.concat(F.lit("data/other/"), F.col("page_id").cast("string"), F.lit(".txt")).alias("path"),
        F.lit(0).alias("mtime"),
        F.col("html").cast("binary").alias("content"),
    )
    talk = turns(spark, sf).withColumn("remote", F.lit("conversations"))
    items = read_table(spark, sf, "benchmark").select(
        F.lit("benchmark").alias("remote"),
        F.concat(F.lit("data/toc/"), F.col("item_id").cast("string"), F.lit(".txt")).alias("path"),
        F.col("item_id").alias("mtime"),
        F.col("text").cast("binary").alias("content"),
    )
    return [
        Remote("documents", documents, "size > 500 AND doctype <> 'toc'"),
        Remote("pages", entries(pages).drop("content")),
        Remote("conversations", entries(talk).drop("content"), "size BETWEEN 100 AND 1000"),
        Remote("benchmark", entries(items).drop("content"), "size < 0"),
        Remote("items", entries(items.withColumn("remote", F.lit("items"))).drop("content"), "size > 0"),
    ]


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as authority records, line items as records that link to them."""

    def subfield(code: str, value: Column) -> Column:
        return F.struct(F.lit(code).alias("code"), value.cast("string").alias("value"))

    def field(tag: str, occurrence: Column, *subfields: Column) -> Column:
        return F.struct(
            F.lit(tag).alias("tag"),
            occurrence.cast("string").alias("occurrence"),
            F.array(*subfields).alias("subfields"),
        )

    code = F.element_at(
        F.create_map(*[F.lit(x) for pair in AUTHORITY_CODES.items() for x in pair]), F.col("p_type")
    )
    parts = read_table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("record_id"),
        F.array(
            field("002@", F.lit(""), subfield("0", code)),
            field("041A", F.lit(""), subfield("9", F.lit("0"))),
        ).alias("fields"),
    )
    items = read_table(spark, sf, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "record_id"
        ),
        F.array(
            field("002@", F.lit(""), subfield("0", F.lit("Aa"))),
            field(
                "041A",
                F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
                subfield("9", F.col("l_partkey")),
                subfield("a", F.lit("")),
            ),
            field("041A", F.lit("99"), subfield("a", F.col("l_returnflag"))),
            field("044K", F.lit(""), subfield("9", F.col("l_suppkey"))),
            field("010@", F.lit(""), subfield("a", F.col("l_returnflag"))),
        ).alias("fields"),
    )
    return parts.unionByName(items)


def repeated_records(spark: SparkSession, sf: str) -> DataFrame:
    """Authority records in two editions; the second of every third part has another kind."""
    first = records(spark, sf).where(F.size("fields") == 2).withColumn("edition", F.lit(1))
    moved = F.col("record_id").cast("long") % 3 == 0
    code = F.element_at("fields", 1)["subfields"][0]["value"]
    other = F.struct(F.lit("002@").alias("tag"), F.lit("").alias("occurrence"),
                     F.array(F.struct(F.lit("0").alias("code"), F.when(moved, "Tu1").otherwise(code).alias("value"))).alias("subfields"))
    second = first.withColumn("fields", F.array(other, F.element_at("fields", 2))).withColumn("edition", F.lit(2))
    return first.unionByName(second)


def part_authorities(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("ppn"), F.col("p_type").alias("kind")
    )


def order_links(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("record_id"), F.col("l_partkey").cast("string").alias("target")
    )


def rating_events(spark: SparkSession, sf: str) -> DataFrame:
    """Rating events made from the event table."""
    rating = F.element_at(
        F.create_map(*[F.lit(x) for pair in EVENT_RATINGS.items() for x in pair]), F.col("event_type")
    )
    about = F.regexp_extract("props", "([0-9]+)", 1).cast("long") * 20 + F.col("user_id") % 20
    return read_table(spark, sf, "events").select(
        "event_id",
        path_of(about).alias("path"),
        F.lit("").alias("hash"),
        rating.alias("rating"),
        F.col("event_type").alias("comment"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("username"),
        F.concat(F.lit("secret-"), F.col("user_id").cast("string")).alias("secret"),
    )


def rating_users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of all but one segment; those in debt have changed their secret."""
    prefix = F.when(F.col("c_acctbal") >= 0, "secret-").otherwise("changed-")
    return read_table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_name").alias("username"),
        F.concat(prefix, F.col("c_custkey").cast("string")).alias("secret"),
    )


def rating_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log of ratings: the labelled documents, with the remote of their source."""
    labels = read_table(spark, sf, "labels")
    docs = read_table(spark, sf, "documents").select("doc_id", "source")
    return labels.join(docs, "doc_id").select(
        F.col("source").alias("remote"),
        path_of(F.col("doc_id")).alias("path"),
        F.lit("").alias("hash"),
        F.when(F.col("quality") == 1, "C").otherwise("I").alias("rating"),
        F.lit("").alias("comment"),
        F.lit("labels").alias("username"),
        F.col("doc_id").alias("created_at"),
    )
