"""The operators over the given tables, each with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    alignment,
    html,
    licenses,
    mixing,
    pieces,
    records,
    secrets,
    simhash,
    spellings,
    syncmers,
    topk,
    toxicity,
    vectors,
)
from textloom.llm.ship import shared_folder


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents"))


def op3_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf, "documents"))
    order = F.array(*map(F.lit, secrets.KINDS))

    def written(spans: Column) -> Column:
        ranked = F.transform(
            spans, lambda x: F.struct(x["start"], F.array_position(order, x["kind"]), x["end"], x["kind"])
        )
        parts = F.transform(F.array_sort(ranked), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.array_join(parts, ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, ("assign", "access", "hex")),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("base", "linked")).alias("spans"),
    )


def op4_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf, "embeddings"))


def op5_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    found = pages.select("page_id", "url", F.array_join(html.blocks(pages), "\n").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return digests(pieces.encode_decode(_table(spark, sf, "documents"), tokenizer_file("piece_bpe_32k.model")))


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_records(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "token-records")
    index = records.write_records(_table(spark, sf, "documents"), folder, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return records.read_records(index, folder).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents"))[0]


def op9_topk(spark: SparkSession, sf: str) -> DataFrame:
    table = _table(spark, sf, "embeddings")
    codes = table.select("vec_id", topk.sign_code(F.col("embedding")).alias("code"))
    return topk.top_k(codes, codes.where("vec_id % 20 = 0"), k=10, id_col="vec_id")


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    model = toxicity.fit_on(docs, _table(spark, sf, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op11_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.compare_with_next(_table(spark, sf, "documents"))


def op12_spellings(spark: SparkSession, sf: str) -> DataFrame:
    return spellings.variants(spellings.words(_table(spark, sf, "documents")))


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return alignment.align(_table(spark, sf, "documents"), *files)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_licenses": op2_licenses,
    "op3_secrets": op3_secrets,
    "op4_vectors": op4_vectors,
    "op5_html": op5_html,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_records": op7_records,
    "op8_mixing": op8_mixing,
    "op9_topk": op9_topk,
    "op10_toxicity": op10_toxicity,
    "op11_syncmers": op11_syncmers,
    "op12_spellings": op12_spellings,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = {
    "op9_topk": """
WITH codes AS (
  SELECT vec_id, CAST(array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS BIT) AS code
  FROM embeddings WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND NOT isnan(x)))),
found AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id, CAST(bit_count(xor(q.code, c.code)) AS INTEGER) AS distance
  FROM (SELECT * FROM codes WHERE vec_id % 20 = 0) q, codes c)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM found)
WHERE rank <= 10""",
}
