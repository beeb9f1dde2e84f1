"""What the plans shuffle: short columns, never the text."""

import pytest
from pyspark.sql import functions as F

from textloom.functions.text import sha256
from textloom.operators import inventory
from textloom.operators.authority import link_counts
from textloom.operators.index import build_index, document_stats
from textloom.operators.language import LanguageModel
from textloom.operators.letter_table import letter_table
from textloom.operators.references import references
from textloom.operators.summary import summary
from textloom.operators.vocabulary import vocabulary
from textloom.plans import corpus as c
from textloom.operators.grep import grep
from textloom.operators.lists import restrict_documents
from textloom.session import durable
from textloom.sources.writers import write_bucketed


@pytest.fixture
def docs(docs_of):
    labelled = docs_of({"data/toc/1.txt": "the one", "data/toc/2.txt": "the two ISSN 1234-5678"})
    return labelled.withColumn("lang_code", F.lit("eng"))


def test_maps_do_not_shuffle(docs, shuffled):
    assert shuffled(document_stats(docs, "r")) == []
    assert shuffled(letter_table(docs)) == []
    assert shuffled(references(docs)) == []
    assert shuffled(inventory.file_facts(docs)) == []


def test_text_is_not_shuffled(docs, shuffled):
    model = LanguageModel.fit(docs)
    index = build_index(docs, "r", model.detect(docs))
    plans = [
        index,
        model.detect(docs),
        vocabulary(docs, 3, ordered=False),
        inventory.status(index, docs),
        inventory.violations(index, docs),
        summary(index),
    ]
    for plan in plans:
        inputs = shuffled(plan)
        assert inputs
        for columns in inputs:
            assert not columns & {"content", "text", "kept", "grams", "folded"}


def test_vocabulary_shuffles_partial_counts(docs, shuffled):
    (columns,) = shuffled(vocabulary(docs, 2, ordered=False))
    assert "token" in columns
    assert not columns & {"path", "once"}


def test_distinct_counts_are_spread_by_the_counted_column(docs, spark, shuffled):
    assert any("hash" in columns for columns in shuffled(summary(build_index(docs, "r"))))
    links = spark.createDataFrame([(1, "x")], "record_id long, target string")
    first, second = shuffled(link_counts(links, distinct=False))[:2]
    assert {"record_id", "target"} in (first, second)


def test_predicates_and_columns_reach_the_scan(spark, tmp_path):
    table = spark.range(10).selectExpr("id AS doc_id", "'src' AS source", "'text' AS text", "'de' AS lang", "id AS n_chars")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    docs = c.corpus(spark, str(tmp_path))
    plan = docs.where("remote = 'src'").select("path")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,src)" in plan
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


@pytest.mark.parametrize("operator", [letter_table, lambda d, where: build_index(d, F.col("remote"), where=where)])
def test_where_reaches_the_scan(spark, tmp_path, operator):
    path = str(tmp_path / "docs")
    spark.sql("SELECT 'a' AS remote, 'p' AS path, 1L AS mtime, binary('x') AS content").write.parquet(path)
    plan = operator(spark.read.parquet(path), where="remote = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(remote,a)" in plan


def test_large_lists_leave_the_text_in_place(spark, docs, shuffled):
    """Nothing is small enough to be sent around; documents lie in buckets of their key."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        listed = docs.select("path").withColumn("ppn", F.lit("1"))
        write_bucketed(docs.withColumn("ppn", F.lit("1")), "bucketed_docs", 4)
        stored = spark.table("bucketed_docs")
        index = docs.select("path", "mtime")
        plans = [
            grep(index, "the", docs, where="mtime > 0"),
            restrict_documents(stored, listed),
            vocabulary(restrict_documents(stored, listed), 2, ordered=False),
        ]
        for plan in plans:
            assert shuffled(plan)
            for columns in shuffled(plan):
                assert not columns & {"content", "text", "tokens", "kept"}
        assert plans[1].count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_docs")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_durable_survives_without_its_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    kept = durable(spark.read.parquet(path).select(sha256(F.col("id").cast("string").cast("binary")).alias("h")))
    spark.range(3).write.mode("overwrite").parquet(path)
    assert kept.count() == 5
