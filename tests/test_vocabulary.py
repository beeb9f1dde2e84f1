import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import vocabulary as module
from textloom.operators.vocabulary import vocabulary
from textloom.sources.readers import read_stopwords

TEXTS = {
    "data/a/1.txt": "The cat sat. The cat ran, the DOG sat.",
    "data/a/2.txt": "A dog and the cat; x y z it's",
    "data/a/3.txt": "one",
    "data/a/4.txt": "",
    "data/a/5.txt": "it's it's ǅaba the the the",
}


def brute_force(texts, n, min_len=2, keep=lambda w: True, stop=()):
    tf, df = Counter(), Counter()
    for text in texts.values():
        raw = [w.strip(".,;") for w in text.split()]
        kept = [w.lower() for w in raw if len(w) >= min_len and keep(w) and w.lower() not in stop]
        windows = [" ".join(kept[i : i + n]) for i in range(len(kept) - n + 1)]
        tf.update(windows)
        df.update(set(windows))
    return [(t, tf[t], df[t]) for t in sorted(tf, key=lambda t: (-tf[t], -df[t], t))]


def found(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_ngrams(docs_of, n):
    assert found(vocabulary(docs_of(TEXTS), n)) == brute_force(TEXTS, n)


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("joined", [True, False])
def test_stopwords_both_ways(spark, docs_of, tmp_path, n, joined):
    (tmp_path / "stop.txt").write_text("the\nit's\nDOG\nx\n\\w'\n")
    stop = read_stopwords(spark, str(tmp_path / "stop.txt"))
    listed = stop if joined else [r[0] for r in stop.collect()]
    got = found(vocabulary(docs_of(TEXTS), n, stopwords=listed))
    assert got == brute_force(TEXTS, n, stop={"the", "it's"})


def test_stopword_length_is_in_bytes(spark, docs_of):
    stop = spark.createDataFrame([("é",), ("a",)], "value string")
    texts = {"p": "é a bc"}
    assert found(vocabulary(docs_of(texts), min_token_len=1, stopwords=stop)) == [("bc", 1, 1)]
    got = found(vocabulary(docs_of({"p": "éé a bc"}), min_token_len=2, stopwords=stop))
    assert got == [("bc", 1, 1), ("éé", 1, 1)]


def test_category(docs_of):
    upper = brute_force(TEXTS, 1, keep=lambda w: any(c.isupper() for c in w))
    assert found(vocabulary(docs_of(TEXTS), categories=["u"])) == upper
    assert ("ǆaba", 1, 1) in found(vocabulary(docs_of(TEXTS), categories=["t"]))
    assert found(vocabulary(docs_of(TEXTS), categories=["a"])) == brute_force(TEXTS, 1)
    with pytest.raises(ValueError, match="category"):
        vocabulary(docs_of(TEXTS), categories=["q"])


def test_thresholds(docs_of):
    want = [r for r in brute_force(TEXTS, 1) if r[1] >= 2 and r[2] >= 2]
    assert found(vocabulary(docs_of(TEXTS), min_tf=2, min_df=2)) == want


def test_lists_and_predicate(spark, docs_of):
    allowed = spark.createDataFrame([("1",), ("2",), ("3",), ("1",)], "ppn string")
    denied = spark.createDataFrame([("2",)], "ppn string")
    got = vocabulary(docs_of(TEXTS), allow=allowed, deny=denied, where="path NOT LIKE '%/3.txt'")
    assert found(got) == brute_force({"1": TEXTS["data/a/1.txt"]}, 1)


def test_one_shuffle_before_the_sort(docs_of):
    plan = vocabulary(docs_of(TEXTS), 2, ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Exchange hashpartitioning(token" in plan
    # The text is tokenised once: no filter that repeats the pattern.
    assert plan.count("regexp_extract_all") == 1


def test_same_text_many_times(spark):
    docs = spark.range(500).select(
        F.concat(F.lit("p"), "id").alias("path"), F.lit("aa bb aa bb").cast("binary").alias("content")
    )
    assert found(vocabulary(docs, 2)) == [("aa bb", 1000, 500), ("bb aa", 500, 500)]


@pytest.mark.parametrize("joined", [True, False])
def test_documents_of_one_path_share_no_window(spark, joined):
    """Two remotes with the same path, and a document that is there twice."""
    rows = [("a", "p", bytearray(b"one two three")), ("b", "p", bytearray(b"four five six"))] * 2
    docs = spark.createDataFrame(rows, "remote string, path string, content binary")
    listed = spark.createDataFrame([("none",)], "value string") if joined else ["none"]
    got = found(vocabulary(docs, 2, stopwords=listed))
    assert got == [(g, 2, 2) for g in ("five six", "four five", "one two", "two three")]


def test_where_with_a_tail(docs_of):
    docs = docs_of({"a": "x1 x1", "b": "x2", "c": "x3"})
    got = found(vocabulary(docs, where="mtime >= (SELECT min(mtime) + 1 FROM df) ORDER BY path DESC LIMIT 1"))
    assert got == [("x3", 1, 1)]


def test_a_window_is_one_row_before_it_is_counted(docs_of):
    """Windows are neither exploded a second time for df nor made distinct apart; repeats count once for df."""
    texts = {"data/a/1.txt": "ba ba ba ba ab ba ba", "data/a/2.txt": "ba ba", "data/a/3.txt": "", "data/a/4.txt": "ba"}
    for n in (1, 2, 3):
        counted = vocabulary(docs_of(texts), n, ordered=False)
        plan = counted._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate posexplode") == 1 and plan.count("Generate") == 1 and "array_distinct" not in plan
        assert sorted(found(counted)) == sorted(brute_force(texts, n))


def test_a_long_document_takes_time_in_proportion(spark):
    """The windows of a document are not copied for each of them: 16 times the words may take 64 times as long, not 256."""

    def seconds(words):
        text = " ".join(f"w{i % 9973}" for i in range(words))
        docs = spark.createDataFrame([("data/a/1.txt", bytearray(text.encode()))], "path string, content binary")
        start = time.perf_counter()
        total = vocabulary(docs, 2, ordered=False).agg(F.sum("tf"), F.max("df")).first()
        assert tuple(total) == (words - 1, 1)
        return time.perf_counter() - start

    seconds(5_000)
    assert seconds(320_000) < 64 * max(seconds(20_000), 0.25)


@pytest.mark.parametrize("n", [2, 3])
@pytest.mark.parametrize("planned", [20_000, 2, 1])
def test_stopword_tables_of_either_size(spark, docs_of, shuffled, monkeypatch, n, planned):
    """A table of a few words is part of the plan, so that only windows are shuffled; a longer one is joined."""
    monkeypatch.setattr(module, "PLANNED_STOPWORDS", planned, raising=False)
    listed = spark.createDataFrame([("the",), ("\\w'",), ("the",), (None,), ("x",)], "value string")
    counted = vocabulary(docs_of(TEXTS), n, stopwords=listed, ordered=False)
    assert sorted(found(counted)) == sorted(brute_force(TEXTS, n, stop={"the"}))
    if planned > 1:
        assert all(columns >= {"token"} and not columns & {"doc", "pos"} for columns in shuffled(counted))
    assert ("LeftAnti" in counted._jdf.queryExecution().optimizedPlan().toString()) == (planned < 2)


def test_documents_of_one_path_share_no_window_in_a_join(spark, monkeypatch):
    monkeypatch.setattr(module, "PLANNED_STOPWORDS", 0, raising=False)
    rows = [("a", "p", bytearray(b"one two the three")), ("b", "p", bytearray(b"four the five six"))] * 2
    docs = spark.createDataFrame(rows, "remote string, path string, content binary")
    got = found(vocabulary(docs, 2, stopwords=spark.createDataFrame([("the",)], "value string")))
    assert got == [(g, 2, 2) for g in ("five six", "four five", "one two", "two three")]
