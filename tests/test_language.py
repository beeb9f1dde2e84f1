import math
from collections import Counter

import pytest

from textloom.operators import language
from textloom.operators.language import LanguageModel

TEXTS = [
    ("1", "ger", "der die das und nicht straße"),
    ("2", "ger", "ich und du"),
    ("3", "eng", "the quick brown fox and the dog"),
    ("4", "eng", "that is not the way"),
    ("5", None, "und die that"),
    ("6", None, "1 2 3 a b"),
    ("7", None, "żółć"),
]


@pytest.fixture
def docs(spark):
    rows = [(p, c, bytearray(t.encode())) for p, c, t in TEXTS]
    return spark.createDataFrame(rows, "path string, lang_code string, content binary")


def bigrams(text):
    return [w[i : i + 2] for w in text.lower().split() if w.isalpha() for i in range(len(w) - 1)]


def brute_force():
    counts = {c: Counter(g for _, l, t in TEXTS if l == c for g in bigrams(t)) for c in ("eng", "ger")}
    vocabulary = len(set(counts["eng"]) | set(counts["ger"]))
    out = {}
    for path, _, text in TEXTS:
        grams = bigrams(text)
        scores = {
            c: sum(math.log((n[g] + 1) / (n.total() + vocabulary)) for g in grams)
            for c, n in counts.items()
        }
        best = max(scores, key=scores.get)
        mass = sum(math.exp(s - scores[best]) for s in scores.values())
        out[path] = (best, 1 / mass) if grams else (None, None)
    return out


def test_detect(docs):
    model = LanguageModel.fit(docs)
    assert model.languages == ("eng", "ger")
    got = {r["path"]: (r["lang_code"], r["lang_score"]) for r in model.detect(docs).collect()}
    want = brute_force()
    assert got.keys() == want.keys()
    for path, (code, score) in want.items():
        assert got[path][0] == code
        assert got[path][1] == (pytest.approx(score) if code else None)


def test_stored_model(spark, docs, tmp_path):
    model = LanguageModel.fit(docs)
    model.save(str(tmp_path / "model"))
    loaded = LanguageModel.load(spark, str(tmp_path / "model"))
    assert (loaded.languages, loaded.unseen) == (model.languages, model.unseen)
    key = [sorted(map(str, m.detect(docs).collect())) for m in (model, loaded)]
    assert key[0] == key[1]


def test_rare_bigrams_count_as_much_as_common_ones(spark, docs, tmp_path):
    whole = LanguageModel.fit(docs)
    want = sorted(map(str, rounded(whole.detect(docs))))
    assert not whole.rare and whole.weights.where("NOT common").isEmpty()
    for common in (0, 1, 5):
        model = LanguageModel.fit(docs, common=common)
        assert model.rare and model.weights.where("common").select("gram").distinct().count() == common
        assert model.weights.count() == whole.weights.count()
        assert sorted(map(str, rounded(model.detect(docs)))) == want
    model.save(str(tmp_path / "m"))
    assert sorted(map(str, rounded(LanguageModel.load(spark, str(tmp_path / "m")).detect(docs)))) == want


def rounded(found):
    return [(r["path"], r["lang_code"], r["lang_score"] and round(r["lang_score"], 9)) for r in found.collect()]


def test_a_large_vocabulary_is_not_sent_around(spark):
    """Two languages of 400,000 bigrams each, most of them their own."""
    rows = []
    for base, code in ((0x4E00, "chi"), (0x5A00, "jpn")):
        pairs = [chr(base + i % 700) + chr(base + i // 700) for i in range(400_000)]
        rows += [(code, str(i), code, " ".join(pairs[i : i + 500]).encode()) for i in range(0, 400_000, 500)]
    docs = spark.createDataFrame(rows, "remote string, path string, lang_code string, content binary").repartition(8)
    model = LanguageModel.fit(docs, common=1000)
    assert model.rare and model.weights.count() > 790_000
    found = model.detect(docs)
    assert found.where("remote <> lang_code OR lang_code IS NULL").isEmpty() and found.count() == 1600
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [gram" in plan


def test_bounds_of_a_fit(docs):
    some = docs.union(docs).union(docs)
    assert LanguageModel.fit(some, documents=8).weights.count() <= LanguageModel.fit(docs).weights.count()


def test_a_rare_language_stays_in_a_large_corpus(spark):
    pairs = [chr(0xAC00 + i) + chr(0xAC01 + i) for i in range(400)]
    many = spark.range(6000).selectExpr("CAST(id AS STRING) AS path", "'kor' AS lang_code", f"CAST('{' '.join(pairs)}' AS BINARY) AS content")
    few = spark.createDataFrame([("x", "ger", bytearray("und nicht".encode()))], "path string, lang_code string, content binary")
    model = LanguageModel.fit(many.union(few), documents=50, common=20)
    assert model.languages == ("ger", "kor")
    assert {"un", "nd"} <= {r["gram"] for r in model.weights.where("common").collect()}
    assert model.detect(few).first()["lang_code"] == "ger"
    assert language._bound([5, 100, 100], 105) == 50 and language._bound([5, 6], 20) == 6


def test_equal_paths_of_two_remotes(spark):
    texts = [("a", "p", "eng", "the way that the"), ("b", "p", "ger", "und nicht die und")]
    rows = [(r, p, c, bytearray(t.encode())) for r, p, c, t in texts]
    docs = spark.createDataFrame(rows, "remote string, path string, lang_code string, content binary")
    found = {r["remote"]: r["lang_code"] for r in LanguageModel.fit(docs).detect(docs).collect()}
    assert found == {"a": "eng", "b": "ger"}


def test_detect_shuffles_no_text(docs):
    plan = LanguageModel.fit(docs).detect(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # One of the documents' sums and one of the model.
    assert sorted(line.split("(")[1].split("#")[0] for line in shuffles) == ["gram", "path"]


def test_named_languages(docs):
    model = LanguageModel.fit(docs, languages=["ger", "eng", "fre"])
    assert model.languages == ("ger", "eng")  # no French document
    assert model.detect(docs).where("path = '1'").first()["lang_code"] == "ger"


def test_no_labels(docs):
    with pytest.raises(ValueError):
        LanguageModel.fit(docs.where("lang_code IS NULL"))


def test_a_row_for_each_distinct_bigram(docs_of, monkeypatch):
    """Not one for each place in a text; letters beyond the basic plane, no text and no letters count as well."""
    from textloom.operators import language

    texts = {"a": "ABAB ab\nba", "b": "𐐀𐐀𐐀x1y", "c": "", "d": "1 2", "e": "The the " * 1000, "f": "é́éé"}
    for at_once in (1, 1 << 21):
        monkeypatch.setattr(language, "LETTERS", at_once)
        found = language._bigram_counts(docs_of(texts), "path").collect()
        got = {(r.path, r.gram): r.times for r in found}
        assert len(got) == len(found) and got == {
            ("a", "ab"): 3, ("a", "ba"): 2, ("b", "𐐨𐐨"): 2, ("b", "𐐨x"): 1, ("c", None): 0, ("d", None): 0,
            ("e", "th"): 2000, ("e", "he"): 2000, ("f", "éé"): 1,
        }
