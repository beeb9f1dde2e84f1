"""The stages over a small corpus, each against its rule."""

import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from textloom.llm import secrets, toxicity
from textloom.llm.components import local_roots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
pytest.importorskip("public_tokenizers")


def sets(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def alike(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def corpus():
    rng = random.Random(3)
    syllables = "an re th ti on er es or ha wh nd st ing ed en ou".split()
    rows, labels = [], []
    for i in range(300):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(80)]
        bad = i % 5 == 0
        if bad:
            for at in range(0, 80, 7):
                words[at] = rng.choice(["worthless", "pathetic", "disgusting"])
        if i % 9 == 1:
            words[5] = "password=abcdefgh12345"
        rows.append((i, " ".join(words), "en", f"src{i % 4}"))
        labels.append((i, int(bad)))
    for i in range(300, 330):
        text = rows[i - 299][1].split()
        if i % 2:
            text[40] = "edited"  # a near copy: 72 to 71 of 81 shingles stay
        rows.append((i, " ".join(text), "en", "src9"))
    rows += [(400, None, None, None), (401, "", "en", "src1"), (7, rows[7][1], "en", rows[7][3]), (None, "no id here at all", "en", "src1")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], labels


def test_stages(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        kept.append(docs.collect())
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean, single, safe, mixed, coded = kept

    model = toxicity.fit_on(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = model.scores([r[1] for r in rows])
    assert sorted(str(r.doc_id) for r in clean) == sorted(str(r[0]) for r, s in zip(rows, scores, strict=True) if s < 0.5)
    assert {r.doc_id for r in clean} >= {i for i, *_ in rows if i is not None and i % 5 and i < 300}

    own = [sets(r.text) for r in clean]
    pairs = [(i, j) for i in range(len(own)) for j in range(i) if alike(own[i], own[j])]
    root = local_roots(len(own), *np.array(pairs).T)
    first = {}
    for r, k in zip(clean, root, strict=True):
        named = (r.doc_id is None, r.doc_id or 0)
        first[k] = min(first.get(k, named), named)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in single) == sorted(first.values())

    assert sorted(str(r.doc_id) for r in safe) == sorted(str(r.doc_id) for r in single)
    assert not any(secrets.find(r.text)[0] for r in safe)
    assert any("[REDACTED]" in (r.text or "") for r in safe)
    assert all(r.n_chars == len(r.text or "") for r in safe)

    by_id = {r.doc_id: r for r in safe}
    cut = [r for r in mixed if by_id[r.doc_id] != r]
    assert all(by_id[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text) for r in cut)
    assert len(cut) <= len({r.source for r in safe})
    words = {i: len((r.text or "").split()) for i, r in by_id.items()}
    got = sum(len((r.text or "").split()) for r in mixed)
    assert abs(got - 1.5 * sum(words.values())) <= 6  # a word for each source
    assert sorted(str(r.doc_id) for r in coded) == sorted(str(r.doc_id) for r in mixed)
    shas = {hashlib.sha256((r.text or "").encode()).hexdigest() for r in mixed}
    assert {r.decoded_sha256 for r in coded} == shas


def test_run_and_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.collect() == [] and found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_a_source_of_one_long_document_is_cut(spark):
    rows = [(i, "w x y z " * 5, "en", "a", 40) for i in range(50)] + [(99, "long " * 4000, "en", "b", 20_000)]
    schema = SCHEMA + ", mark string, times string"
    docs = spark.createDataFrame([(*r, "m", "t") for r in rows], schema)
    found = corpus_pipeline.mix(spark, docs, "").collect()
    target = corpus_pipeline.mixing.mix(docs.select("doc_id", "text", "source"))[0].where("doc_id = 99").first()["taken"]
    words = sum(len(r.text.split()) for r in found if r.doc_id == 99)
    assert words == target and words % 4000 and all(r.n_chars == len(r.text) for r in found)


def test_near_duplicates_are_those_of_fingerprints_and_of_sets(spark, monkeypatch):
    """Groups by fingerprints {0, 1, 2} and {4, 5} and by sets {2, 3} and {5, 6}: one of each chain stays."""
    docs = spark.createDataFrame([(i, str(i), "en", "a", 1) for i in [*range(8), 7]] + [(None, "8", "en", "a", 1)], SCHEMA)

    def groups(of):
        def near_duplicates(named, id_col):
            rows = {r.row.id: r.row for r in named.collect()}
            found = [(r.row, rows[of.get(r.row.id, r.row.id)]) for r in named.select("row").collect()]
            kind = named.schema["row"].dataType.simpleString()
            return spark.createDataFrame(found, f"row {kind}, component_id {kind}")

        return near_duplicates

    monkeypatch.setattr(corpus_pipeline.simhash, "near_duplicates", groups({1: 0, 2: 0, 5: 4}))
    monkeypatch.setattr(corpus_pipeline.shingles, "near_duplicates", groups({3: 2, 6: 5}))
    found = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(found, key=str) == [0, 4, 7, None]


def test_clashing_columns(spark):
    rows = [(1, "password=abcdefgh12345", "en", "a", 22), (1, "password=abcdefgh12345", "en", "a", 22), (None, None, None, None, 0)]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA + ", mark_ string, before_ string, doc string")
    assert [len(stage(spark, docs, "").collect()) for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.secret_scan)] == [2, 3]
    assert corpus_pipeline.secret_scan(spark, docs, "").columns == docs.columns
