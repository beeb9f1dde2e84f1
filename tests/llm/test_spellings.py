"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from textloom.llm import queries, spellings


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= 5 * n else None
        out[w] = (form, n, len(others), counts[form] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def found_of(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("parts", ["1", "3", "16"])
def test_variants_are_those_of_all_pairs(spark, parts):
    rng = random.Random(int(parts))
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(500)} | {"z" * 400, "z" * 401, "z" * 399 + "y"}
    counts = {w: rng.choice([1, 2, 5, 30, 200, 1000, 1000, 25_000]) for w in words}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [(w, n, "x") for w, n in counts.items()] + [("", 9, "x"), (None, 9, "x")]
        found = found_of(spellings.variants(spark.createDataFrame(rows, "word string, n long, node string")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == brute(counts)


def counted(rows):
    low = str.maketrans(spellings.CAPITALS, spellings.SMALL)
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def test_query(spark, tmp_path):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeÉé") for _ in range(rng.randint(5, 8))) for _ in range(60)] + ["STRASSE", "straße", "x×÷yzwv"]
    rows = [(i % 350, " ".join(rng.choices(words, k=40)) + rng.choice(["\n", "", ".", "7"])) for i in range(400)]
    rows += [(None, "without id " * 9), (1, None), (2, ""), (3, "longword " * 30_000), (4, "q" * 20_000 + " " + "q" * 19_999)] * 5
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    table.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    want = counted(rows)
    assert found_of(queries.op12_spellings(spark, str(tmp_path))) == brute(want)
    assert defaultdict(int, want)["longword"] >= 149_000


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    found = spellings.variants(spellings.words(docs))
    assert found.collect() == [] and found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
