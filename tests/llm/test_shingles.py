"""Near duplicates of the pipeline against the similarity of all pairs."""

import random

import numpy as np
import pytest

from textloom.llm import shingles
from textloom.llm.components import local_roots


def sets(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def alike(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(500)]
    rows = [(0, None), (1, ""), (2, "A b"), (3, "a  b"), (4, "a b c")]
    for _ in range(60):
        base = rng.choices(words, k=rng.randint(60, 300))
        for edits in (0, 0, 1, 2, 3, 4, 6):
            other = list(base)
            for at in rng.sample(range(len(base)), edits):
                other[at] = rng.choice(words)
            rows.append((len(rows), " ".join(other)))
    base = rng.choices(words, k=120)
    for _ in range(150):  # a large group, not all of it like its smallest
        other = list(base)
        for at in rng.sample(range(len(base)), 2):
            other[at] = rng.choice(words)
        rows.append((len(rows), " ".join(other)))
    return rows


def test_components_are_those_of_all_pairs(spark, rows):
    own = [sets(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(own)) for j in range(i) if alike(own[i], own[j])]
    a, b = np.array(pairs).T
    want = local_roots(len(own), a, b).tolist()
    found = shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(want)) and len(found) == len(rows)


def test_pairs_at_the_threshold_share_a_band():
    rng = np.random.default_rng(9)
    missed = 0
    for _ in range(500):
        whole = rng.integers(0, 1 << 63, 100, np.uint64)
        missed += not set(shingles.sketch(whole[:90])[0]) & set(shingles.sketch(whole[10:])[0])  # 80 of 100
    assert missed <= 4  # 0.7 expected


def test_pairs_at_the_threshold_agree_and_others_do_not():
    rng = np.random.default_rng(10)
    low = shingles.least_agreement(0.8)

    def agreed(share):
        whole = rng.integers(0, 1 << 63, 600, np.uint64)
        cut = round(600 * (1 - share) / 2)
        a, b = (np.array(shingles.sketch(x)[1]) for x in (whole[: 600 - cut], whole[cut:]))
        return 256 - int(np.bitwise_count((a ^ b).view(np.uint64)).sum())

    assert all(agreed(0.8) >= low for _ in range(200))
    assert sum(agreed(0.5) >= low for _ in range(200)) <= 8


def test_a_shared_passage_makes_few_candidates(spark, monkeypatch):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    seen = {}

    def count(pairs, *_):
        seen[len(seen)] = pairs.count()
        return verified(pairs, *_)

    verified = shingles._verified
    monkeypatch.setattr(shingles, "_verified", count)
    for n in (200, 800):
        seen.clear()
        passage = " ".join(rng.choices(words, k=120))
        rows = [(i, passage + " " + " ".join(rng.choices(words, k=60))) for i in range(n)]
        found = shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.where("doc_id <> component_id").isEmpty()
        assert sum(seen.values()) <= n


def test_a_group_nearly_as_like_as_asked_for_makes_few_candidates(spark, monkeypatch):
    """Pairs that the sketch can't tell from similar ones fail inside the join; their number was the square of the group."""
    rng = random.Random(13)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    base, rows = rng.choices(words, k=150), []
    for i in range(400):
        other = list(base)
        for at in rng.sample(range(len(base)), rng.choice([1, 2, 3, 3, 4])):
            other[at] = rng.choice(words)
        rows.append((i, " ".join(other)))
    own = [sets(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(own)) for j in range(i) if alike(own[i], own[j])]
    seen, verified = [], shingles._verified
    monkeypatch.setattr(shingles, "_verified", lambda pairs, *rest: seen.append(pairs.count()) or verified(pairs, *rest))
    found = shingles.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(local_roots(len(own), *np.array(pairs).T).tolist()))
    assert seen[1] <= 2 * len(rows)


def test_smallest_hashes_keep_pairs_at_the_threshold(spark):
    """Sets known whole are told apart; of larger ones, those at the threshold stay and those far from it go."""
    rng = np.random.default_rng(14)
    rows = []
    for n in (50, 200, 240, 255, 256, 300, 2_000):
        for share in (0.8, 0.6):
            for _ in range(20):
                whole = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
                cut = int(len(whole) * (1 - share) / 2)
                a, b = whole[rng.permutation(len(whole))], None
                a, b = np.sort(a[cut:]), np.sort(a[: len(a) - cut])
                rows.append((n, share, shingles.similar(a, b, 0.8), shingles.smallest(a), shingles.smallest(b)))
    df = spark.createDataFrame(rows, "n int, share double, similar boolean, a array<int>, b array<int>")
    got = df.select("n", "share", "similar", shingles.may_be_similar(df["a"], df["b"], 0.8).alias("may")).collect()
    assert all(r.may for r in got if r.similar) and sum(r.similar for r in got) == 140
    assert not any(r.may for r in got if r.share < 0.8)
    assert shingles.smallest(np.empty(0, np.uint64)) == []
