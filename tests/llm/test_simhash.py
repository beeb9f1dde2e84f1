"""Near-dedup against all pairs of fingerprints."""

import numpy as np
import pytest
import xxhash

from textloom.llm import simhash
from textloom.llm.components import components, local_roots

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def by_hand(text):
    """The fingerprint, bit by bit."""
    words = [w for w in (text or "").encode().translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")).lower().split(b" ") if w]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fingerprints, distance=4):
    """Smallest position reachable, over all pairs."""
    fp = np.array(fingerprints, np.uint64)
    a, b = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None]) <= distance)
    return local_roots(len(fp), a, b).tolist()


def test_fingerprint_by_hand():
    texts = ["", None, " \t\n", "One", "one TWO three", "a b c d e f", "É x\x85y z\xa0w Ä", "a b c d " * 3000, "x\x0by\x0cz"]
    for text in texts:
        assert np.uint64(simhash.fingerprint(text) & (2**64 - 1)) == by_hand(text), text


def test_near_duplicates(spark):
    rng = np.random.default_rng(5)
    texts = [None, "", " ", "x" * 100_000]
    for _ in range(40):
        words = list(rng.choice(WORDS, 60))
        texts += [" ".join(words)] * 2
        words[int(rng.integers(60))] = "changed"
        texts.append(" ".join(words))
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "again " * 9, "clash", 2), (None, texts[4], "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint & (2**64 - 1), r.component_id) for r in found.collect())
    prints = [by_hand(t) for _, t, *_ in rows]
    roots = groups(prints)
    least = {}
    for (doc, *_), root in zip(rows, roots, strict=True):
        if doc is not None:
            least[root] = min(least.get(root, doc), doc)
    want = sorted(
        (doc if doc is not None else -1, p, least[root]) for (doc, *_), p, root in zip(rows, prints, roots, strict=True)
    )
    assert got == want
    assert len({c for *_, c in got}) < len(set(prints))


@pytest.mark.parametrize("n, m", [(10, 5), (10**7, 3), (10**10, 2)])
def test_groups_grow_with_the_corpus(n, m):
    assert simhash.group_count(n, 4) == m


@pytest.mark.parametrize("m", [1, 2, 3, 4, 5])
def test_links_lose_nothing(spark, monkeypatch, m):
    """Skewed and random fingerprints, whatever the number of groups."""
    monkeypatch.setattr(simhash, "group_count", lambda n, distance: m)
    rng = np.random.default_rng(m)
    base = rng.integers(-(2**63), 2**63, 12, dtype=np.int64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(63, int(rng.integers(0, 6)), replace=False)) for x in base for _ in range(4)]
    prints = sorted({int(x) for x in base} | set(near) | {0, 1, 3, 7, 15, 31, -1})
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {(r.a, r.b) for r in simhash.links(nodes, 3 if m < 5 else 4).collect()}
    limit = 3 if m < 5 else 4
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= limit}
    assert got == want


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(0)
    cost = np.concatenate([np.zeros((6, 3, 1)), rng.random((6, 3, 5)).cumsum(2)], axis=2)
    radius = simhash.thresholds(cost, 4)
    assert (radius.sum(1) == 4 - 3 + 1).all()
    for q in range(6):
        best = min(
            cost[q, 0, a] + cost[q, 1, b] + cost[q, 2, c] for a in range(6) for b in range(6) for c in range(6) if a + b + c == 5
        )
        assert cost[q, range(3), radius[q] + 1].sum() == pytest.approx(best)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 50), (60, 60), (None, 1), (100, 70), (100, 80), (90, 80)]
    links += [(200, 200 + i) for i in range(1, 60)]
    found = components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()
    want = {i: 1 for i in range(1, 31)} | {40: 40, 50: 40, 100: 70, 70: 70, 80: 70, 90: 70}
    want |= {200 + i: 200 for i in range(60)}
    assert sorted((r.node, r.root) for r in found) == sorted(want.items())
