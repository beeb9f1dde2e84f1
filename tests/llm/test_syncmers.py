"""Closed syncmers by definition, and each document against the next."""

import hashlib
import random

import numpy as np
import pytest

from textloom.llm import queries, syncmers


def plain(text):
    """Closed syncmers one by one; hashes are those of the substrings alone."""
    points = [*syncmers.MARKS.tolist(), *map(ord, text)]
    mask, factor = (1 << 64) - 1, syncmers._FACTOR

    def value(part):
        found = sum((p + 1) * pow(factor, i, 1 << 64) for i, p in enumerate(part)) & mask
        for _ in range(2):
            found = (found ^ (found >> 32)) * 0xD6E8FEB86659FD93 & mask
        return found

    k, s = syncmers.K, syncmers.S
    out = []
    for i in range(len(points) - k + 1):
        part = points[i : i + k]
        inner = [value(part[j : j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i - len(syncmers.MARKS), value(part)))
    return out


def test_anchors_by_definition(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab cdé日😀\n") for _ in range(rng.randint(4, 90))) for _ in range(60)] + ["a" * 60]
    for window in (1 << 16, 7):
        monkeypatch.setattr(syncmers, "WINDOW", window)
        for text in texts:
            want = plain(text)
            at, hashes = syncmers.anchors(text)
            if want:
                assert list(zip(at.tolist(), hashes.tolist(), strict=True)) == want
            else:
                assert len(text) < 2 * syncmers.K and len(at) == 1
    assert len(syncmers.anchors(None)[0]) == len(syncmers.anchors("")[0]) == 0
    assert syncmers.anchors("ab")[1] != syncmers.anchors("ac")[1]


def test_anchors_do_not_depend_on_what_is_around():
    rng = random.Random(5)
    middle = "".join(rng.choice("abcdefgh ") for _ in range(500))
    found = [set(zip(*(x.tolist() for x in syncmers.anchors(a + middle + b)), strict=True)) for a, b in (("x" * 30, "y"), ("", "zz"))]
    moved = {(at - 30, h) for at, h in found[0] if 0 <= at - 30 <= 500 - syncmers.K}
    assert moved == {(at, h) for at, h in found[1] if 0 <= at <= 500 - syncmers.K}
    gaps = np.diff(sorted(at for at, _ in moved))
    assert gaps.max() <= syncmers.K - syncmers.S


def test_likeness():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    a, b, half = " ".join(words[:1000]), " ".join(words[1000:2000]), " ".join(words[:500] + words[2000:2500])
    of = syncmers.sketch
    assert syncmers.likeness(of(a), of(a)) == 1 and syncmers.likeness(of(a), of(b)) < 0.05
    assert abs(syncmers.likeness(of(a), of(half)) - 0.5) < 0.12
    assert syncmers.likeness(of(""), of(None)) == 1 and syncmers.likeness(of(""), of("a")) == 0
    assert len(of(a)) == syncmers.KEPT


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[3]))
    out = []
    for i, (doc, text, *_) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, e, n = (syncmers.sketch(t) for t in (text, edited, following))
        out.append(
            (
                doc,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                syncmers.written(a),
                syncmers.written(e),
                syncmers.likeness(a, e),
                syncmers.likeness(a, n),
            )
        )
    return sorted(map(str, out))


@pytest.mark.parametrize("ranges", [1, 2, 1 << 15])
def test_query_is_brute_force(spark, tmp_path, monkeypatch, ranges):
    monkeypatch.setattr(syncmers, "RANGES", ranges)
    rng = random.Random(7)
    rows = [(i * 37 % 101, "".join(rng.choice("abc dé😀\n") for _ in range(rng.randint(0, 300)))) for i in range(101)]
    rows += [(5, None), (5, ""), (None, "no id"), (None, "no id either"), (200, "x " * 100_000)] + [(50, "hot row")] * 60
    table = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, bucket string")
    table.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_syncmers(spark, str(tmp_path))
    # Ties of an id follow the hashes of their texts.
    hashed = spark.createDataFrame([(i, d, t or "") for i, (d, t) in enumerate(rows)], "i int, d long, t string")
    order = hashed.selectExpr("d", "t", "xxhash64(t)", "xxhash64(1, t)").collect()
    assert sorted(str(tuple(r)) for r in found.collect()) == brute([tuple(r) for r in order])


def test_fingerprints_of_long_texts_have_all_anchors(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "BYTES", 1000)
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefghij ") for _ in range(5000)) for _ in range(4)]
    texts[1] = texts[0][:4000] + texts[1][:1000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(syncmers.compare_with_next(docs).collect())
    own = [set((syncmers.anchors(t)[1] >> np.uint64(32)).tolist()) for t in texts]
    assert min(map(len, own)) > syncmers.KEPT
    assert [len(r.fingerprint) for r in found] == [8 * len(a) for a in own]
    assert [r.near_next for r in found] == [2 * len(own[i] & own[j]) / (len(own[i]) + len(own[j])) for i, j in ((0, 1), (1, 2), (2, 3), (3, 0))]


def test_one_and_no_document(spark):
    one = spark.createDataFrame([(1, "only one")], "doc_id long, text string")
    assert [r.near_next for r in syncmers.compare_with_next(one).collect()] == [1.0]
    empty = syncmers.compare_with_next(one.where("doc_id > 1"))
    assert empty.collect() == [] and empty.columns == syncmers.compare_with_next(one).columns


def test_general_interface(spark):
    docs = spark.createDataFrame([("a", "some words to be found"), ("b", None)], "name string, body string")
    prints = {r.name: r.fingerprint for r in syncmers.fingerprints(docs, "name", "body").collect()}
    assert prints == {"a": syncmers.written(syncmers.sketch("some words to be found")), "b": ""}
    rows = syncmers.positions(docs, "name", "body").collect()
    at, hashes = syncmers.anchors("some words to be found")
    assert [(r.name, r.position, r.anchor) for r in rows] == [("a", a, h) for a, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True)]
