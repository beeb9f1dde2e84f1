"""Mixing against a plain water filling and the rules of the mix."""

import random
import re
from collections import Counter

from textloom.llm import mixing, queries


def filled(sizes, share=1.5, repeats=2, weights=(5.0, 2.0, 1.0)):
    """Targets by source: shares of what is left, until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if repeats * sizes[s] <= level * weight[s]]
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = float(repeats * sizes[s])
            rest -= out[s]
        open_ -= set(full)
    return out


def documents(n=300):
    rng = random.Random(9)
    sources = ["b", "a", "é", "Z", "", None, "tiny", "\U0001f600"]
    weights = [40, 10, 5, 5, 3, 3, 0, 2]
    rows = []
    for i in range(n):
        source = rng.choices(sources, weights)[0]
        words = [rng.choice(["one", "two\x0bthree", "é", "x\xa0y"]) for _ in range(rng.randint(0, 120))]
        rows.append((i, " ".join(words), source, "clash"))
    rows += [(n, "one word", "tiny", "c"), (n + 1, None, "a", "c"), (5, rows[5][1], rows[5][2], "again"), (None, "w " * 9, "a", "c")]
    return [*rows, (n + 2, "long " * 30_000, "b", "c")]


def test_targets_and_taken_words(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 16)
    monkeypatch.setattr(mixing, "SLOTS", 64)
    rows = documents()
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, target string").repartition(5)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op8_mixing(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    source = {i: s for i, _, s, _ in rows}
    total = Counter()
    for i, _, s, _ in rows:
        total[s] += size[i]
    targets = filled(total)
    taken = Counter()
    for r in found:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == total[s]
        assert abs(r.target - targets[s]) < 1e-6 * max(1, targets[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 1, s
    again = queries.op8_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_schedule_is_whole_and_spread(spark):
    rows = [(i, "w " * (i % 90), "abc"[i % 3]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    parts, pieces, schedule = mixing.mix(docs, block=16)
    slots = sorted(schedule.collect(), key=lambda r: r.slot)
    assert len({r.slot for r in slots}) == len(slots)
    assert sum(r.words for r in slots) == sum(r.taken for r in parts.collect())
    words = Counter()
    for r in pieces.collect():
        words[r.source_no, r.block] += r.words
    blocks = Counter(s for s, _ in words)
    uses = Counter((r.source_no, r.block) for r in slots)
    for (s, b), n in words.items():
        assert n == 16 or b == blocks[s] - 1
    for s in blocks:  # every block comes once before any comes twice
        assert max(uses[s, b] for b in range(blocks[s])) - min(uses[s, b] for b in range(blocks[s])) <= 1
    total = Counter(r.source_no for r in slots)
    seen = Counter()
    for at, r in enumerate(slots, 1):
        seen[r.source_no] += 1
        for s in total:
            assert abs(seen[s] - at * total[s] / len(slots)) < 6


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert [x.collect() for x in mixing.mix(empty)] == [[], [], []]
    wordless = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    parts, pieces, schedule = mixing.mix(wordless)
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in parts.collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert pieces.collect() == [] and schedule.collect() == []
