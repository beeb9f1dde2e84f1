"""SimHash near-dedup by a generalised pigeonhole over grouped bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components
from textloom.llm.ship import ship
from textloom.session import durable

BITS = 64
SEED = 42
#: Bits of a histogram that estimates candidates; a group of bits has several.
HISTOGRAM_BITS = 11
#: A probe is shuffled and sorted (1.7 us measured), a candidate only compared (0.1 us).
PROBE_COST = 15.0
#: Rows that a task hands over at once.
CHUNK = 100_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of a text as a signed long; zero for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - k] + 1))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(line[s:e], SEED) for s, e in pairs), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """One row ``id_col, fingerprint long`` per row of ``docs``; a null text has no words."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py(), shingle) for x in texts], pa.int64())

    return docs.select(F.col(id_col), of(F.col(text_col)).alias("fingerprint"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """One row ``id_col, fingerprint long, component_id`` per row of ``docs``.

    Documents link when their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest id reachable by links, itself included.
    Equal fingerprints are one node, so copies are never expanded into pairs.

    Null and empty texts have the fingerprint zero and link like any other.
    A null id takes part but is never the smallest unless all ids of its
    component are null; repeated ids and rows each keep their row. Other
    columns of ``docs`` are not looked at. No rows: no rows.
    """
    marked = durable(
        fingerprints(docs, id_col, text_col, shingle).select(F.col(id_col).alias("id"), F.col("fingerprint").alias("fp"))
    )
    nodes = durable(marked.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(nodes, distance), "a", "b")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id"
    )


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints ``fp`` that differ in at most ``distance`` bits."""
    n, together = _bit_counts(nodes)
    groups = bit_groups(n, together, group_count(n, distance))
    subs = [g[i : i + HISTOGRAM_BITS] for g in groups for i in range(0, len(g), HISTOGRAM_BITS)]
    near = [_within(h, distance) for h in _histograms(nodes, subs)]
    index = nodes.select("fp").mapInArrow(_indexer(groups), "part int, value long, a long")
    probes = nodes.select("fp").mapInArrow(_prober(n, groups, near, distance), "part int, value long, b long")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return probes.join(index, ["part", "value"]).where((F.col("a") < F.col("b")) & close).select("a", "b")


def group_count(n: int, distance: int) -> int:
    """Groups of bits for ``n`` fingerprints: probes and random candidates of a query cost least."""

    def cost(m: int) -> float:
        width, units = BITS / m, [(distance + 1 + i) // m for i in range(m)]
        probes = sum(comb(round(width), d) for u in units for d in range(u))
        return probes * (PROBE_COST + n / 2**width)

    return min(range(1, distance + 2), key=cost)


def bit_groups(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of bits of like size; a group takes the bits most correlated with those it has."""
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    like = np.abs(together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(like, 0)
    left, groups = list(range(BITS)), []
    for i in range(m):
        size = (BITS + i) // m
        seed = left[int(like[np.ix_(left, left)].sum(1).argmax())]
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            best = left[int(like[np.ix_(left, group)].sum(1).argmax())]
            group.append(best)
            left.remove(best)
        groups.append(group)
    return groups


def thresholds(cost: np.ndarray, distance: int) -> np.ndarray:
    """Cheapest radius per query and group, by dynamic programming.

    ``cost[q, g, u]`` is the cost of radius ``u - 1`` (0: the group is skipped).
    A pair within ``distance`` lies within the radius of some group when the
    ``u`` of a query add up to ``distance + 1``.
    """
    rows, m, _ = cost.shape
    total = distance + 1
    best = np.full((rows, total + 1), np.inf)
    best[:, 0] = 0
    took = np.zeros((m, rows, total + 1), np.int64)
    for g in range(m):
        options = np.full((rows, total + 1, total + 1), np.inf)
        for u in range(total + 1):
            options[:, u:, u] = best[:, : total + 1 - u] + cost[:, g, u, None]
        took[g] = options.argmin(2)
        best = options.min(2)
    out, rest = np.empty((rows, m), np.int64), np.full(rows, total)
    for g in reversed(range(m)):
        u = took[g, np.arange(rows), rest]
        out[:, g] = u - 1
        rest -= u
    return out


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _values(bits: np.ndarray, group: list[int]) -> np.ndarray:
    return bits[:, group].astype(np.int64) @ (np.int64(1) << np.arange(len(group)))


def _longs(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and in how many each two bits are set: 64 by 64 sums, combined by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fp = _longs(batch)
            n += len(fp)
            for at in range(0, len(fp), CHUNK):
                bits = _bits(fp[at : at + CHUNK]).astype(np.float32)
                sums += bits.T @ bits
        cells = np.arange(BITS * BITS + 1)
        yield pa.record_batch([pa.array(cells), pa.array(np.append(sums.ravel(), n).astype(np.int64))], ["cell", "n"])

    cells = nodes.select("fp").mapInArrow(count, "cell long, n long")
    sums = np.zeros(BITS * BITS + 1)
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # 4,097 rows at any size
        sums[row["cell"]] = row["n"]
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def _histograms(nodes: DataFrame, subs: list[list[int]]) -> list[np.ndarray]:
    """Fingerprints by the value of each list of bits: at most 2**11 counts for each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(1 << len(s), np.int64) for s in subs]
        for batch in batches:
            bits = _bits(_longs(batch))
            for total, s in zip(sums, subs, strict=True):
                total += np.bincount(_values(bits, s), minlength=len(total))
        for i, total in enumerate(sums):
            at = np.flatnonzero(total)
            parts = [np.full(len(at), i, np.int32), at, total[at]]
            yield pa.record_batch([pa.array(x) for x in parts], ["sub", "value", "n"])

    found = nodes.select("fp").mapInArrow(count, "sub int, value long, n long")
    out = [np.zeros(1 << len(s)) for s in subs]
    for row in found.groupBy("sub", "value").agg(F.sum("n").alias("n")).collect():
        out[row["sub"]][row["value"]] = row["n"]
    return out


def _masks(width: int, radius: int) -> list[np.ndarray]:
    """For each distance up to ``radius``, the masks of ``width`` bits that have so many ones."""
    ones = [1 << i for i in range(width)]
    return [
        np.array([sum(c) for c in combinations(ones, d)], np.uint64).view(np.int64) for d in range(min(radius, width) + 1)
    ]


def _within(counts: np.ndarray, distance: int) -> np.ndarray:
    """By value and distance, how many fingerprints have a value at that distance."""
    at = np.arange(len(counts))
    out = np.zeros((len(counts), distance + 1))
    for d, masks in enumerate(_masks(len(counts).bit_length() - 1, distance)):
        for mask in masks:
            out[:, d] += counts[at ^ mask]
    return out


def _indexer(groups: list[list[int]]):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = _longs(batch)
            bits = _bits(fp)
            for g, group in enumerate(groups):
                parts = [np.full(len(fp), g, np.int32), _values(bits, group), fp]
                yield pa.record_batch([pa.array(x) for x in parts], ["part", "value", "a"])

    return index


def _prober(n: int, groups: list[list[int]], near: list[np.ndarray], distance: int):
    """Every value within a query's radius of its own, for each group of bits."""
    masks = [_masks(len(g), distance) for g in groups]
    probes = [np.cumsum([0, *map(len, m)]) for m in masks]

    def costs(bits: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bits), len(groups), distance + 2))
        sub = 0
        for g, group in enumerate(groups):
            seen = np.zeros((len(bits), distance + 1))
            seen[:, 0] = n
            for at in range(0, len(group), HISTOGRAM_BITS):
                share = near[sub][_values(bits, group[at : at + HISTOGRAM_BITS])] / max(n, 1)
                seen = sum(
                    np.pad(seen[:, : distance + 1 - d], ((0, 0), (d, 0))) * share[:, d, None] for d in range(distance + 1)
                )
                sub += 1
            for u in range(1, distance + 2):
                out[:, g, u] = PROBE_COST * probes[g][min(u, len(masks[g]))] + seen[:, :u].sum(1)
        return out

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _longs(batch)
            for at in range(0, len(whole), 4096):
                fp = whole[at : at + 4096]
                bits = _bits(fp)
                radius = thresholds(costs(bits), distance)
                for g, group in enumerate(groups):
                    own = _values(bits, group)
                    for d, near_masks in enumerate(masks[g]):
                        rows = np.flatnonzero(radius[:, g] >= d)
                        step = max(1, CHUNK // len(near_masks))
                        for k in range(0, len(rows), step):
                            some = rows[k : k + step]
                            for j in range(0, len(near_masks), CHUNK):
                                few = near_masks[j : j + CHUNK]
                                values = (own[some, None] ^ few).ravel()
                                parts = [np.full(len(values), g, np.int32), values, np.repeat(fp[some], len(few))]
                                yield pa.record_batch([pa.array(x) for x in parts], ["part", "value", "b"])

    return probe
