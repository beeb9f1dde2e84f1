"""Exact nearest binary codes by incremental multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.ship import ship

#: Codes of a block and queries of a block, on average; a task has one of each.
CODES = 32_768
QUERIES = 512
MAX_SEGMENT = 16


def sign_code(vector: Column) -> Column:
    """The code of a vector: ``1`` where a component is above zero, else ``0``; null if it has a null or NaN."""
    clean = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
    digits = F.array_join(F.transform(vector, lambda x: F.when(x > 0, "1").otherwise("0")), "")
    return F.when(clean, digits)


class SegmentIndex:
    """Codes by the value of each of their segments; segments are about as long as the number of codes asks for."""

    def __init__(self, bits: np.ndarray):
        n, size = bits.shape
        self.bits = size
        parts = max(1, -(-size // max(1, min(MAX_SEGMENT, int(np.log2(max(n, 2)))))))
        self.groups = np.array_split(np.arange(size), parts)
        self.words = _words(bits)
        self.order, self.offsets = [], []
        for g in self.groups:
            values = bits[:, g].astype(np.int64) @ (np.int64(1) << np.arange(len(g)))
            self.order.append(np.argsort(values, kind="stable"))
            self.offsets.append(np.concatenate(([0], np.cumsum(np.bincount(values, minlength=1 << len(g))))))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def at(self, segment: int, value: int, radius: int) -> np.ndarray:
        """Codes whose segment differs from the value in exactly so many bits."""
        width = len(self.groups[segment])
        if (width, radius) not in self.masks:
            ones = [1 << i for i in range(width)]
            self.masks[width, radius] = np.array([sum(c) for c in combinations(ones, radius)], np.int64)
        values = self.masks[width, radius] ^ value
        low, high = self.offsets[segment][values], self.offsets[segment][values + 1]
        sizes = high - low
        run = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        return self.order[segment][run]

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes and distances: the ``k`` nearest, and all that are as near as the last of them.

        Radii grow segment by segment. After segment ``s`` of radius ``r``, a
        code not met yet differs in more than ``r`` bits of the segments up to
        ``s`` and in ``r`` or more of the others; so all codes within
        ``r * segments + s`` bits were met, and the search ends when ``k`` were.
        """
        n, parts = len(self.words), len(self.groups)
        values = [int(query[g].astype(np.int64) @ (np.int64(1) << np.arange(len(g)))) for g in self.groups]
        word = _words(query[None])[0]
        met = np.zeros(n, bool)
        counts = np.zeros(self.bits + 1, np.int64)
        rows, distances, seen = [], [], 0
        for radius in range(max(map(len, self.groups)) + 1):
            for s in range(parts):
                if radius <= len(self.groups[s]):
                    new = self.at(s, values[s], radius)
                    new = new[~met[new]]
                    met[new] = True
                    d = np.bitwise_count(self.words[new] ^ word).sum(1, dtype=np.int64)
                    counts += np.bincount(d, minlength=self.bits + 1)
                    rows.append(new)
                    distances.append(d)
                    seen += len(new)
                covered = radius * parts + s
                if seen == n or counts[: covered + 1].sum() >= k:
                    return self._best(np.concatenate(rows), np.concatenate(distances), counts, k)
        return self._best(np.concatenate(rows), np.concatenate(distances), counts, k)

    @staticmethod
    def _best(rows: np.ndarray, d: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        last = int(np.searchsorted(np.cumsum(counts), min(k, len(rows))))
        near = d <= last
        return rows[near], d[near]


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, axis=1)
    padded = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def top_k(codes: DataFrame, queries: DataFrame, k: int, id_col: str = "id", code_col: str = "code") -> DataFrame:
    """``query_id, rank int, id, distance int``: the ``k`` nearest codes of each query, exactly.

    Codes are strings of ``0`` and ``1``. Distances are numbers of different
    bits; of equals the smaller id comes first, null last. Every block of codes
    meets every block of queries in one task, which holds a bounded number of
    each and returns its nearest; the nearest of those are the result.

    Codes and queries that are null or empty, and codes of another length than
    the query's, are never found. Repeated codes each have their rank; equal
    queries with equal ids are asked once. Fewer codes than ``k``: all of them.
    Other columns are not looked at.
    """
    spark = codes.sparkSession
    ship(spark)
    kind = codes.schema[id_col].dataType.simpleString()
    known = codes.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where("length(code) > 0")
    asked = queries.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where("length(code) > 0").distinct()
    n_codes = max(1, -(-known.count() // CODES))
    n_queries = max(1, -(-asked.count() // QUERIES))
    mixed = F.xxhash64("id", "code")
    columns = ("size", "code_block", "query_block", "asks", "id", "code")
    sized = F.length("code").alias("size")
    left = known.select(
        sized,
        F.pmod(mixed, F.lit(n_codes)).cast("int").alias("code_block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("query_block"),
        F.lit(False).alias("asks"),
        "id",
        "code",
    )
    right = asked.select(
        sized,
        F.explode(F.sequence(F.lit(0), F.lit(n_codes - 1))).alias("code_block"),
        F.pmod(mixed, F.lit(n_queries)).cast("int").alias("query_block"),
        F.lit(True).alias("asks"),
        "id",
        "code",
    )

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        text = table.column("code").to_pylist()
        bits = (np.frombuffer("".join(text).encode(), np.uint8) - ord("0")).reshape(len(text), -1)
        ids = table.column("id").combine_chunks()
        mine, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
        who, which, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(mine) and len(rows):
            index = SegmentIndex(bits[rows])
            names = ids.take(pa.array(rows))
            rank = np.empty(len(rows), np.int64)  # places in the order of ids, for ties
            rank[pa.compute.sort_indices(names, null_placement="at_end").to_numpy()] = np.arange(len(rows))
            for q in mine.tolist():
                found, d = index.nearest(bits[q], k)
                best = np.lexsort((rank[found], d))[:k]
                who.append(np.full(len(best), q))
                which.append(rows[found[best]])
                far.append(d[best])
        who, which, far = (np.concatenate(x) for x in (who, which, far))
        return pa.table(
            {
                "query_id": ids.take(pa.array(who)),
                "query_code": table.column("code").combine_chunks().take(pa.array(who)),
                "id": ids.take(pa.array(which)),
                "distance": pa.array(far, pa.int32()),
            }
        )

    schema = f"query_id {kind}, query_code string, id {kind}, distance int"
    near = left.select(*columns).union(right.select(*columns))
    near = near.groupBy("size", "code_block", "query_block").applyInArrow(search, schema)
    order = Window.partitionBy("query_id", "query_code").orderBy("distance", F.col("id").asc_nulls_last())
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "distance")
