"""Document fingerprints of closed syncmers, and documents in the order of their ids."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.ship import ship
from textloom.session import durable

#: Code points of an anchor and of its inner substrings: one in ``(K - S + 1) / 2`` positions has an anchor.
K, S = 12, 5
#: Marks before a text, so that anchors also cover the beginning of one and a short one has some.
MARKS = np.arange(0x110000, 0x110008, dtype=np.uint64)
#: Smallest anchors that a sketch keeps.
KEPT = 128
#: Positions looked at at once, so a long text takes no more memory than a short one.
WINDOW = 1 << 16
#: Rows and bytes of them that are handed over at once, and ranges of ids at most.
ROWS = 256
BYTES = 1 << 24
RANGES = 1 << 15
_FACTOR = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(WINDOW + K, _FACTOR, np.uint64)])
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(WINDOW + K, pow(_FACTOR, -1, 1 << 64), np.uint64)])


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:])
        size += step
    return values


def anchors(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers of a text, in its order.

    A substring of ``K`` code points is one if the smallest hash of its
    substrings of ``S`` is that of its first or its last. That depends on
    nothing but the substring, so an edit changes only the anchors that touch
    it. The text counts with ``MARKS`` before it, which have the positions below
    zero. A text of fewer than ``K - len(MARKS)`` code points is one anchor, the
    empty or null text has none; a text without closed syncmers, which only one
    of a few code points can be, has its substring of the smallest hash.
    """
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    points = np.r_[MARKS, points] + np.uint64(1)
    n, k = len(points), min(K, len(points))
    at, hashes, smallest = [], [], None
    for start in range(0, n - k + 1, WINDOW):
        part = points[start : start + WINDOW + k - 1]
        sums = np.r_[np.uint64(0), np.cumsum(part * _POWERS[: len(part)])]
        own = _spread((sums[k:] - sums[:-k]) * _INVERSE[: len(sums) - k])
        if n < K:
            return np.full(1, -len(MARKS)), own
        inner = _spread((sums[S:] - sums[:-S]) * _INVERSE[: len(sums) - S])
        least = _least(inner, K - S + 1)
        closed = np.flatnonzero((inner[: len(least)] == least) | (inner[K - S :] == least))
        at.append(closed + start - len(MARKS))
        hashes.append(own[closed])
        low = int(own.argmin())
        smallest = min(smallest or (own[low], start + low), (own[low], start + low))
    if not any(map(len, at)):
        return np.array([smallest[1] - len(MARKS)]), np.array([smallest[0]])
    return np.concatenate(at), np.concatenate(hashes)


def fingerprint(text: str | None) -> np.ndarray:
    """All distinct anchors of a text, as 32 bits each, in ascending order."""
    return np.unique((anchors(text)[1] >> np.uint64(32)).astype(np.uint32))


def sketch(text: str | None) -> np.ndarray:
    """The ``KEPT`` smallest anchors of a fingerprint; all of them if there are fewer."""
    return fingerprint(text)[:KEPT]


def likeness(a: np.ndarray, b: np.ndarray, kept: int | None = KEPT) -> float:
    """Twice the common anchors over all anchors of two sketches: exact below ``kept`` anchors, else estimated.

    Half of it for two texts that share one half. Two texts without anchors are
    alike. Of fingerprints, with ``kept`` None, it is exact at any length.
    """
    if not len(a) and not len(b):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    if kept is None:
        return 2 * len(both) / (len(a) + len(b))
    lowest = np.union1d(a, b)[:kept]
    shared = int(np.searchsorted(both, lowest[-1], "right"))
    return 2 * shared / (len(lowest) + shared)


def written(found: np.ndarray) -> str:
    """A fingerprint or sketch as text: eight hex digits for each anchor, in ascending order."""
    return found.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``id_col, fingerprint string`` per row of ``docs``: all anchors; a null text has the empty one."""
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([written(fingerprint(t.as_py())) for t in texts], pa.string())

    return docs.select(F.col(id_col), of(F.col(text_col)).alias("fingerprint"))


def positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row ``id_col, position long, anchor long`` for every anchor of every text, to match texts by place.

    A position counts code points from zero; the ones below it are those of
    ``MARKS``. Null and empty texts have no rows, repeated rows have theirs
    repeatedly.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                at, hashes = anchors(text.as_py())
                ids = batch.column(0).take(pa.array(np.full(len(at), i)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(at), pa.array(hashes.view(np.int64))], ["id", "position", "anchor"])

    found = docs.select(id_col, text_col).mapInArrow(of, f"id {kind}, position long, anchor long")
    return found.withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against an edit of it and against the next document in the order of ids; the last is followed by the first.

    One row per row of ``docs``: ``id_col``, ``n_chars long``, ``edited_sha256``,
    ``fingerprint`` and ``edited_fingerprint`` (strings), ``near_edited`` and
    ``near_next`` (doubles). The edited text has its last half replaced by as
    much of the beginning of the next text. A fingerprint has all anchors of its
    text, so likeness is counted and not estimated.

    Null texts count as empty. Null ids come last, rows of one id follow each
    other by hashes of their texts; rows equal in id and text are next to each
    other. Other columns are not looked at. No rows: no rows.

    Texts are shuffled once, by ranges of ids and hashes, so neither a hot id
    nor a hot row falls to one task: equal rows leave a batch as one with their
    number. The first row of a range is sent to the range before it too.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).isNull().alias("unnamed"),
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.lit(1), text).alias("g"),
        text.alias("text"),
    )
    order = ["unnamed", "id", "h", "g"]
    bounds = _ranges(durable(rows.select(order).distinct()), order)
    if not bounds:
        return spark.createDataFrame([], f"id {kind}, {_FOUND}").withColumnRenamed("id", id_col)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                times.setdefault(key, [i, 0])[1] += 1
            take, bucket, guest, number = [], [], [], []
            for key, (i, n) in times.items():
                to = bisect_right(bounds, key) - 1
                for b, g in ((to, False), ((to - 1) % len(bounds), True)) if key == bounds[to] else ((to, False),):
                    take.append(i), bucket.append(b), guest.append(g), number.append(n)
            taken = batch.take(pa.array(take, pa.int64()))
            more = [pa.array(bucket, pa.int32()), pa.array(guest, pa.bool_()), pa.array(number, pa.int64())]
            yield pa.RecordBatch.from_arrays([*more, *taken.columns], ["bucket", "guest", "n", *taken.schema.names])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _handed_over(_walk(batches), kind_of)

    kind_of = pa.schema([("id", _arrow(docs, id_col)), *_FOUND_ARROW])
    dealt = rows.mapInArrow(deal, f"bucket int, guest boolean, n long, unnamed boolean, id {kind}, h long, g long, text string")
    sorted_ = dealt.repartition(len(bounds), "bucket").sortWithinPartitions("bucket", "guest", *order)
    return sorted_.mapInArrow(walk, f"id {kind}, {_FOUND}").withColumnRenamed("id", id_col)


_FOUND = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FOUND_ARROW = [
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]


def _arrow(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def _ranges(keys: DataFrame, order: list[str]) -> list[tuple]:
    """The first key of each range of ``keys``, ascending: at most ``RANGES``, whatever the number of rows."""
    parts = min(RANGES, 4 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = keys.repartitionByRange(parts, *order).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*order)).alias("first"))
    return sorted(tuple(r["first"]) for r in ranged.collect())


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Results of sorted rows, each with its number of copies; a guest only ends the range."""
    last = None  # bucket, key, text, copies, fingerprint
    for batch in batches:
        columns = [batch.column(c) for c in range(batch.num_columns)]
        for bucket, guest, n, unnamed, id_, h, g, text in zip(*columns, strict=True):
            at, key, n = bucket.as_py(), (unnamed.as_py(), id_.as_py(), h.as_py(), g.as_py()), n.as_py()
            ends = guest.as_py()
            if last and last[0] == at and last[1] == key and not ends:
                last[3] += n
                continue
            if last is None and ends:
                continue  # the range has ended already
            text = text.as_py()
            own = fingerprint(text)
            if last:
                yield from _results(last, text, own)
            last = None if ends else [at, key, text, n, own]


def _results(row: list, following: str, its: np.ndarray) -> Iterator[tuple]:
    _, key, text, copies, own = row
    for other, fingerprinted, times in ((text, own, copies - 1), (following, its, 1)):
        if times:
            changed = edited(text, other)
            new = own if changed == text else fingerprint(changed)
            sha = hashlib.sha256(changed.encode("utf-8")).hexdigest()
            found = (key[1], len(text), sha, written(own), written(new), likeness(own, new, None), likeness(own, fingerprinted, None))
            for _ in range(times):
                yield found


def _handed_over(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def some_rows() -> Iterator[tuple]:
        """``ROWS`` rows, fewer of long texts."""
        size = 0
        for row in islice(rows, ROWS):
            yield row
            size += sum(len(x) for x in row if isinstance(x, str))
            if size > BYTES:
                return

    while some := list(some_rows()):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
