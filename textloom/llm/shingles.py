"""Near duplicates by the Jaccard similarity of word shingles: min-wise bands find candidates, whole sets verify them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from textloom.functions.arrays import let
from textloom.llm.components import components
from textloom.llm.ship import shared_folder, ship, tabled

SEED = 42
#: A pair shares a band of ``ROWS`` minima with its similarity to that power: at 0.8, some of 40 bands with 0.9987.
BANDS, ROWS = 40, 8
#: One bit of as many minima each, of which a share of (1 + similarity) / 2 agrees.
BITS = 256
#: Deviations below the expected agreement at which a pair is still compared; beyond it lie 3 pairs in 100,000.
DEVIATIONS = 4
#: Smallest hashes that are kept of a set, all of a smaller one, as ints; what is known of both sets must agree as well.
LEAST = 256
#: Shingles hashed at once, rows handed over at once; pairs with one document that meet in one task.
CHUNK, TEXTS = 1024, 256
SALT = 500
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a text of fewer words is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - k] + 1))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in pairs), np.uint64, len(starts)))


def sketch(found: np.ndarray) -> tuple[list[int], list[int]]:
    """A signed long for each band of minima, and bits of the first minima as longs; none for an empty set."""
    if not len(found):
        return [], []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), CHUNK):
        np.minimum(least, (_FACTORS[:, None] * found[None, at : at + CHUNK]).min(1), out=least)
    values = [xxhash.xxh64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]
    bits = np.packbits((least[:BITS] >> np.uint64(5) & np.uint64(1)).astype(bool), bitorder="little")
    return np.array(values, np.uint64).view(np.int64).tolist(), bits.view(np.int64).tolist()


def smallest(found: np.ndarray) -> list[int]:
    """The beginnings of the smallest hashes of a set, ascending, fewer than ``LEAST`` if these are all."""
    return np.unique(found[: 2 * LEAST] >> np.uint64(33)).astype(np.int32)[:LEAST].tolist()


def _smallest(shingle: int):
    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([smallest(shingles(x.as_py(), shingle)) for x in texts], pa.list_(pa.int32()))

    return of


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``similarity``."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def least_agreement(similarity: float) -> int:
    """Bits that agree in nearly all pairs of the similarity."""
    share = (1 + similarity) / 2
    return int(BITS * share - DEVIATIONS * (BITS * share * (1 - share)) ** 0.5)


def may_be_similar(left: Column, right: Column, similarity: float) -> Column:
    """Whether two sets of ``smallest`` hashes are as like as nearly all pairs of the similarity.

    Below the lower end of the two both sets are known. Sets that are known
    whole are told apart but for hashes that begin alike, others as a sample of
    their union tells.
    """
    whole = F.greatest(F.size(left), F.size(right)) < LEAST
    ends = [F.when(F.size(x) < LEAST, F.lit(2**31 - 1)).otherwise(F.element_at(x, -1)) for x in (left, right)]
    end = F.least(*ends)

    def enough(known: Column) -> Column:
        both = F.size(F.array_intersect(known["a"], known["b"]))
        seen = F.size(known["a"]) + F.size(known["b"]) - both
        spread = DEVIATIONS * F.sqrt(seen * (similarity * (1 - similarity)))
        return both >= similarity * seen - F.when(whole, F.lit(1.0)).otherwise(spread)

    def below(x: Column) -> Column:
        return F.when(whole, x).otherwise(let(end, lambda e: F.filter(x, lambda h: h <= e)))

    return let(F.struct(below(left).alias("a"), below(right).alias("b")), enough)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row ``id_col, component_id`` per row of ``docs``.

    Documents link when the Jaccard similarity of their sets of shingles is at
    least ``similarity``, which is computed from the whole sets; ``component_id``
    is the smallest id reachable by links, itself included. Equal sets are one
    node, its text that of one row. Nodes that share a band are compared with
    the smallest node of it first; then those that are still in another
    component than most of the band are compared with the others of it, so a
    large group takes no square of its size. Only pairs whose sketches agree as
    those of the similarity do are handed on, so documents that share a passage
    make no pairs unless they are about as like as asked for.

    Null and empty texts have the empty set. Null ids are never the smallest
    unless all ids of a component are null; repeated ids and rows keep their row.
    """
    spark = docs.sparkSession
    stored = spark.read.parquet(_store(docs, id_col, text_col, shingle))
    reps = tabled(stored.groupBy("node").agg(F.min("row").alias("rep")), "nodes")
    texts = stored.select("row", "text")
    nodes = stored.select("row", "bits", "bands").join(reps.select(F.col("rep").alias("row")), "row", "left_semi")
    nodes = tabled(nodes, "sketches")
    bits = nodes.select("row", "bits")
    values = nodes.select("row", F.explode_outer("bands").alias("value")).where("value IS NOT NULL")
    shared = values.groupBy("value").agg(F.min("row").alias("b"), F.max("row").alias("last")).where("b < last")
    held = tabled(values.join(shared.select("value", "b"), "value"), "bands")

    def agree(left: str, right: str) -> Column:
        apart = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(BITS // 64)]
        return sum(apart[1:], apart[0]) <= BITS - least_agreement(similarity)

    met = held.where("row <> b").select(F.col("row").alias("a"), "b").distinct()
    met = met.join(bits.withColumnRenamed("row", "a"), "a").join(bits.select(F.col("row").alias("b"), F.col("bits").alias("its")), "b")
    tried = tabled(met.where(agree("bits", "its")).select("a", "b"), "pairs")
    first = _verified(tried, texts, shingle, similarity)
    roots = components(first, "a", "b")
    placed = held.select("value", "row").join(roots.withColumnRenamed("node", "row"), "row", "left")
    placed = tabled(placed.select("value", "row", F.coalesce("root", "row").alias("root")), "placed")
    sizes = placed.groupBy("value", "root").agg(F.count("*").alias("n"))
    most = sizes.groupBy("value").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots"))
    open_ = placed.join(most.where("roots > 1").select("value", "main"), "value")
    # Only for rows that are still open: of all rows, these hashes would take half as much room as the texts.
    asked = tabled(open_.select("row").distinct(), "open")
    known = texts.join(asked, "row", "left_semi").select("row", _smallest(shingle)("text").alias("least"))
    open_ = open_.join(bits, "row").join(tabled(known, "smallest"), "row")
    rest = open_.where("root <> main").select(
        "value", F.col("row").alias("x"), F.col("root").alias("x_root"), F.col("bits").alias("its"), F.col("least").alias("its_least")
    )
    # Of a large group of texts that are nearly as like as asked for, most pairs fail; these must not leave the join.
    may = F.when(agree("its", "bits"), may_be_similar(F.col("its_least"), F.col("least"), similarity))
    apart = rest.join(open_, (rest["value"] == open_["value"]) & (F.col("x_root") != F.col("root")) & may)
    more = apart.select(F.greatest("x", "row").alias("a"), F.least("x", "row").alias("b")).distinct()
    second = _verified(tabled(more.join(tried, ["a", "b"], "left_anti"), "pairs"), texts, shingle, similarity)

    roots = components(first.union(second), "a", "b")
    rooted = reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = rooted.select("node", F.coalesce("root", "rep").alias("root"))
    least = stored.select("node", "id").groupBy("node").agg(F.min("id").alias("least"))
    named = rooted.join(least, "node").groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("node", "component_id")
    return stored.select("node", "id").join(classes, "node").select(F.col("id").alias(id_col), "component_id")


def _store(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> str:
    """Write every row with a number, its node (a hash of the set), its sketches and its text."""
    ship(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                nodes, values, bits = [], [], []
                for text in part.column(1):
                    found = shingles(text.as_py(), shingle)
                    nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
                    for out, some in zip((values, bits), sketch(found), strict=True):
                        out.append(some)
                rows = pa.array(np.arange(row, row + part.num_rows))
                row += part.num_rows
                longs = [pa.array(x, pa.list_(pa.int64())) for x in (values, bits)]
                yield pa.RecordBatch.from_arrays(
                    [rows, *part.columns, pa.array(nodes, pa.binary()), *longs], ["row", "id", "text", "node", "bands", "bits"]
                )

    path = shared_folder(docs.sparkSession, "shingles")
    id_type = docs.select(F.col(id_col)).schema[0].dataType
    schema = StructType().add("row", "long").add("id", id_type).add("text", "string").add("node", "binary")
    schema = schema.add("bands", ArrayType(LongType())).add("bits", ArrayType(LongType()))
    docs.select(F.col(id_col), F.col(text_col)).mapInArrow(of, schema).write.parquet(path)
    return path


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs ``a, b`` of rows whose texts are similar.

    Texts of ``a`` come to that of ``b``, which has a copy for each ``SALT`` of
    them; a task holds one set and looks at one other at a time.
    """
    often = pairs.groupBy("b").agg(F.ceil(F.count("*") / SALT).cast("int").alias("copies"))
    left = pairs.join(often, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int").alias("salt"))
    left = left.join(texts.withColumnRenamed("row", "a"), "a").select("b", "salt", "a", "text")
    right = often.join(texts.withColumnRenamed("row", "b"), "b")
    right = right.select(
        "b", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.lit(None).cast("long").alias("a"), "text"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in batches:
            found = []
            for b, _, a, text in zip(*batch.columns, strict=True):
                own = shingles(text.as_py(), shingle)
                if not a.is_valid:
                    centre = own
                elif similar(own, centre, similarity):
                    found.append((a.as_py(), b.as_py()))
            columns = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.union(right).repartition(parts, "b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))
    return tabled(dealt.mapInArrow(check, "a long, b long"), "similar")
