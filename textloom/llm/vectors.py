"""Embedding near-dedup by collision counting over sorted projections."""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components, local_roots
from textloom.llm.ship import ship
from textloom.session import durable

PROJECTIONS = 32
SEED = 20_240_229
#: Share of the pairs at the threshold that have to be counted often enough.
RECALL = 0.999
#: Vectors of a block; a task compares two blocks.
BLOCK = 1024


def needed_collisions(cosine: float, projections: int = PROJECTIONS, recall: float = RECALL) -> tuple[float, int]:
    """Half the width of a query's window, and the collisions that a pair at the threshold reaches with ``recall``.

    Unit vectors at the threshold lie ``sqrt(2 - 2 cosine)`` apart, so their
    projections on a Gaussian direction differ by a normal variable with that
    deviation. The window is as wide as the deviation; counts are binomial.
    """
    width = sqrt(max(2 - 2 * cosine, 1e-12))
    p = erf(1 / sqrt(2))
    tail, need = 0.0, projections + 1
    while need > 0 and tail < recall:
        need -= 1
        tail += comb(projections, need) * p**need * (1 - p) ** (projections - need)
    return width, need


def directions(size: int, projections: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(SEED + size).standard_normal((size, projections))


def collisions(left: np.ndarray, right: np.ndarray, width: float) -> np.ndarray:
    """How many projections of each two rows lie in one window, centred at the left row.

    Each projection of the right rows is sorted once; a window is a run of it.
    """
    counts = np.zeros(len(left) * len(right), np.uint8)
    base = np.arange(len(left)) * len(right)
    for i in range(left.shape[1]):
        order = np.argsort(right[:, i])
        line = right[order, i]
        low = np.searchsorted(line, left[:, i] - width, "left")
        high = np.searchsorted(line, left[:, i] + width, "right")
        sizes = high - low
        run = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        counts[np.repeat(base, sizes) + order[run]] += 1
    return counts.reshape(len(left), len(right))


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row ``id_col, n_links long, component_id, kept boolean`` per row of ``vectors``.

    Vectors of one label link when their cosine, in double precision, is
    ``cosine`` or more. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable, itself included, ``kept``
    tells whether that is the row's own.

    Equal vectors of a label are one class, so copies are not compared. Each
    two blocks of a label meet in one task, which counts collisions, verifies
    the pairs that reach the calibrated count, and returns a link to the
    smallest class reachable within the task and a number for each class,
    never all pairs. A large label is many blocks, so no task holds it.

    A null label, a null or zero vector, and one with null or non-finite
    components link with nothing, and vectors of different lengths do not link
    with each other. A null id is never the smallest unless all ids are null;
    it is kept if the component has no other. Repeated ids and rows keep their
    row and count as others. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    ship(spark)
    numbers = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), numbers.alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists("x", lambda x: x != 0)
    rows = rows.withColumn("digest", F.when(F.coalesce(usable, F.lit(False)), F.md5(F.to_json("x").cast("binary"))))
    classes = durable(
        rows.where("digest IS NOT NULL")
        .groupBy("label", "digest")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("x").alias("x"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    found = durable(_links(classes, cosine))
    roots = components(found, "node", "root")
    linked = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = classes.select("label", "digest", "least", "copies", "node").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    every = named.join(least, "root").join(linked, "node", "left")
    links = (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links")
    joined = rows.select("id", "label", "digest").join(
        every.select("label", "digest", links, "component_id"), ["label", "digest"], "left"
    )
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """``node, root, n`` of classes with links: what each two blocks show."""
    sized = classes.withColumn("size", F.size("x"))
    blocks = sized.groupBy("label", "size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = sized.join(blocks, ["label", "size"]).withColumn("own", F.pmod(F.xxhash64("digest"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = placed.select("label", "size", "node", "copies", "x", "own", other.alias("other")).select(
        "label",
        "size",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "node",
        "copies",
        "x",
    )
    width, need = needed_collisions(cosine)

    def compare(table: pa.Table) -> pa.Table:
        node, copies = (table.column(c).to_numpy() for c in ("node", "copies"))
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        # Scaled first, so that squares neither vanish nor overflow.
        x = x / np.abs(x).max(1, keepdims=True)
        unit = x / np.sqrt((x * x).sum(1, keepdims=True))
        seen = unit @ directions(unit.shape[1])
        own, low, high = (table.column(c).to_numpy() for c in ("own", "low", "high"))
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        pairs = []
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            a, b = np.nonzero(collisions(seen[some], seen[right], width) >= need)
            a, b = some[a], right[b]
            once = a < b if low[0] == high[0] else slice(None)
            a, b = a[once], b[once]
            for k in range(0, len(a), 1 << 17):
                i, j = a[k : k + (1 << 17)], b[k : k + (1 << 17)]
                close = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                pairs.append((i[close], j[close]))
        a, b = (np.concatenate([p[s] for p in pairs]) if pairs else np.zeros(0, np.int64) for s in (0, 1))
        n = np.zeros(len(node), np.int64)
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        root = local_roots(len(node), a, b)
        has = np.flatnonzero(n)
        return pa.table({"node": node[has], "root": node[root[has]], "n": n[has]})

    return met.groupBy("label", "size", "low", "high").applyInArrow(compare, "node long, root long, n long")
