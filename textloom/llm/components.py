"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import durable


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """One row ``node, root`` per node of a link; ``root`` is the smallest node reachable.

    Each round hooks the larger neighbours of a node to its smallest neighbour
    (large star), then the smaller ones (small star), until the table of links
    stays the same. Minima are combined before they are shuffled and the links
    meet them in a join that adaptive execution can split, so a node with many
    links is no bottleneck. Every round is checkpointed. Repeated links, links
    in either direction and links of a node to itself are allowed; links with a
    null end are ignored. No links: no rows.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    edges = durable(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        edges = durable(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select("root", "root").distinct())


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links of each node's larger neighbours to its smallest neighbour or itself."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links of each node and its smaller neighbours to the smallest of them; ``u > v`` holds."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hooked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(least.select("u", F.col("m").alias("v"))).distinct()


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable position of each of ``n`` nodes under the links ``a[i]``–``b[i]``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new
