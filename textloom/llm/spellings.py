"""Spelling variants: pairs of trie nodes joined across skipped and inserted positions."""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.ship import ship
from textloom.session import durable

#: Fixed values of the query: what a run of letters is, and which runs lose a letter.
RUNS = "[A-Za-z\\u00C0-\\u00FF]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVERY = 199
#: A word has so many code points and occurrences, and a form so many times those of its word.
LENGTH, OCCURRENCES, TIMES = 6, 5, 5
#: Words that are handed over at once.
ROWS = 4096


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``word string, n long`` per distinct word of at least ``LENGTH`` code points and ``OCCURRENCES``.

    Words are runs of letters in lower case. A run whose checksum with the id
    of its document ``EVERY`` divides loses one letter: the table holds known
    misspellings. A null id is written as the empty text, a null text has no
    words. Counts are combined before the shuffle, so a word of a third of all
    occurrences leaves one row a task.
    """
    run = F.translate(F.col("run"), CAPITALS, SMALL)
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        # explode() would add a filter that matches the pattern once more
        F.explode_outer(F.regexp_extract_all(F.col(text_col), F.lit(RUNS), F.lit(0))).alias("run"),
    )
    runs = runs.select(run.alias("run"), F.crc32(F.concat("id", F.lit(":"), run).cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    found = runs.select(F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = found.where(F.length("word") >= LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


def variants(words: DataFrame) -> DataFrame:
    """One row per row of ``words`` (``word string, n long``, words distinct): its near words and its form.

    Two words are near when they differ by one inserted, deleted or replaced
    code point. ``form`` is the near word of the largest ``n``, of equals the
    smallest, if that is at least ``TIMES`` the word's own, else null; ``root``
    is the last of the forms from the word on, or the word. ``n_near`` and
    ``form_n`` are longs. Null and empty words are left out; other columns are
    not looked at. No words: no rows.

    Words become paths of node numbers in the trie of the words and in that of
    the reversed words. Leaving out the letter at a position gives a pair of
    nodes: the one before it and the one after it. Words of one such pair
    differ in that letter only, so there are at most as many as letters; a word
    that has the pair at a place between two letters is the one with the letter
    inserted. Both are found by one shuffle on the pair, and each word only
    takes the number and the best of the others, so no pairs are made.
    """
    coded = _both_ways(durable(words.where("length(word) > 0").select("word", F.col("n").cast("long").alias("n"))))
    found = durable(_near(coded))
    near = coded.select("node", "word", "n").join(found, "node", "left")
    is_form = F.col("best.n") >= TIMES * F.col("n")
    near = durable(
        near.select(
            "node",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, -F.col("best.minus")).alias("up"),
            F.when(is_form, F.col("best.n")).alias("form_n"),
        )
    )
    names = coded.select("node", "word")
    roots = _roots(near)
    out = near.join(names.select(F.col("node").alias("up"), F.col("word").alias("form")), "up", "left")
    out = out.join(roots, "node", "left")
    out = out.join(names.select(F.col("node").alias("root_node"), F.col("word").alias("root_word")), "root_node", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def _near(coded: DataFrame) -> DataFrame:
    """``node, n_near, best`` of the words with near ones; ``best`` has the count and the number, negative."""
    here, size = F.col("i"), F.length("word")
    left_out = F.element_at("before", here + 1), F.element_at("after", size - here)
    between = F.element_at("before", here + 1), F.element_at("after", size - here + 1)
    letter = F.substring(F.col("word"), here + 1, F.lit(1))
    # Of equal letters in a row, leaving out any gives the same word: only the first counts.
    first = (here == 0) | (letter != F.substring(F.col("word"), here, F.lit(1)))

    def rows(last: Column, pair: tuple[Column, Column], kind: Column) -> DataFrame:
        every = coded.withColumn("i", F.explode(F.sequence(F.lit(0), last)))
        value = F.struct(F.col("n"), (-F.col("node")).alias("minus"))
        return every.select(pair[0].alias("a"), pair[1].alias("b"), "node", value.alias("value"), kind.alias("kind"))

    skips = rows(size - 1, left_out, F.when(first, F.lit(2)).otherwise(F.lit(1)))
    every = skips.union(rows(size, between, F.lit(0)))
    pair = Window.partitionBy("a", "b")

    def best(of: Column) -> Column:
        return F.max(F.when(of, F.col("value"))).over(pair)

    skip, whole = F.col("kind") > 0, F.col("kind") == 0
    seen = every.select(
        "*",
        F.count("*").over(pair).alias("rows"),
        F.count(F.when(skip, 1)).over(pair).alias("skips"),
        F.count(F.when(F.col("kind") == 2, 1)).over(pair).alias("firsts"),
        best(skip).alias("top"),
        best(F.col("kind") == 2).alias("top_first"),
        best(whole).alias("whole"),
    ).where("rows > 1")
    seen = seen.withColumn("second", best(skip & (F.col("value") < F.col("top"))))
    other = F.when(F.col("value") == F.col("top"), F.col("second")).otherwise(F.col("top"))
    inserted = F.when(F.col("kind") == 2, F.col("whole"))
    seen = seen.select(
        "node",
        F.when(whole, F.col("firsts"))
        .otherwise(F.col("skips") - 1 + F.when(inserted.isNotNull(), F.lit(1)).otherwise(F.lit(0)))
        .alias("near"),
        F.when(whole, F.col("top_first")).otherwise(F.greatest(other, inserted)).alias("best"),
    )
    return seen.groupBy("node").agg(F.sum("near").alias("n_near"), F.max("best").alias("best")).where("n_near > 0")


def _roots(near: DataFrame) -> DataFrame:
    """``node, root_node`` of the words with a form: each round doubles the steps taken, so they are few."""
    ups = durable(near.where("up IS NOT NULL").select("node", "up"))
    while True:
        then = ups.select(F.col("node").alias("up"), F.col("up").alias("next"))
        further = durable(ups.join(then, "up", "left").select("node", F.coalesce("next", "up").alias("up"), "next"))
        ups = further.select("node", "up")
        if further.where("next IS NOT NULL").isEmpty():
            return ups.withColumnRenamed("up", "root_node")


def _both_ways(words: DataFrame) -> DataFrame:
    """``node, word, n, before, after``: node numbers by length of prefix and of suffix, from zero on.

    ``node`` is the word's own, ascending as the words do in code-point order.
    """
    ship(words.sparkSession)
    forward = _numbered(words.withColumn("path", F.col("word")), "word string, n long")
    forward = forward.withColumnRenamed("nodes", "before").withColumn("node", F.element_at("before", -1))
    back = forward.select("node", "word", "n", "before", F.reverse("word").alias("path"))
    return _numbered(back, "node long, word string, n long, before array<long>").withColumnRenamed("nodes", "after")


def _numbered(rows: DataFrame, schema: str) -> DataFrame:
    """The rows with ``nodes array<long>``: the numbers of the nodes on the way of ``path`` through the trie of all.

    Paths are sorted by ranges. A path shares the nodes of its common beginning
    with the one before it and has new ones from there on, so a range needs
    nothing but the last path of the range before it and the number of nodes up
    to there. Each range is one row for the driver, with its first and last path.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in rows.columns if c != "path"]
    ranged = durable(rows.repartitionByRange(parts, "path").sortWithinPartitions("path"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, path, nodes, made = None, "", [0], 0
        for batch in batches:
            for path, nodes in _paths(batch.column(0).to_pylist(), path, nodes, made):
                first = path if first is None else first
                made = max(made, nodes[-1])
        if first is not None:
            row = [[TaskContext.get().partitionId()], [first], [path], [made], [nodes]]
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], list("abcde"))

    known = ranged.select("path").mapInArrow(ends, "a int, b string, c string, d long, e array<long>").collect()
    starts: dict[int, tuple[str, list[int], int]] = {}
    path, nodes, made = "", [0], 0
    for part, first, last, new, own in sorted(known):
        starts[part] = path, nodes, made
        shared = len(commonprefix([path, first]))
        # Nodes up to the shared ones are the earlier range's, the others come after all before.
        nodes = [nodes[i] if i <= shared else i + made - shared for i in own]
        path, made = last, made + new - shared

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, nodes, made = starts.get(TaskContext.get().partitionId(), ("", [0], 0))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = []
                for path, nodes in _paths(batch.column(0).to_pylist(), path, nodes, made):
                    found.append(np.array(nodes, np.int64))
                    made = max(made, nodes[-1])
                columns = [*batch.columns[1:], pa.array(found, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [*names, "nodes"])

    return durable(ranged.select("path", *names).mapInArrow(number, f"{schema}, nodes array<long>"))


def _paths(paths: list[str], path: str, nodes: list[int], made: int) -> Iterator[tuple[str, list[int]]]:
    """Each path with its nodes, numbered on from ``made`` where the one before it, ``path``, does not have them."""
    for new in paths:
        shared = len(commonprefix([path, new]))
        fresh = len(new) - shared
        path, nodes = new, nodes[: shared + 1] + list(range(made + 1, made + 1 + fresh))
        made += fresh
        yield path, nodes
