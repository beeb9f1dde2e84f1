"""Alignment of two tokenizers: groups of tokens that end together, and how often their ids meet."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.ship import shared_folder, ship
from textloom.session import durable

#: Fixed values of byte-level vocabularies: how a text is parted, and the bytes that are not their own character.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SPACE = "▁"
#: Texts that a task encodes together.
TEXTS = 128
#: Parts of texts that a task remembers.
REMEMBERED = 500_000
#: Pairs of ids at most that every task gets with their counts; all others are joined.
COMMON = 1 << 19
#: Steps of a histogram of counts for each doubling.
STEPS = 8
_FIRST = np.int64(32)  # an id pair is one long: the first id is in the upper half
#: Not before a last space: the second tokenizer adds one to a text, but not to an empty one.
_BEFORE_SPACES = re.compile(r"(?s)(?<=\S)(?= .)").split
_PROBE = "Two  texts, don't\n\n 12³ part… 日本 😀\t x"


class ByteLevel:
    """Ids and bytes of a byte-level vocabulary of the tokenizers library.

    Its ids are the ranks of its merges, so tiktoken gives the same ids some
    three times as fast; a vocabulary for which they are not is refused.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        hidden = [b for b in range(256) if b not in SHOWN]
        of_char = {chr(b): b for b in SHOWN} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(map(of_char.__getitem__, t)): i for t, i in model["vocab"].items() if set(t) <= of_char.keys()}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        single = sorted(i for t, i in ranks.items() if len(t) == 1)
        special = set(model["vocab"].values()) - {*single, *merged}
        ranks = {t: i for t, i in ranks.items() if i not in special}
        self.bytes = dict(map(reversed, ranks.items()))
        self.coder = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        if merged != sorted(merged) or library.encode(_PROBE, add_special_tokens=False).ids != self.encode([_PROBE])[0]:
            raise ValueError("the ids of this vocabulary are not the ranks of its merges")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return list(map(self.coder.encode_ordinary, texts))


class Pieces:
    """Ids and bytes of a sentencepiece model."""

    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = {
            i: bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(SPACE, " ").encode("utf-8")
            for i in range(lib.get_piece_size())
            for p in [lib.id_to_piece(i)]
        }

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Pair:
    """Two tokenizers with what an alignment needs of each token, behind a memory of parts.

    Both end a token before a space that follows another character, so texts
    are aligned in parts from one such space to the next.
    """

    def __init__(self, first: str, second: str):
        self.a, self.b = ByteLevel(first), Pieces(second)
        tokens = [[side.bytes.get(i, b"") for i in range(max(side.bytes) + 1)] for side in (self.a, self.b)]
        self.sizes = [list(map(len, t)) for t in tokens]
        self.names = [list(map(str, range(len(t)))) for t in tokens]
        self.remembered: dict[str, tuple] = {}
        self.part = _BEFORE_SPACES if self._parts_before_spaces() else lambda text: [text]

    def aligned(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray]]:
        """Tokens of either side, groups, the groups as written and the links of each text."""
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        parts = [self.part(" " + t) if t else [] for t in texts]
        new = list(set(chain.from_iterable(parts)).difference(self.remembered))
        for part, a, b in zip(new, self.a.encode(new), self.b.encode([p[1:] for p in new]), strict=True):
            whole = part.encode("utf-8")
            same = all(b"".join(map(s.bytes.__getitem__, ids)) == whole for s, ids in ((self.a, a), (self.b, b)))
            groups, links = self.align(a, b) if same else ([], [])
            self.remembered[part] = same, len(a), len(b), len(groups), ";".join(groups), array("q", links).tobytes()
        out = []
        for some in parts:
            same, n_a, n_b, n_groups, groups, links = zip(*map(self.remembered.__getitem__, some)) if some else [(False,)] * 6
            if all(same):
                out.append((sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), np.frombuffer(b"".join(links), np.int64)))
            else:
                out.append((0, 0, 0, "", np.empty(0, np.int64)))
        return out

    def _parts_before_spaces(self) -> bool:
        """Whether no piece goes on from another character to a space, and a probe has the same ids in parts.

        The first tokenizer's pattern has no match that does.
        """
        over = any(" " in t.lstrip(b" ").decode("utf-8", "replace") for t in self.b.bytes.values())
        whole = self.b.encode([_PROBE])[0]
        return not over and whole == list(chain.from_iterable(self.b.encode([p[1:] for p in _BEFORE_SPACES(" " + _PROBE)])))

    def align(self, a: list[int], b: list[int]) -> tuple[list[str], list[int]]:
        """Groups, as written, and links of two id lists over the same bytes.

        An end of a token leads to the number of tokens up to it. Ends that both
        lists have, in order, cut them into groups. Within one, two tokens link
        when their bytes overlap: all of them if either side is a single token.
        A link is one long, ids repeated as often as they meet.
        """
        at_a, at_b = (dict(zip(accumulate([s[x] for x in ids]), count(1))) for s, ids in zip(self.sizes, (a, b), strict=True))
        names_a, names_b = self.names
        groups, links = [], []
        i = j = 0
        for end in sorted(at_a.keys() & at_b.keys()):
            to_i, to_j = at_a[end], at_b[end]
            if to_i - i == 1 and to_j - j == 1:
                groups.append(f"{a[i]}|{b[j]}")
                links.append(a[i] << 32 | b[j])
            else:
                left, right = ",".join([names_a[x] for x in a[i:to_i]]), ",".join([names_b[y] for y in b[j:to_j]])
                groups.append(f"{left}|{right}")
                if to_i - i == 1:
                    links.extend([a[i] << 32 | y for y in b[j:to_j]])
                elif to_j - j == 1:
                    links.extend([x << 32 | b[j] for x in a[i:to_i]])
                else:
                    links.extend(self._overlaps(a[i:to_i], b[j:to_j]))
            i, j = to_i, to_j
        return groups, links

    def _overlaps(self, a: list[int], b: list[int]) -> Iterator[int]:
        """Links of one group: whichever token ends first makes way for the next of its side."""
        ends_a, ends_b = (list(accumulate([s[x] for x in ids])) for s, ids in zip(self.sizes, (a, b), strict=True))
        i = j = 0
        while i < len(a) and j < len(b):
            yield a[i] << 32 | b[j]
            if ends_a[i] <= ends_b[j]:
                i += 1
            else:
                j += 1


@lru_cache(2)
def pair(first: str, second: str) -> Pair:
    return Pair(first, second)


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: how the tokens of two tokenizers align, and how common their links are.

    ``first`` is a byte-level vocabulary of the tokenizers library and encodes a
    space and the text, ``second`` a sentencepiece model that adds the space
    itself; both are paths on every worker. Columns: ``id_col``, the longs
    ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose
    count is the highest of their first id), ``count_sum`` (counts over links)
    and ``groups_sha256``. The count of a pair of ids is the number of rows of
    ``docs`` that hold it linked.

    A null or empty text, and one that the ids don't give back, has no tokens:
    zeros and an empty string. Null and repeated ids and rows keep their row;
    other columns are not looked at. No rows: no rows.

    Texts are encoded once; each row's distinct links are written to the shared
    folder. Counts are combined before their shuffle. The ``COMMON`` most common
    pairs go to every task, which sums their counts in place, so no hot pair is
    ever joined; the links of all other pairs meet their counts in a join.
    """
    spark = docs.sparkSession
    stored = spark.read.parquet(_store(docs, first, second, id_col, text_col))
    counted = _counted(stored)
    common, level = _common(counted)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(lambda batch: _add(batch, *common), batches)

    kept = [c for c in stored.columns if c not in ("keys", "times")]
    types = ", ".join(f"{c} {stored.schema[c].dataType.simpleString()}" for c in kept)
    summed = durable(
        stored.select("keys", "times", *kept).mapInArrow(
            add, f"{types}, best long, total long, keys array<long>, times array<int>"
        )
    )
    # explode() of the zipped arrays drops the rows without any, which have nothing to join.
    rare = summed.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("row", "x.keys", "x.times")
    rare = rare.withColumnRenamed("keys", "key").join(counted.where(F.col("level") < level).drop("level"), "key")
    more = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("more_total"),
        F.sum(F.when(F.col("is_best"), F.col("times").cast("long")).otherwise(0)).alias("more_best"),
    )

    def plus(a: str, b: str) -> F.Column:
        return F.col(a) + F.coalesce(F.col(b), F.lit(0).cast("long"))

    return summed.join(more, "row", "left").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        plus("best", "more_best").alias("n_best"),
        plus("total", "more_total").alias("count_sum"),
        "groups_sha256",
    )


def _store(docs: DataFrame, first: str, second: str, id_col: str, text_col: str) -> str:
    """Write a row for each of ``docs``: its figures and its distinct links with their numbers."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(first, second)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                columns = _encoded(both, [t or "" for t in part.column(1).to_pylist()])
                rows = pa.array(np.arange(row, row + part.num_rows))
                row += part.num_rows
                yield pa.RecordBatch.from_arrays([rows, part.column(0), *columns], ["row", "id", *_FIGURES])

    path = shared_folder(spark, "links")
    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<int>"
    docs.select(id_col, text_col).mapInArrow(of, schema).write.parquet(path)
    return path


_FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times"]


def _encoded(both: Pair, texts: list[str]) -> list[pa.Array]:
    figures, shas, keys, times = [], [], [], []
    for n_a, n_b, n_groups, groups, links in both.aligned(texts):
        own, often = np.unique(links, return_counts=True)
        figures.append((n_a, n_b, n_groups, len(links)))
        shas.append(hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
        keys.append(own), times.append(often.astype(np.int32))
    ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (keys, times)]
    return [*(pa.array(c, pa.int64()) for c in zip(*figures, strict=True)), pa.array(shas, pa.string()), *lists]


def _counted(stored: DataFrame) -> DataFrame:
    """``key, n, is_best, level`` of every pair; the best counts are as many as the first tokenizer has ids."""
    counts = durable(stored.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")))
    first = F.shiftright("key", int(_FIRST))
    best = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    level = F.floor(F.log2("n") * STEPS).cast("int").alias("level")
    met = counts.join(F.broadcast(best), first == F.col("first"))
    return durable(met.select("key", "n", (F.col("n") == F.col("most")).alias("is_best"), level))


def _common(counted: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], int]:
    """Keys, counts and marks of all pairs from a level on, at most ``COMMON``, and that level."""
    level, seen = 64 * STEPS, 0
    for row in counted.groupBy("level").agg(F.count("*").alias("pairs")).orderBy(F.desc("level")).collect():
        seen += row["pairs"]
        if seen > COMMON:
            break
        level = row["level"]
    found = counted.where(F.col("level") >= level).orderBy("key").toArrow()
    return tuple(found[c].to_numpy() for c in ("key", "n", "is_best")), level


def _add(batch: pa.RecordBatch, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """Sums over the common links of each row; the other links are handed on."""
    ends = batch.column(0).offsets.to_numpy()
    own, often = (batch.column(c).flatten().to_numpy() for c in (0, 1))
    lengths = np.diff(ends)
    row = np.repeat(np.arange(batch.num_rows), lengths)
    at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
    met = keys[at] == own if len(keys) else np.zeros(len(own), bool)
    sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
    np.add.at(sums[0], row[met], np.where(best[at[met]], often[met], 0))
    np.add.at(sums[1], row[met], counts[at[met]] * often[met])
    left = pa.array(np.r_[0, np.cumsum(np.bincount(row[~met], minlength=batch.num_rows))], pa.int32())
    rest = [pa.ListArray.from_arrays(left, pa.array(x[~met])) for x in (own, often)]
    return pa.RecordBatch.from_arrays([*batch.columns[2:], *map(pa.array, sums), *rest], [*batch.schema.names[2:], "best", "total", "keys", "times"])
