"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.ship import ship

SPACE = "▁"
#: Texts that a task encodes together, and chunks that it remembers.
TEXTS = 256
REMEMBERED = 300_000
#: Longer chunks have an agenda of their own; shorter ones are merged side by side.
LONG = 200
_NEVER = np.int64(1) << 40


class Vocabulary:
    """Merges of a model: which two symbols make which piece, and in what order."""

    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        ids = {lib.id_to_piece(i): i for i in plain}
        loose = sorted(set(chain.from_iterable(ids)) - ids.keys())
        symbols = ids | {c: size + i for i, c in enumerate(loose)}
        self.base = size + len(loose)
        self.symbol = np.full(0x110000, -1, np.int64)
        for c, s in symbols.items():
            if len(c) == 1:
                self.symbol[ord(c)] = s
        order = {s: rank for rank, s in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        made = {}
        for piece, i in ids.items():
            for at in range(1, len(piece)):
                if (a := symbols.get(piece[:at])) is not None and (b := symbols.get(piece[at:])) is not None:
                    made[a * self.base + b] = (order[lib.get_score(i)], i)
        self.made = made
        self.keys = np.array(sorted(made) or [-1], np.int64)
        self.ranks, self.results = (
            np.array([made.get(k, (_NEVER, 0))[n] for k in self.keys.tolist()], np.int64) for n in (0, 1)
        )
        self.known = np.zeros(self.base, bool)
        self.known[plain] = True
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = lib.unk_id()
        self.fallback = lib.is_byte(self.bytes[0])
        # Chunks end where no piece goes on: before spaces, at a line feed, around punctuation.
        spans = {f"{a}{b}" for p in ids for a, b in zip(p, p[1:], strict=False) if a != SPACE}
        if any(SPACE in s for s in spans):
            self.chunk = re.compile(r"(?s).+")
        elif any("\n" in p for p in ids):
            self.chunk = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            marks = {c for p in ids for c in p if unicodedata.category(c)[0] not in "LM"} - {SPACE}
            while bad := {c for s in spans if (s[0] in marks) != (s[1] in marks) for c in s} & marks:
                marks -= bad
            marks = re.escape("".join(sorted(marks))) or "\n"
            self.chunk = re.compile(f"{SPACE}*(?:[^{SPACE}\n{marks}]+|[{marks}]+)|{SPACE}+|\n")
        self.remembered: dict[str, bytes] = {}
        self._feed = lib.encode("\n")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each two symbols; a rank of ``_NEVER`` for none."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], _NEVER), self.results[at]

    def ids_of(self, symbol: int, char: str) -> list[int]:
        """Ids of what is left of a chunk: a piece, or the bytes of a character without one."""
        if symbol >= 0 and self.known[symbol]:
            return [symbol]
        return [self.bytes[b] for b in char.encode("utf-8")] if self.fallback else [self.unknown]

    def agenda(self, chunk: str) -> list[int]:
        """Ids of one chunk: the best-scored adjacent pair merges first, of equals the leftmost."""
        symbols = self.symbol[_code_points(chunk)].tolist()
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))

        def pair(i: int) -> tuple | None:
            if i < 0 or after[i] >= n or symbols[i] < 0 or symbols[after[i]] < 0:
                return None
            found = self.made.get(symbols[i] * self.base + symbols[after[i]])
            return found and (found[0], i, symbols[i], symbols[after[i]], found[1])

        todo = [p for p in map(pair, range(n)) if p]
        heapify(todo)
        gone = [False] * n
        while todo:
            _, i, a, b, made = heappop(todo)
            j = after[i]
            if gone[i] or j >= n or symbols[i] != a or symbols[j] != b:
                continue  # one of the two has merged meanwhile
            symbols[i], gone[j], after[i] = made, True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for p in (pair(before[i]), pair(i)):
                if p:
                    heappush(todo, p)
        return list(chain.from_iterable(self.ids_of(s, c) for s, c, g in zip(symbols, chunk, gone, strict=True) if not g))

    def agendas(self, chunks: list[str]) -> list[bytes]:
        """Ids of many short chunks: in each round, the top of every chunk's agenda merges."""
        text = "".join(chunks)
        symbols = self.symbol[_code_points(text)]
        chunk = np.repeat(np.arange(len(chunks)), np.fromiter(map(len, chunks), np.int64, len(chunks)))
        first = np.arange(len(symbols))  # the character that a symbol begins with
        rank, made = np.full(len(symbols), _NEVER), np.zeros(len(symbols), np.int64)
        rank[:-1], made[:-1] = self.look_up(symbols[:-1], symbols[1:])
        rank[:-1][chunk[:-1] != chunk[1:]] = _NEVER
        ended = []
        while len(symbols):
            starts = np.flatnonzero(np.diff(chunk, prepend=-1))
            top = np.minimum.reduceat((rank << 22) + np.arange(len(rank)), starts)
            at = top & ((1 << 22) - 1)
            live = top < (_NEVER << 22)
            keep = np.repeat(live, np.diff(np.append(starts, len(symbols))))
            if not live.all():
                ended.append([x[~keep] for x in (first, symbols, chunk)])
            at = at[live]
            symbols[at] = made[at]
            keep[at + 1] = False
            new = (np.cumsum(keep) - 1)[at]
            symbols, chunk, first, rank, made = (x[keep] for x in (symbols, chunk, first, rank, made))
            for spot in (new, new[new > 0] - 1):
                right = np.minimum(spot + 1, len(symbols) - 1)
                r, m = self.look_up(symbols[spot], symbols[right])
                rank[spot] = np.where((right > spot) & (chunk[right] == chunk[spot]), r, _NEVER)
                made[spot] = m
        first, symbols, chunk = (np.concatenate(x) for x in zip(*ended, strict=True))
        order = np.argsort(first)
        first, symbols, chunk = first[order], symbols[order], chunk[order]
        odd = np.flatnonzero((symbols < 0) | ~self.known[symbols])
        if len(odd):
            ids = [self.ids_of(s, text[f]) for s, f in zip(symbols[odd].tolist(), first[odd].tolist(), strict=True)]
            times = np.ones(len(symbols), np.int64)
            times[odd] = list(map(len, ids))
            at = (np.cumsum(times) - times)[odd]
            symbols, chunk = np.repeat(symbols, times), np.repeat(chunk, times)
            for a, some in zip(at.tolist(), ids, strict=True):
                symbols[a : a + len(some)] = some
        ends = 4 * np.searchsorted(chunk, np.arange(len(chunks) + 1))
        coded = symbols.astype("<i4").tobytes()
        return [coded[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def check(self, chunks: list[str], found: list[bytes]) -> None:
        """The library has to give the same ids; a line feed keeps its own space off."""
        after_feed = self.library.encode(["\n" + c.replace(SPACE, " ") for c in chunks], num_threads=1)
        theirs = [ids[len(self._feed) :] for ids in after_feed]
        if list(map(len, found)) != [4 * len(t) for t in theirs] or b"".join(found) != np.fromiter(chain.from_iterable(theirs), "<i4").tobytes():
            raise ValueError("the sentencepiece library parts these chunks in another way than the merges do")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        parts = [self.chunk.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list(set(chain.from_iterable(parts)).difference(self.remembered))
        short, long = [c for c in new if len(c) <= LONG], [c for c in new if len(c) > LONG]
        for at in range(0, len(short), 1 << 14):
            some = short[at : at + (1 << 14)]
            self._remember(some, self.agendas(some))
        self._remember(long, [np.array(self.agenda(c), "<i4").tobytes() for c in long])
        return [b"".join(map(self.remembered.__getitem__, p)) for p in parts]

    def _remember(self, chunks: list[str], found: list[bytes]) -> None:
        self.check(chunks, found)
        self.remembered.update(zip(chunks, found, strict=True))


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``id_col, ids array<int>, decoded string`` per row of ``docs``.

    ``model`` is the path of a merge-type sentencepiece model on every worker.
    Ids are those of the library's ``encode``, without begin or end ids, and
    ``decoded`` is its ``decode`` of them. A chunk that a task has not met yet
    is merged here by score and compared with the library; a difference, as
    with a model of another type, ends the job.

    A null or empty text has no ids and decodes to the empty text. Null and
    repeated ids and rows keep their row; other columns are not looked at.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                coded = words.encode([t or "" for t in part.column(1).to_pylist()])
                values = np.frombuffer(b"".join(coded), "<i4")
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                decoded = words.library.decode(
                    [values[s:e].tolist() for s, e in zip(ends[:-1], ends[1:], strict=True)], num_threads=1
                )
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    schema = f"id {kind.simpleString()}, ids array<int>, decoded string"
    return docs.select(id_col, text_col).mapInArrow(of, schema).select(F.col("id").alias(id_col), "ids", "decoded")
