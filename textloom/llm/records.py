"""Token ids as length-delimited binary records with an offset index."""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.crc32c import masked_all
from textloom.llm.ship import ship

#: Texts that a task encodes together, and chunks and words that it remembers.
TEXTS = 256
CHUNKS = 400_000
WORDS = 800_000
#: Words that the library gets as one text.
LINE = 512
#: Bytes after which a task begins another file.
FILE_BYTES = 32 << 20
#: Documents of a range, which one task writes.
RANGE_DOCS = 5_000
#: A record's own head: format version, bytes of an id, number of ids.
HEAD = struct.Struct("<HHI")
_ORDINARY = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%$#&*|]*)")


class Tokenizer:
    """The tokenizers library behind a memory of chunks between white space.

    The library parts texts at white space and normalizes each part by itself,
    so the ids of a text are those of its chunks in a row.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.remembered: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.apart = self._parts_at_white_space()
        size = self.library.get_vocab_size()
        self.ends = np.array([(self.library.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def _parts_at_white_space(self) -> bool:
        """Whether a probe text gives the same ids whole and in chunks."""
        probe = "A b's, ''d 12 x́̀ ́y z İ ΣαΣ <|x|> - .\n\tq"
        return self._ids([probe])[0] == b"".join(self._ids(probe.split()))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        if not self.apart:
            return self._ids(texts)
        for memory, most in ((self.remembered, CHUNKS), (self.words, WORDS)):
            if len(memory) > most:
                memory.clear()
        parts = [t.encode("utf-8").split() for t in texts]
        new = list(set(chain.from_iterable(parts)).difference(self.remembered))
        odd, plain = [], []
        for chunk in new:
            # Letters and the marks after them are a word each to the library too, in lower case.
            found = _ORDINARY.fullmatch(text := chunk.decode("utf-8"))
            if found:
                plain.append((chunk, found[1].lower(), found[2]))
            else:
                odd.append((chunk, text))
        wanted = set(chain.from_iterable((w, m) for _, w, m in plain)).difference(self.words)
        self._learn_words([w for w in wanted if w])
        for chunk, word, mark in plain:
            self.remembered[chunk] = self.words[word] + self.words[mark] if mark else self.words[word]
        self._learn(self.remembered, [c for c, _ in odd], [t for _, t in odd])
        return [b"".join(map(self.remembered.__getitem__, p)) for p in parts]

    def _learn_words(self, words: list[str]) -> None:
        """Encode lines of words and part the ids after each end of a word; word by word where the ends don't tally."""
        for at in range(0, len(words), LINE):
            line = words[at : at + LINE]
            coded = self._ids([" ".join(line)])[0]
            ends = np.flatnonzero(self.ends[np.frombuffer(coded, "<u4")]) + 1
            if len(ends) == len(line):
                stops = [0, *(4 * ends).tolist()]
                self.words.update(zip(line, map(coded.__getitem__, map(slice, stops[:-1], stops[1:])), strict=True))
            else:
                self._learn(self.words, line, line)

    def _learn(self, memory: dict, keys: list, texts: list[str]) -> None:
        for at in range(0, len(keys), 1 << 14):
            memory.update(zip(keys[at : at + (1 << 14)], self._ids(texts[at : at + (1 << 14)]), strict=True))


@lru_cache(2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each with its length, the masked checksum of that, the payload and its masked checksum."""
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    sums = masked_all(lengths + payloads)
    heads, tails = sums[: len(payloads)], sums[len(payloads) :]
    return [
        b"".join((n, struct.pack("<I", h), p, struct.pack("<I", t)))
        for n, h, p, t in zip(lengths, heads, payloads, tails, strict=True)
    ]


def payloads(records: list[bytes]) -> list[bytes]:
    """What whole records hold; a wrong length or checksum is an error."""
    found = [r[12:-4] for r in records]
    sums = masked_all([r[:8] for r in records] + found)
    for r, p, head, tail in zip(records, found, sums[: len(found)], sums[len(found) :], strict=True):
        if struct.unpack_from("<QI", r) != (len(p), head) or struct.unpack("<I", r[-4:])[0] != tail:
            raise ValueError("a record is damaged")
    return found


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids with two bytes each where all fit, else four."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return HEAD.pack(1, width, len(ids)) + ids.astype(f"<u{width}").tobytes()


def unpack_ids(payload: bytes) -> np.ndarray:
    _, width, n = HEAD.unpack_from(payload)
    return np.frombuffer(payload, f"<u{width}", n, HEAD.size).astype("<u4")


def write_records(
    docs: DataFrame, folder: str, model: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode texts and write them to record files in ``folder``, by ascending id; returns the offset index.

    ``folder`` is a URI that every executor can write to. Each range of ids is
    one task; it encodes after the shuffle, so that the text is shuffled once
    and the ids never. Files have a name of their own for every attempt, and
    only the index, which Spark commits once, says which files count: what a
    lost attempt leaves behind is never read.

    The index, also stored as Parquet under ``folder``, has one row per
    document: ``id, file, offset, length, start, n_tokens``; ``start`` counts the
    ids of all documents before it. Equal ids follow the hash of their text.
    A null id comes first; a null text is an empty one and has the end id only.
    Other columns are not looked at. No rows: an empty index.
    """
    spark = docs.sparkSession
    ship(spark)
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ranges = max(spark.sparkContext.defaultParallelism, -(-docs.select(id_col).count() // RANGE_DOCS))
    ranged = chosen.withColumn("tie", tie).repartitionByRange(ranges, "id", "tie").sortWithinPartitions("id", "tie", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    files = f"{folder.rstrip('/')}/records"
    schema = f"id {kind}, tie long, file string, range int, row long, offset long, length long, n_tokens long"
    written = ranged.withColumn("range", F.spark_partition_id()).mapInArrow(_writer(files, model, end_id), schema)
    written.write.parquet(f"{folder.rstrip('/')}/offsets")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index, with the ids before each document."""
    rows = spark.read.parquet(f"{folder.rstrip('/')}/offsets")
    # Ranges are few; rows of a range are numbered by the task that wrote them.
    totals = rows.groupBy("range").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("range", F.coalesce(before, F.lit(0)).alias("base"))
    earlier = Window.partitionBy("range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    return own.join(offsets, "range").select(
        "id", "file", "offset", "length", (F.col("base") + F.col("within")).alias("start"), "n_tokens"
    )


def _writer(files: str, model: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = tokenizer(model), np.array([end_id], "<u4").tobytes()
        store, root = fs.FileSystem.from_uri(files)
        store.create_dir(root, recursive=True)
        out, name, number, offset, row = None, "", -1, 0, 0
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    part = batch.slice(at, TEXTS)
                    coded = coder.encode(part.column(1).to_pylist())
                    spot = part.column(3)[0].as_py()
                    place = []
                    ids = [np.frombuffer(one + end, "<u4") for one in coded]
                    for own, data in zip(ids, frames([pack_ids(x) for x in ids]), strict=True):
                        if out is None or offset >= FILE_BYTES:
                            if out is not None:
                                out.close()
                            number, offset = number + 1, 0
                            name = f"part-{spot:06d}-{number:05d}-{uuid.uuid4().hex}.records"
                            out = store.open_output_stream(f"{root}/{name}")
                        out.write(data)
                        place.append((name, row, offset, len(data), len(own)))
                        offset, row = offset + len(data), row + 1
                    names, rows, offsets, lengths, counts = zip(*place, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            part.column(2),
                            pa.array(names, pa.string()),
                            part.column(3),
                            *(pa.array(x, pa.int64()) for x in (rows, offsets, lengths, counts)),
                        ],
                        ["id", "tie", "file", "range", "row", "offset", "length", "n_tokens"],
                    )
        finally:
            if out is not None:
                out.close()

    return write


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of an index name: ``id, start, n_tokens long, ids binary``.

    ``ids`` are little-endian 32-bit integers, ``n_tokens`` how many the record
    holds. Rows may come in any order; each task goes through its rows and
    verifies lengths and checksums.
    """
    ship(index.sparkSession)
    files = f"{folder.rstrip('/')}/records"
    kind = index.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(files)
        name, source = "", None
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                records = []
                for file, offset, length in zip(*(part.column(c).to_pylist() for c in (2, 3, 4)), strict=True):
                    if file != name:
                        name, source = file, store.open_input_file(f"{root}/{file}")
                    source.seek(offset)
                    records.append(source.read(length))
                ids = [unpack_ids(p) for p in payloads(records)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    ["id", "start", "n_tokens", "ids"],
                )

    chosen = index.select("id", "start", "file", "offset", "length")
    return chosen.mapInArrow(read, f"id {kind}, start long, n_tokens long, ids binary")
