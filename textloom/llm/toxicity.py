"""Toxicity by compression distance between two trained zstandard dictionaries."""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.ship import ship

#: Labelled rows that a model is fitted on, at most, of each label.
TOXIC_ROWS = 2_000
ORDINARY_ROWS = 6_000
#: Windows of each label that train a dictionary, at most; the longest rows give less than all.
TRAINING_WINDOWS = 250_000
#: A word is written as codes of itself and of its beginnings of so many letters.
BEGINNINGS = (4, 6)
#: Bytes of a code, codes of a window, bytes of the dictionaries.
CODE = 16
WINDOW = 16
ORDINARY_BYTES = 131_072
TOXIC_BYTES = 4_096
#: Codes that are added to a dictionary for those that the trainer's header replaced.
LOST = 32
#: Bytes that a window saves with about one, two and three toxic codes.
STEPS = (6, 18, 30)
#: Parts of the rows, each measured with dictionaries of the others for the calibration.
FOLDS = 4
LEVEL = 6
#: Measures of a text.
MEASURES = 7


_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@lru_cache(1 << 17)
def codes(word: str) -> bytes:
    """The word and its beginnings as hashes of one length, so that any of them saves as much when a dictionary has it."""
    units = [word, *(word[:n] for n in BEGINNINGS if len(word) > n)]
    return b"".join(xxhash.xxh3_128_digest(u.encode("utf-8")) for u in units)


def coded(text: str | None) -> bytes:
    return b"".join(map(codes, words_of(text)))


def windows(coded_text: bytes) -> list[bytes]:
    return [coded_text[i : i + WINDOW * CODE] for i in range(0, len(coded_text), WINDOW * CODE)]


def _number_of_windows(text: str) -> int:
    words = words_of(text)
    return -(-(len(words) + sum(len(w) > n for w in words for n in BEGINNINGS)) // WINDOW)


def _halves(coded_text: bytes) -> np.ndarray:
    return np.frombuffer(coded_text, np.uint64)


def _keys(halves: np.ndarray) -> np.ndarray:
    """A number for each code, given its first and second half."""
    return halves[0] * np.uint64(0x9E3779B97F4A7C15) + halves[1]


@lru_cache(8)
def _known(dictionary: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the codes and the halves of codes that a dictionary has, at any place, in order."""
    places = np.frombuffer(dictionary, np.uint8)
    if len(places) < CODE:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    starts = np.lib.stride_tricks.sliding_window_view(places, CODE // 2)
    halves = np.ascontiguousarray(starts).view(np.uint64).ravel()
    return np.unique(_keys((halves[: -CODE // 2], halves[CODE // 2 :]))), np.unique(halves)


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries and the weights that turn differences in length into a score.

    Both compressors know the dictionary of ordinary text; the toxic one also
    knows the dictionary of toxic text in front of it. What they have in common
    cancels out, and a window that gets shorter holds toxic wording. Windows are
    of hashes of words: of plain text, a match of a short word saves hardly more
    bytes than it costs.
    """

    ordinary: bytes
    toxic: bytes
    centre: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1 for each text, higher: more likely toxic."""
        measured = np.array([measures(gains(t, self.ordinary, self.toxic)) for t in texts]).reshape(len(texts), -1)
        return _logistic(_terms((measured - self.centre) / self.spread) @ np.array(self.weights))


@lru_cache(8)
def _compressors(ordinary: bytes, toxic: bytes) -> tuple:
    out = []
    for content in (ordinary, toxic + ordinary):
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            source_size=WINDOW * CODE,
            dict_size=len(content),
            min_match=4,
            write_content_size=False,
            write_dict_id=False,
        )
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=how)
        out.append(zstandard.ZstdCompressor(dict_data=known, compression_params=how))
    return tuple(out)


def gains(text: str | None, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """By window, the bytes that toxic wording saves.

    A window without a code, or half of one, of the toxic dictionary saves
    nothing, so only the others, one of seven or so, are compressed.
    """
    plain, other = _compressors(ordinary, toxic)
    whole, (_, known) = coded(text), _known(toxic)
    gain = np.zeros(max(1, -(-len(whole) // (WINDOW * CODE))), int)
    if len(known):
        halves = _halves(whole)
        found = known.take(known.searchsorted(halves), mode="clip") == halves
        for i in np.unique(np.flatnonzero(found) // (2 * WINDOW)).tolist():
            window = whole[i * WINDOW * CODE : (i + 1) * WINDOW * CODE]
            gain[i] = len(plain.compress(window)) - len(other.compress(window))
    return gain


def measures(gain: np.ndarray) -> tuple[float, ...]:
    top = np.sort(gain)[-3:]
    return (top[-1], top.mean(), gain.mean(), *((gain >= n).mean() for n in STEPS), np.log1p(len(gain)))


def _terms(z: np.ndarray) -> np.ndarray:
    """The measures, the largest and the mean gain times the length, and one."""
    z = np.clip(z, -20, 20)
    return np.hstack([np.ones((len(z), 1)), z, z[:, :1] * z[:, -1:], z[:, 2:3] * z[:, -1:]])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary of zstandard's trainer; of samples too few to train, their codes.

    The trainer writes its header over what it chose first, the most frequent
    codes; the most frequent that it lacks follow.
    """
    try:
        trained = zstandard.train_dictionary(size, samples, k=CODE, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" "
    keys = _sample_keys(samples)
    keys.sort()  # in place: they are the largest part of the memory
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    often, keys = np.diff(np.append(starts, len(keys))), keys[starts]
    lost = ~np.isin(keys, _known(trained)[0])
    often, keys = often[lost], keys[lost]
    most = often >= (np.sort(often)[-LOST:][:1] if len(often) else 0)
    often = dict(zip(keys[most].tolist(), often[most].tolist(), strict=True))
    found = {}
    for i in range(0, len(samples), 4096):
        some = b"".join(samples[i : i + 4096])
        own = _sample_keys([some])
        for k in np.flatnonzero(np.isin(own, keys[most])).tolist():
            found[some[k * CODE : (k + 1) * CODE]] = -often[int(own[k])]
    found = sorted((n, c) for c, n in found.items())
    return trained + b"".join(c for _, c in reversed(found[:LOST]))


def _sample_keys(samples: list[bytes]) -> np.ndarray:
    """The keys of all codes of the samples, some at a time, so that they are not held twice."""
    some = (b"".join(samples[i : i + 4096]) for i in range(0, len(samples), 4096))
    return np.concatenate([np.zeros(0, np.uint64), *(_keys(_halves(s).reshape(-1, 2).T) for s in some)])


def _sample(texts: list[tuple[str, int]], most: int) -> list[bytes]:
    """Windows of ``(text, number of windows)``, ``most`` at most: of a text with more than the share that fits, so many at random."""
    sizes = np.sort([n for _, n in texts])
    rest = np.arange(len(sizes), 0, -1)  # texts of this size or more
    fits = np.cumsum(sizes) - sizes + sizes * rest <= most
    if fits.all():
        share = int(sizes[-1]) if len(sizes) else 0
    else:
        first = int(np.argmin(fits))
        share = int((most - sizes[:first].sum()) // rest[first])
    draw, sample = random.Random(7), []
    for text, _ in texts:
        own = windows(coded(text))
        sample += own if len(own) <= share else draw.sample(own, share)
    draw.shuffle(sample)  # the trainer takes the best of each stretch
    return sample


def _dictionaries(rows: list[tuple[str, int, int]], most: int) -> tuple[bytes, bytes]:
    """Train the ordinary dictionary, then the toxic one on what the ordinary one lacks of toxic windows."""
    ordinary = _trained(ORDINARY_BYTES, _sample([(t, n) for t, y, n in rows if not y], most))
    sample = _sample([(t, n) for t, y, n in rows if y], most)
    new = ~np.isin(_sample_keys(sample), _known(ordinary)[0])
    lacking, start = [], 0
    for window in sample:
        own = new[start : start + len(window) // CODE]
        start += len(own)
        if own.any():
            lacking.append(np.frombuffer(window, f"V{CODE}")[own].tobytes())
    del sample, new
    return ordinary, _trained(TOXIC_BYTES, lacking)


def _fitted_without(part: int, rows: list[tuple[str, int]], training_windows: int) -> tuple:
    """Dictionaries of the rows outside a part, the places of the rows in it and their measures."""
    fold = np.array([zlib.crc32(t.encode("utf-8")) % FOLDS for t, _ in rows])
    counted = [(t, y, _number_of_windows(t)) for (t, y), f in zip(rows, fold, strict=True) if f != part]
    known = _dictionaries(counted, training_windows)
    own = np.flatnonzero(fold == part)
    return known, own, np.array([measures(gains(rows[i][0], *known)) for i in own]).reshape(-1, MEASURES)


def _calibrated(label: np.ndarray, measured: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre and spread of the measures and the weights of their terms."""
    centre, spread = measured.mean(0), measured.std(0) + 1e-9
    terms = _terms((measured - centre) / spread)
    weights = np.zeros(terms.shape[1])
    for _ in range(30):  # Newton's steps with a small penalty
        p = _logistic(terms @ weights)
        slope = terms.T @ (label - p) - weights
        weights += np.linalg.solve((terms * (p * (1 - p))[:, None]).T @ terms + np.eye(len(weights)), slope)
    return centre, spread, weights


def _model(label: np.ndarray, parts: Iterable[tuple]) -> ToxicityModel:
    """A model of the labels and of each part's ``_fitted_without``; the last part has no row, so its dictionaries are of all rows."""
    if not len(label) or label.min() == label.max():
        share = label.mean() if len(label) else 0.5
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return ToxicityModel(b" ", b" ", (0.0,) * MEASURES, (1.0,) * MEASURES, (float(odds), *(0.0,) * (MEASURES + 2)))
    measured = np.zeros((len(label), MEASURES))
    for known, own, found in parts:
        measured[own] = found
    return ToxicityModel(*known, *(tuple(map(float, x)) for x in _calibrated(label, measured)))


def fit(rows: list[tuple[str | None, int]], training_windows: int = TRAINING_WINDOWS) -> ToxicityModel:
    """A model of ``(text, 0 or 1)`` rows.

    At most ``training_windows`` windows of each label train its dictionary: all, or
    of the longest rows an equal number, drawn at random.

    Thresholds are calibrated on rows whose wording the dictionaries in use
    were not trained on: each part of the rows is measured with dictionaries
    of the other parts. The returned model has the dictionaries of all rows.
    Without rows of both labels there is nothing to compare; every text then
    has the share of toxic rows as its score, a half if there is no row.
    """
    rows = [(t or "", int(y)) for t, y in rows]
    label = np.array([y for _, y in rows], float)
    return _model(label, (_fitted_without(part, rows, training_windows) for part in range(FOLDS + 1)))


def _fit_in_parts(sample: DataFrame, training_windows: int) -> ToxicityModel:
    """``fit`` on the rows ``text, y``, a group for each part; only dictionaries, labels and measures come to the driver."""
    ship(sample.sparkSession)

    def fitted(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        # In one order everywhere, so that the places are the same in all groups.
        rows = sorted(zip(table["text"].to_pylist(), table["y"].to_pylist(), strict=True))
        label = [y for _, y in rows]
        known, own, found = (b"", b""), np.zeros(0, int), np.zeros((0, MEASURES))
        if len(set(label)) > 1:
            known, own, found = _fitted_without(part, rows, training_windows)
        row = {"part": part, "ordinary": known[0], "toxic": known[1], "own": own.tolist(), "measured": found.ravel().tolist()}
        return pa.Table.from_pylist([row | {"label": label if part == FOLDS else []}], schema)

    lists = {"own": pa.int32(), "measured": pa.float64(), "label": pa.int32()}
    blobs = [("part", pa.int32()), ("ordinary", pa.binary()), ("toxic", pa.binary())]
    schema = pa.schema(blobs + [(name, pa.list_(kind)) for name, kind in lists.items()])
    text = F.coalesce("text", F.lit("")).alias("text")
    copies = sample.select(F.explode(F.lit(list(range(FOLDS + 1)))).alias("part"), text, "y")
    types = "part int, ordinary binary, toxic binary, own array<int>, measured array<double>, label array<int>"
    rows = sorted(copies.groupBy("part").applyInArrow(fitted, types).collect(), key=lambda r: r["part"])
    parts = [((bytes(r["ordinary"]), bytes(r["toxic"])), r["own"], np.reshape(r["measured"], (-1, MEASURES))) for r in rows]
    return _model(np.array(rows[-1]["label"] if rows else [], float), parts)


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: the CRC-32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    toxic_rows: int = TOXIC_ROWS,
    ordinary_rows: int = ORDINARY_ROWS,
    training_windows: int = TRAINING_WINDOWS,
) -> ToxicityModel:
    """Fit on labelled documents that are not held out.

    At most ``toxic_rows`` and ``ordinary_rows`` ids are drawn, those of the
    smallest hashes, with one text for each id: that of the smallest hash where
    documents share an id. An id with several labels has the highest. Null labels
    and ids are left out. Of those texts, at most ``training_windows`` windows of
    each label train its dictionary. Each part of the calibration is a group of
    its own with the texts drawn; none of them come to the driver.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    known = known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    order = (F.xxhash64("id"), "id")
    chosen = known.where("y = 1").orderBy(*order).limit(toxic_rows)
    chosen = chosen.union(known.where("y = 0").orderBy(*order).limit(ordinary_rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(one).select("text", "y")
    return _fit_in_parts(found, training_windows)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``id_col, score double, predicted int`` per row of ``docs``.

    The whole text is cut into windows of codes of words and each is compressed twice.
    A null or empty text has one window that saves nothing. Null and repeated
    ids and rows keep their row; other columns are not looked at.
    """
    return docs.select(F.col(id_col), scored(docs.sparkSession, model, text_col).alias("score")).select(
        id_col, "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def scored(spark, model: ToxicityModel, text_col: str):
    """The score of a text column."""
    ship(spark)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts.to_pylist()), pa.float64())

    return of(F.col(text_col))
