"""Language detection: a naive Bayes model over letter bigrams, fitted by Spark."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.functions.text import BIBLIOGRAPHIC_CODES, LANG_CODES, decode
from textloom.operators.keys import document_key
from textloom.session import durable

# A fit reads about so many labelled documents. A model may have any number of
# bigrams; the most frequent of each language, so many in all, go to every task,
# the others are joined.
FIT_DOCUMENTS = 200_000
LEAST_DOCUMENTS = 1_000
COMMON = 50_000
# Code points that a task counts at once.
LETTERS = 1 << 21
LANGUAGES = tuple(sorted({BIBLIOGRAPHIC_CODES.get(c, c) for c in LANG_CODES.values()}))


def _bigram_counts(docs: DataFrame, *keys: str) -> DataFrame:
    """``keys, gram, times``: how often each row has each pair of neighbouring letters, lower-cased.

    A row without any has a null ``gram``, no times. Letters are found by Spark;
    a task counts pairs of code points a batch of rows at a time, so a row for
    each distinct pair of a document meets joins and shuffles, not one for each
    place in its text.
    """
    letters = F.regexp_replace(F.lower(decode(F.col("content"))), r"\P{L}+", " ")
    rows = docs.select(*keys, F.coalesce(letters, F.lit("")).alias("letters"))
    schema = StructType([*(rows.schema[k] for k in keys), StructField("gram", StringType()), StructField("times", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                # Texts of a few million letters at once.
                high, size, texts = low, 0, []
                while high < batch.num_rows and size < LETTERS:
                    texts.append(batch.column(len(keys))[high].as_py())
                    size += len(texts[-1]) + 1
                    high += 1
                points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le"), "<u4")
                # Code points by their order among those that occur, so that row and pair fit in a number.
                seen = np.zeros(0x110000, bool)
                seen[points] = True
                points, letters = (np.cumsum(seen) - 1)[points], [chr(x) for x in np.flatnonzero(seen).tolist()]
                n, space = len(letters), letters.index(" ")
                doc = np.repeat(np.arange(len(texts)), [len(x) + 1 for x in texts])
                inside = np.flatnonzero((points[:-1] != space) & (points[1:] != space))
                cells = (doc[inside] * n + points[inside]) * n + points[inside + 1]
                cells, times = np.unique(cells, return_counts=True)
                row, pair = np.divmod(cells, n * n)
                known, gram = np.unique(pair, return_inverse=True)
                named = pa.array([letters[x // n] + letters[x % n] for x in known.tolist()], pa.string())
                none = np.setdiff1d(np.arange(len(texts)), row)
                grams = pa.concat_arrays([named.take(pa.array(gram)), pa.nulls(len(none), pa.string())])
                own = pa.array(np.concatenate((row, none)) + low)
                columns = [batch.column(i).take(own) for i in range(len(keys))]
                counts = pa.array(np.concatenate((times, np.zeros(len(none), np.int64))))
                yield pa.RecordBatch.from_arrays([*columns, grams, counts], schema.names)
                low = high

    return rows.mapInArrow(count, schema)


def _bound(sizes: list[int], most: int) -> int:
    """The size to which the large ones are cut for all to have ``most`` together."""
    left, bound = most, max(sizes, default=0)
    if sum(sizes) <= most:
        return bound
    for i, size in enumerate(sorted(sizes)):
        bound = left // (len(sizes) - i)
        if size > bound:
            break
        left -= size
    return bound


@dataclass(frozen=True)
class LanguageModel:
    """Weights of bigrams: ``gram, language, weight, common``, and the score of an unseen bigram by language.

    ``language`` is a position in ``languages``. A weight is what a bigram adds
    to the score of an unseen one; pairs of bigram and language that have none
    are left out. ``common`` marks at most ``COMMON`` bigrams, ``rare`` says
    whether there are others.
    """

    weights: DataFrame
    languages: tuple[str, ...]
    unseen: tuple[float, ...]
    rare: bool

    @staticmethod
    def fit(
        docs: DataFrame,
        label: str = "lang_code",
        languages: Sequence[str] = LANGUAGES,
        documents: int = FIT_DOCUMENTS,
        common: int = COMMON,
    ) -> LanguageModel:
        """Fit on documents with ``content`` and a label, with add-one smoothing.

        Documents with another label, and languages without a bigram, are left
        out. Of more labelled documents than ``documents``, about that many are
        read by hash: all of a language with few, equally many of the others,
        never less than ``LEAST_DOCUMENTS``. All their bigrams count; ``common``
        bounds those that a detection sends to every task. Counts are combined
        before the shuffle, so it carries the vocabulary and not the text. They
        are checkpointed, since the totals and every later detection read them
        again.
        """
        codes = tuple(languages)
        labelled = docs.where(F.col(label).isin(*codes))
        found = {r[label]: r["count"] for r in labelled.groupBy(label).count().collect()}  # some of the given codes
        bound = max(_bound(list(found.values()), documents), LEAST_DOCUMENTS)
        if any(n > bound for n in found.values()):
            # Copies of a text differ in their path, so they are not taken or left together.
            row = F.pmod(F.xxhash64(*[c for c in ("remote", "path") if c in docs.columns], "content"), F.lit(1 << 32))
            shares = F.create_map(*[F.lit(x) for c, n in found.items() for x in (c, min((bound << 32) // n, 1 << 32))])
            labelled = labelled.where(row < shares[F.col(label)])
        pairs = _bigram_counts(labelled, label).where(F.col("gram").isNotNull())
        counts = durable(pairs.groupBy("gram", label).agg(F.sum("times").alias("n")))
        totals = {r[label]: r["n"] for r in counts.groupBy(label).agg(F.sum("n").alias("n")).collect()}
        codes = tuple(c for c in codes if c in totals)
        if not codes:
            raise ValueError("no labelled document with two neighbouring letters")
        # The most frequent of each language, then the second of each, and so on. The limit on
        # the rank lets every task drop most rows before the shuffle.
        by_count = Window.partitionBy(label).orderBy(F.desc("n"), "gram")
        ranked = counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= common)
        head = ranked.groupBy("gram").agg(F.sum("n").alias("n"), F.min("rank").alias("rank"))
        head = head.orderBy("rank", F.desc("n"), "gram").limit(common).select("gram", F.lit(True).alias("common"))
        size = counts.select("gram").distinct().count()
        position = F.create_map(*[F.lit(x) for i, c in enumerate(codes) for x in (c, i)])[F.col(label)]
        marked = counts.join(F.broadcast(head), "gram", "left")
        weights = durable(
            marked.select(
                "gram",
                position.alias("language"),
                F.log(F.col("n") + 1).alias("weight"),
                F.coalesce("common", F.lit(False)).alias("common"),
            )
        )
        return LanguageModel(weights, codes, tuple(-math.log(totals[c] + size) for c in codes), size > common)

    def save(self, path: str) -> None:
        """Store the model: its weights, and a row without a bigram for each language, with its unseen score."""
        rest = [(None, i, u, False, c) for i, (u, c) in enumerate(zip(self.unseen, self.languages, strict=True))]
        schema = "gram string, language int, weight double, common boolean, code string"
        rows = self.weights.withColumn("code", F.lit(None).cast("string"))
        rows.union(self.weights.sparkSession.createDataFrame(rest, schema)).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LanguageModel:
        stored = spark.read.parquet(path)
        rest = stored.where("gram IS NULL").orderBy("language").collect()  # one row a language
        weights = stored.where("gram IS NOT NULL").drop("code")
        rare = not weights.where("NOT common").isEmpty()
        return LanguageModel(weights, tuple(r["code"] for r in rest), tuple(r["weight"] for r in rest), rare)

    def detect(self, docs: DataFrame) -> DataFrame:
        """Most probable language of each document and its probability.

        Returns the document's key (remote and path, or the path alone),
        ``lang_code`` and ``lang_score``; both are null for a document without
        two neighbouring letters.

        All rows of a document are in one task, which has the weights of the
        common bigrams, so the partial sums leave one row per document for the
        shuffle. Bigrams of a document that are not common are counted and meet
        the other weights in a join of any size. A bigram of a third of all
        documents is common, or of no language at all; adaptive execution
        splits the latter.
        """
        key = document_key(docs)
        grams = _bigram_counts(docs, *key)
        each = range(len(self.languages))
        of = [F.sum(F.when(F.col("language") == i, F.col("weight"))).alias(f"w{i}") for i in each]
        # At most COMMON rows.
        common = F.broadcast(self.weights.where("common").groupBy("gram").agg(*of))
        joined = grams.join(common.withColumn("met", F.lit(True)), "gram", "left")
        sums = [F.sum(F.col("times") * F.coalesce(f"w{i}", F.lit(0.0))).alias(f"s{i}") for i in each]
        summed = joined.groupBy(*key).agg(F.sum("times").alias("grams"), *sums)
        if self.rare:
            summed = self._with_rare(joined.where("met IS NULL AND gram IS NOT NULL"), summed, key)
        scores = [F.col(f"s{i}") + F.col("grams") * F.lit(u) for i, u in enumerate(self.unseen)]
        named = [F.struct(s.alias("score"), F.lit(c).alias("code")) for s, c in zip(scores, self.languages, strict=True)]
        picked = summed.withColumn("best", F.array_max(F.array(*named)))
        mass = sum((F.exp(s - F.col("best.score")) for s in scores), F.lit(0.0))
        known = F.col("grams") > 0
        return picked.select(
            *key, F.when(known, F.col("best.code")).alias("lang_code"), F.when(known, 1 / mass).alias("lang_score")
        )

    def _with_rare(self, left: DataFrame, summed: DataFrame, key: list[str]) -> DataFrame:
        """The sums with the weights of the bigrams that are ``left``; null keys meet as well."""
        each = range(len(self.languages))
        counted = left.groupBy(*key, "gram").agg(F.sum("times").alias("times"))
        met = counted.join(self.weights.where("NOT common").hint("merge"), "gram")
        more = met.groupBy(*key).agg(
            *[F.sum(F.when(F.col("language") == i, F.col("times") * F.col("weight"))).alias(f"t{i}") for i in each]
        )
        more = more.withColumnsRenamed({c: f"their_{c}" for c in key})
        same = [F.col(c).eqNullSafe(F.col(f"their_{c}")) for c in key]
        both = summed.join(more, same, "left")
        return both.select(*key, "grams", *[(F.col(f"s{i}") + F.coalesce(f"t{i}", F.lit(0.0))).alias(f"s{i}") for i in each])
