"""Letter counts and the distance to the letter distribution of a language."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.arrays import let

# Alphabets and relative letter frequencies of the reference
# distributions, in the order of the alphabet.
GERMAN_ALPHABET = "abcdefghijklmnopqrstuvwxyzßäöü"
GERMAN_FREQUENCIES = (
    0.06006, 0.02148, 0.02690, 0.04718, 0.16006, 0.01832, 0.03064, 0.04249, 0.07752, 0.00297,
    0.01536, 0.03787, 0.02798, 0.09660, 0.02684, 0.01049, 0.00028, 0.07737, 0.06343, 0.06369,
    0.03820, 0.00918, 0.01427, 0.00051, 0.00107, 0.01237, 0.00170, 0.00548, 0.00269, 0.00683,
)
ENGLISH_ALPHABET = "abcdefghijklmnopqrstuvwxyz"
ENGLISH_FREQUENCIES = (
    0.08167, 0.01492, 0.02782, 0.04253, 0.12702, 0.02228, 0.02015, 0.06094, 0.06966, 0.00253,
    0.01772, 0.04025, 0.02406, 0.06749, 0.07507, 0.01929, 0.00950, 0.05987, 0.06327, 0.09056,
    0.02758, 0.00978, 0.02360, 0.00250, 0.01974, 0.00074,
)
DEFAULT_ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüß"
DISTRIBUTIONS = {
    "ger": (GERMAN_ALPHABET, GERMAN_FREQUENCIES),
    "eng": (ENGLISH_ALPHABET, ENGLISH_FREQUENCIES),
}


def nfc(text: Column) -> Column:
    """Unicode normalisation form C, by the ICU library that ships with Spark.

    Text whose characters all lie below U+0300 has that form already; only
    other texts call the library. Null stays null.
    """

    def composed(t: Column) -> Column:
        call = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(False))
        return F.when(t.rlike(r"[^\x{0}-\x{2FF}]"), call).otherwise(t)

    return let(text, composed)


def alphabet_letters(alphabet: str) -> list[str]:
    """Lower-cased, composed, sorted letters of an alphabet, each once."""
    return sorted(set(unicodedata.normalize("NFC", alphabet.lower())))


def letter_counts(normalised: Column, alphabet: str) -> Column:
    """Array of the occurrences of each letter, in the order of the alphabet.

    Letter after letter is taken out of the text and counted by the bytes that
    are gone. Frequent letters go first, so the text that is left to read soon
    is short.
    """
    frequency = dict(zip(GERMAN_ALPHABET, GERMAN_FREQUENCIES, strict=True))
    order = sorted(alphabet, key=lambda c: -frequency.get(c, 0.0))

    def take(state: Column, letter: Column) -> Column:
        return let(
            F.replace(state["rest"], letter, F.lit("")),
            lambda rest: F.struct(
                rest.alias("rest"),
                F.array_append(
                    state["counts"],
                    (
                        (F.octet_length(state["rest"]) - F.octet_length(rest))
                        / F.octet_length(letter)
                    ).cast("long"),
                ).alias("counts"),
            ),
        )

    start = F.struct(
        normalised.alias("rest"), F.array().cast("array<bigint>").alias("counts")
    )
    return let(
        F.aggregate(F.array(*[F.lit(c) for c in order]), start, take, lambda state: state["counts"]),
        lambda counts: F.array(*[F.get(counts, F.lit(order.index(c))) for c in alphabet]),
    )


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda acc, n: acc + n)


def letter_distance(counts: Column, lang_code: str) -> Column:
    """L2 distance between the relative letter counts and those of a language.

    ``counts`` follows the German alphabet, which begins with the English one.
    Letters outside the alphabet of the language do not count. A text without
    letters is compared as the zero vector.
    """
    alphabet, expected = DISTRIBUTIONS[lang_code]
    shares = F.array(*[F.lit(x) for x in expected])

    def distance(own: Column) -> Column:
        return let(
            total(own),
            lambda n: F.sqrt(
                F.aggregate(
                    F.zip_with(
                        own,
                        shares,
                        lambda count, share: F.pow(
                            F.when(n > 0, count / n).otherwise(0.0) - share, 2
                        ),
                    ),
                    F.lit(0.0),
                    lambda acc, square: acc + square,
                )
            ),
        )

    return let(F.slice(counts, 1, len(alphabet)), distance)
