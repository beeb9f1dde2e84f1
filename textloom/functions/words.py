"""Word segmentation after the default word boundaries of UAX #29."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.arrays import let

# Scripts in which every character is a segment of its own.
_SINGLE = r"\p{IsIdeographic}\p{IsHiragana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
# Looking up a script is slow. So common letters come first as ranges, and the
# cheap test for alphabetic characters guards the others.
_COMMON = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{2AF}\x{400}-\x{481}\x{48A}-\x{52F}"
_MARK = r"[\p{M}\p{Cf}&&[^\x{200B}]]"
_LETTER = rf"[{_COMMON}[\p{{IsAlphabetic}}&&[^\p{{M}}\p{{IsKatakana}}{_SINGLE}]]]"
_LETTERS = rf"[{_COMMON}[[\p{{IsAlphabetic}}\p{{M}}\p{{Cf}}]&&[^\x{{200B}}\p{{IsKatakana}}{_SINGLE}]]]"
_DIGIT = r"\p{Nd}"
_DIGITS = r"[\p{Nd}\p{M}\p{Cf}&&[^\x{200B}]]"
_KANA = r"[\p{IsAlphabetic}&&\p{IsKatakana}]"
_KANAS = r"[[\p{IsAlphabetic}&&\p{IsKatakana}]\p{M}\p{Cf}&&[^\x{200B}]]"
_JOIN = r"\p{Pc}"
_JOINS = r"[\p{Pc}\p{M}\p{Cf}&&[^\x{200B}]]"
# The MidLetter, MidNum and MidNumLet characters of UAX #29.
_MID_BOTH = r"'.\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
_MID_LETTER = rf"[:\x{{00B7}}\x{{0387}}\x{{055F}}\x{{05F4}}\x{{2027}}\x{{FE13}}\x{{FE55}}\x{{FF1A}}{_MID_BOTH}]"
_MID_DIGIT = (
    r"[,;\x{037E}\x{0589}\x{060C}\x{060D}\x{066C}\x{07F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
    rf"{_MID_BOTH}]"
)
_RUN = (
    rf"(?:{_LETTER}{_LETTERS}*+(?:{_MID_LETTER}{_MARK}*+{_LETTER}{_LETTERS}*+)*+"
    rf"|{_DIGIT}{_DIGITS}*+(?:{_MID_DIGIT}{_MARK}*+{_DIGIT}{_DIGITS}*+)*+)++"
)
_UNIT = rf"(?:{_RUN}|{_KANA}{_KANAS}*+)"

# Every quantifier is possessive: a group loop then runs without recursion, so
# a "word" of a million digits and commas does not exhaust the stack.
WORD = (
    # Most words: ASCII letters that nothing after them can prolong.
    r"[A-Za-z]++(?!['.:]?+[0-9A-Za-z_\x{80}-\x{10FFFF}])"
    rf"|{_UNIT}(?:{_JOIN}{_JOINS}*+{_UNIT}?+)*+"
    rf"|(?:{_JOIN}{_JOINS}*+{_UNIT}?+)++"
    rf"|[\p{{IsAlphabetic}}&&[{_SINGLE}]]{_MARK}*+"
)

# The letter categories a token filter may ask for.
LETTER_CATEGORIES = {
    "a": r"\p{L}",
    "l": r"\p{Ll}",
    "u": r"\p{Lu}",
    "t": r"\p{Lt}",
    "m": r"\p{Lm}",
    "o": r"\p{Lo}",
}


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_stats(text: Column) -> Column:
    """Struct of the number of words and their total length in bytes.

    One pass of the word pattern: every word becomes one NUL, and what is left
    tells both numbers. NULs of the text itself are counted and taken off.
    """
    nul = F.lit("\0")

    def nuls(t: Column) -> Column:
        return F.octet_length(t) - F.octet_length(F.replace(t, nul, F.lit("")))

    return let(
        F.regexp_replace(text, F.lit(WORD), nul),
        lambda marked: let(
            nuls(marked) - nuls(text),
            lambda n: F.struct(
                n.cast("long").alias("words"),
                (F.octet_length(text) - F.octet_length(marked) + n).cast("long").alias("bytes"),
            ),
        ),
    )


def has_category(token: Column, categories: Sequence[str]) -> Column:
    """True if any character of the token is in one of the letter categories."""
    unknown = [c for c in categories if c not in LETTER_CATEGORIES]
    if unknown:
        raise ValueError(f"unknown letter category: {', '.join(unknown)}")
    return token.rlike("[" + "".join(LETTER_CATEGORIES[c] for c in categories) + "]")


def tokens(text: Column, min_length: int = 2, categories: Sequence[str] = ()) -> Column:
    """Lower-cased words that pass the filters, in order.

    The category is tested on the original case.
    """

    def keep(w: Column) -> Column:
        ok = F.char_length(w) >= min_length
        if categories:
            ok = ok & has_category(w, categories)
        return ok

    return F.transform(F.filter(words(text), keep), F.lower)


def without(tokens_column: str, stopwords: Sequence[str]) -> Column:
    """The tokens of an array column that are no stop words.

    The list becomes one SQL text, which is parsed at once: a column per word
    would cost a call into the JVM each. Spark looks the words up in a hash set.
    """
    quoted = ", ".join(
        "'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in stopwords
    )
    return F.expr(f"filter(`{tokens_column}`, w -> w NOT IN ({quoted}))")


def ngrams(token_array: Column, n: int) -> Column:
    """Space-joined windows of ``n`` neighbouring tokens."""
    if n == 1:
        return token_array
    return let(
        token_array,
        lambda w: F.when(
            F.size(w) >= n,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - n),
                lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )
