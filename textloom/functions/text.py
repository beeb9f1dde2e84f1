"""Scalar expressions over the bytes, the text and the path of a document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Document types, and the folder name that stands for "other".
DOCTYPES = ("article", "book", "chapter", "issue", "other", "toc")
DOCTYPE_ALIASES = {"ft": "other"}
DEFAULT_DOCTYPE = "other"

# Three-letter codes of the supported languages by two-letter
# code, and the bibliographic code where it is used instead.
LANG_CODES = {
    "af": "afr", "ar": "ara", "az": "aze", "be": "bel", "bg": "bul", "bn": "ben", "bs": "bos",
    "ca": "cat", "cs": "ces", "cy": "cym", "da": "dan", "de": "deu", "el": "ell", "en": "eng",
    "eo": "epo", "es": "spa", "et": "est", "eu": "eus", "fa": "fas", "fi": "fin", "fr": "fra",
    "ga": "gle", "gu": "guj", "he": "heb", "hi": "hin", "hr": "hrv", "hu": "hun", "hy": "hye",
    "id": "ind", "is": "isl", "it": "ita", "ja": "jpn", "ka": "kat", "kk": "kaz", "ko": "kor",
    "la": "lat", "lg": "lug", "lt": "lit", "lv": "lav", "mi": "mri", "mk": "mkd", "mn": "mon",
    "mr": "mar", "ms": "msa", "nb": "nob", "nl": "nld", "nn": "nno", "pa": "pan", "pl": "pol",
    "pt": "por", "ro": "ron", "ru": "rus", "sk": "slk", "sl": "slv", "sn": "sna", "so": "som",
    "sq": "sqi", "sr": "srp", "st": "sot", "sv": "swe", "sw": "swa", "ta": "tam", "te": "tel",
    "th": "tha", "tl": "tgl", "tn": "tsn", "tr": "tur", "ts": "tso", "uk": "ukr", "ur": "urd",
    "vi": "vie", "xh": "xho", "yo": "yor", "zh": "zho", "zu": "zul",
}
BIBLIOGRAPHIC_CODES = {
    "sqi": "alb", "hye": "arm", "eus": "baq", "zho": "chi", "ces": "cze", "nld": "dut",
    "fra": "fre", "kat": "geo", "deu": "ger", "ell": "gre", "mkd": "mac", "msa": "may",
    "mri": "mao", "fas": "per", "ron": "rum", "slk": "slo", "cym": "wel",
}

_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def decode(content: Column) -> Column:
    """Text of the bytes; each ill-formed sequence becomes U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def decode_strict(content: Column) -> Column:
    """Text of the bytes; the job fails on ill-formed UTF-8."""
    return F.validate_utf8(content.cast("string"))


# One well-formed UTF-8 sequence, over bytes read as Latin-1 characters.
_WELL_FORMED = (
    r"[\x00-\x7F]|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]"
    r"|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2}"
)


def decode_same_length(content: Column) -> Column:
    """Text with the byte offsets of ``content``: an ill-formed byte becomes NUL.

    For results that are byte positions, which U+FFFD (three bytes) would move.
    """
    latin = F.decode(content, "ISO-8859-1")
    masked = F.regexp_replace(
        latin, F.lit(rf"\G((?:{_WELL_FORMED})*+)[\x80-\xFF]"), F.lit("$1\0")
    )
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.encode(masked, "ISO-8859-1").cast("string")
    )


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def hash_prefix(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def alpha_ratio(text: Column) -> Column:
    """Share of alphabetic characters, 0 for the empty text."""
    return _share(text, r"\P{IsAlphabetic}+")


def alphanum_ratio(text: Column) -> Column:
    """Share of alphabetic and numeric characters, 0 for the empty text."""
    return _share(text, r"[^\p{IsAlphabetic}\p{N}]+")


def _share(text: Column, others: str) -> Column:
    # Stripping runs of other characters makes far fewer matches than counting
    # the characters one by one.
    total = F.char_length(text)
    kept = F.char_length(F.regexp_replace(text, F.lit(others), F.lit("")))
    return F.when(total > 0, kept / total).otherwise(0.0)


def document_id(path: Column) -> Column:
    """File stem: the last path component without its extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def doctype(path: Column) -> Column:
    """First path component that names a document type, else the default."""
    names = [*DOCTYPES, *DOCTYPE_ALIASES]
    found = F.get(F.filter(F.split(path, "/"), lambda part: part.isin(names)), F.lit(0))
    for alias, name in DOCTYPE_ALIASES.items():
        found = F.when(found == alias, F.lit(name)).otherwise(found)
    return F.coalesce(found, F.lit(DEFAULT_DOCTYPE))


def parse_doctype(name: str) -> str:
    """Document type for a name given by the user."""
    if name in DOCTYPE_ALIASES:
        return DOCTYPE_ALIASES[name]
    if name not in DOCTYPES:
        raise ValueError(f"invalid document type '{name}'")
    return name


def relative_path(path: Column, prefix: str) -> Column:
    """Path below ``prefix``; the job fails for a path outside of it."""
    base = prefix.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, F.lit(len(base) + 1), F.length(path))).otherwise(
        F.raise_error(F.concat(F.lit(f"path not below {base}: "), path))
    )


def lang_code(code: Column) -> Column:
    """Bibliographic language code for a two- or three-letter code.

    An unknown code is returned as it is.
    """
    three = _lookup(code, LANG_CODES)
    return _lookup(three, BIBLIOGRAPHIC_CODES)


def _lookup(code: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.element_at(pairs, code), code)


def human_size(size: Column) -> Column:
    """Size with a binary unit: no decimals for whole numbers, else two."""
    text = None
    for power, unit in reversed(list(enumerate(_UNITS))):
        value = size / F.lit(float(1024**power))
        shown = F.when(value == F.floor(value), F.format_string("%d", F.floor(value).cast("long")))
        shown = shown.otherwise(F.format_string("%.2f", F.bround(value, 2)))
        shown = F.concat(shown, F.lit(" " + unit))
        text = shown if text is None else text
        if power < len(_UNITS) - 1:
            text = F.when(size < F.lit(1024 ** (power + 1)), shown).otherwise(text)
    return text
