import hashlib
import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from textloom.functions import letters, text, words
from textloom.operators.index import INDEX_COLUMNS, build_index, letter_distances
from textloom.operators.letter_table import letter_table
from textloom.sources.readers import read_corpus

FOX = "The quick brown fox jumps over the lazy dog.\n"
FOX_HASH = "b47cc0f104b62d4c7c30bcd68fd8e67613e287dc4ad8c310ef10cbadea9c4380"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture
def fox(spark, tmp_path):
    (tmp_path / "data" / "x").mkdir(parents=True)
    (tmp_path / "data" / "x" / "fox.txt").write_text(FOX)
    (tmp_path / "data" / "x" / "fox.md").write_text("not a document")
    return read_corpus(spark, str(tmp_path))


def fox_distance():
    counts = {c: FOX.lower().count(c) for c in letters.ENGLISH_ALPHABET}
    pairs = zip(letters.ENGLISH_ALPHABET, letters.ENGLISH_FREQUENCIES, strict=True)
    return math.sqrt(sum((counts[c] / 35 - f) ** 2 for c, f in pairs))


def test_index_of_a_file(spark, fox):
    languages = spark.createDataFrame(
        [("data/x/fox.txt", "eng", 0.9)], "path string, lang_code string, lang_score double"
    )
    rows = build_index(fox, "shed", languages).collect()
    assert len(rows) == 1
    row = rows[0]
    assert tuple(row.asDict()) == INDEX_COLUMNS
    assert (row.remote, row.path, row.ppn, row.doctype) == ("shed", "data/x/fox.txt", "fox", "other")
    assert row.hash == FOX_HASH[:8]
    assert (row.size, row.strlen, row.words) == (45, 45, 9)
    assert row.avg_word_len == pytest.approx(35 / 9, abs=1e-4)
    assert row.alpha == pytest.approx(35 / 45, abs=1e-4)
    assert row.alphanum == pytest.approx(35 / 45, abs=1e-4)
    assert row.lfreq == pytest.approx(fox_distance(), abs=1e-4)
    assert row.mtime > 1_723_744_458


def test_index_types(fox):
    types = dict(build_index(fox, "shed").dtypes)
    assert types["avg_word_len"] == "float"
    assert types["lfreq"] == types["alpha"] == types["lang_score"] == "double"
    assert {types[c] for c in ("words", "size", "strlen", "mtime")} == {"bigint"}


def test_unknown_language_has_no_distance(spark, fox):
    assert build_index(fox, "shed").first().lfreq is None
    other = spark.createDataFrame(
        [("data/x/fox.txt", "fre", 0.9)], "path string, lang_code string, lang_score double"
    )
    assert build_index(fox, "shed", other).first().lfreq is None


def test_sha256(fox):
    assert fox.select(text.sha256(F.col("content"))).first()[0] == FOX_HASH


def test_empty_document(docs_of):
    row = build_index(docs_of({"data/a.txt": ""}), "r").first()
    assert (row.words, row.size, row.strlen) == (0, 0, 0)
    assert (row.alpha, row.alphanum, row.avg_word_len) == (0.0, 0.0, 0.0)


def test_no_letters_is_the_zero_vector(docs_of):
    row = letter_distances(docs_of({"a": "12 + 3"})).first()
    assert row.dist_eng == pytest.approx(math.sqrt(sum(f * f for f in letters.ENGLISH_FREQUENCIES)))
    assert row.dist_ger == pytest.approx(math.sqrt(sum(f * f for f in letters.GERMAN_FREQUENCIES)))


def test_invalid_utf8(docs_of):
    data = b"caf\xc3\xa9 \xff\xfe bar"
    row = build_index(docs_of({"data/a.txt": data}), "r").first()
    decoded = data.decode("utf-8", errors="replace")
    assert row.size == len(data)
    assert row.strlen == len(decoded)
    assert row.hash == hashlib.sha256(data).hexdigest()[:8]
    assert row.words == 2


def test_letter_table_refuses_invalid_utf8(docs_of):
    with pytest.raises(Exception, match="UTF"):
        letter_table(docs_of({"a": b"\xff"})).collect()


def test_letter_counts(spark):
    counts = letters.letter_counts(F.lit("abca"), "abcdef")
    assert value(spark, counts) == [2, 1, 1, 0, 0, 0]


def test_letter_table(docs_of):
    found = letter_table(docs_of({"p": "Ää ÉßẞxX", "q": "..."}), "BÄabßÄ")
    assert found.columns == ["path", "total", "a", "b", "ß", "ä"]
    rows = {r["path"]: r for r in found.collect()}
    assert rows["p"].asDict() == {"path": "p", "total": 4, "a": 0, "b": 0, "ß": 2, "ä": 2}
    assert rows["q"]["total"] == 0


def test_default_alphabet():
    assert "".join(letters.alphabet_letters(letters.DEFAULT_ALPHABET)) == (
        "abcdefghijklmnopqrstuvwxyzßäöü"
    )


@pytest.mark.parametrize("sample", ["Ä ä q̣̇ 가 Ω", "", "plain"])
def test_nfc(spark, sample):
    assert value(spark, letters.nfc(F.lit(sample))) == unicodedata.normalize("NFC", sample)


@pytest.mark.parametrize(
    ("name", "expected"),
    [("article", "article"), ("book", "book"), ("chapter", "chapter"), ("issue", "issue"),
     ("other", "other"), ("ft", "other"), ("toc", "toc")],
)
def test_doctype(spark, name, expected):
    assert value(spark, text.doctype(F.lit(f"data/{name}/book.x/1.txt"))) == expected
    assert text.parse_doctype(name) == expected


def test_doctype_default_and_first(spark):
    assert value(spark, text.doctype(F.lit("data/wp/1.txt"))) == "other"
    assert value(spark, text.doctype(F.lit("toc/book/1.txt"))) == "toc"
    with pytest.raises(ValueError, match="wp"):
        text.parse_doctype("wp")


@pytest.mark.parametrize(
    ("path", "stem"),
    [("a/b/fox.txt", "fox"), ("fox", "fox"), ("a/b.c/x.y.txt", "x.y"), (".hidden", ".hidden")],
)
def test_document_id(spark, path, stem):
    assert value(spark, text.document_id(F.lit(path))) == stem


def test_relative_path(spark):
    path = F.lit("/home/foo/bar/baz.txt")
    assert value(spark, text.relative_path(path, "/home/foo")) == "bar/baz.txt"
    with pytest.raises(Exception, match="path not below"):
        value(spark, text.relative_path(path, "/home/bar"))


@pytest.mark.parametrize(
    ("code", "expected"),
    [("de", "ger"), ("en", "eng"), ("fr", "fre"), ("deu", "ger"), ("slk", "slo"), ("xx", "xx")],
)
def test_lang_code(spark, code, expected):
    assert value(spark, text.lang_code(F.lit(code))) == expected


@pytest.mark.parametrize(
    ("size", "shown"),
    [(0, "0 B"), (1023, "1023 B"), (1024, "1 KiB"), (1536, "1.50 KiB"), (1152, "1.12 KiB"),
     (5 * 1024**2, "5 MiB"), (3 * 1024**3 + 1, "3.00 GiB"), (2**62, "4 EiB")],
)
def test_human_size(spark, size, shown):
    assert value(spark, text.human_size(F.lit(size).cast("long"))) == shown


# Word boundaries: examples after the rules of UAX #29, segments without a
# word character at their start left out.
WORDS = {
    "The quick (“brown”) fox can’t jump 32.3 feet, right?": (
        ["The", "quick", "brown", "fox", "can’t", "jump", "32.3", "feet", "right"]
    ),
    "foo_bar __x 1,000.5 a.b 3.x x.3 a,b": (
        ["foo_bar", "__x", "1,000.5", "a.b", "3", "x", "x", "3", "a", "b"]
    ),
    "'quoted' rock'n'roll e-mail 10² ½ Ⅷ": ["quoted", "rock'n'roll", "e", "mail", "10", "Ⅷ"],
    "können i­j": ["können", "i­j"],
    "漢字かな カタカナ_a": ["漢", "字", "か", "な", "カタカナ_a"],
    "aカタb": ["a", "カタ", "b"],
    "": [],
    "... --": [],
}


@pytest.mark.parametrize("sample", list(WORDS))
def test_words(spark, sample):
    assert value(spark, words.words(F.lit(sample))) == WORDS[sample]
    stats = value(spark, words.word_stats(F.lit(sample)))
    assert stats["words"] == len(WORDS[sample])
    assert stats["bytes"] == sum(len(w.encode()) for w in WORDS[sample])


def test_word_stats_with_nul(spark):
    stats = value(spark, words.word_stats(F.lit("a\0b \0")))
    assert (stats["words"], stats["bytes"]) == (2, 2)


@pytest.mark.parametrize("unit", ["1,", "a1", "a.", "_", "カ_"])
def test_a_very_long_word(spark, unit):
    sample = spark.range(1).select(F.repeat(F.lit(unit), 300_000).alias("t"))
    found = sample.select(F.size(words.words(F.col("t"))).alias("n")).first()["n"]
    assert found == 1
