import re

import pytest

from textloom.functions.references import PATTERNS
from textloom.operators.references import references

# The same identifiers for Python's byte patterns.
BYTES = {
    "isbn": rb"(?i)ISBN(?:-1[03])?(?::?\s*)?\s((?:97[89][- ]?)?\d{1,5}[- ]?(?:\d+[- ]?){2}(?:\d|X))",
    "issn": rb"(?i)ISSN(?::?\s*)?\s(\d{4}-\d{4})",
    "ddc": "(?i)DDC\\s+(\\d{3}(?:\\.\\d+))(?:—dc23)".encode(),
    "orcid": rb"(?i)(?:https?://orcid\.org/)(\d{4}-\d{4}-\d{4}-\d{3}(?:\d|X))",
    "isni": rb"(?:https?://isni\.org/isni/)(\d{15}(?:\d|X))",
}


def brute_force(texts):
    out = set()
    for path, data in texts.items():
        data = data.encode() if isinstance(data, str) else data
        for kind, pattern in BYTES.items():
            for m in re.finditer(pattern, data):
                out.add((path, kind, m.group(1).decode(), m.start(), m.end()))
    return out


TEXTS = {
    "hits": "Ünïcode ISBN 978-3-16-148410-0, ISBN-10: 3-16-148410-X ü ISSN 1234-5678 issn: 4321-8765\n"
    "DDC 025.431—dc23 https://orcid.org/0000-0002-1825-0097 http://isni.org/isni/000000012146438X",
    "misses": "ISBN978 ISSN 123-4567 ISSN 1234-567X DDC 025—dc23 DDC 025.4 http://ISNI.org/isni/0 "
    "https://orcid.org/0000-0002-1825-009 isbn",
    "none": "nothing here",
    "empty": "",
    "adjacent": "ISSN 1111-2222ISSN 3333-4444 ISSN 1111-2222",
    "invalid": b"\xff\xfe\xc3 ISSN 1111-2222 \xe2\x82 \xf0\x9f\x98\x80 ISSN 3333-4444 \xed\xa0\x80 issn 5555-6666",
}


def test_against_brute_force(docs_of):
    got = [tuple(r) for r in references(docs_of(TEXTS)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_force(TEXTS)


def test_many_matches_in_one_document(docs_of):
    texts = {"p": "ü " + "".join(f"ISSN {i:04d}-{i:04d}ä " for i in range(3000))}
    got = {tuple(r) for r in references(docs_of(texts)).collect()}
    assert got == brute_force(texts)


@pytest.mark.parametrize("kind", list(PATTERNS))
def test_each_matcher(docs_of, kind):
    got = {tuple(r) for r in references(docs_of(TEXTS), {kind: PATTERNS[kind]}).collect()}
    assert got == {r for r in brute_force(TEXTS) if r[1] == kind}


def test_unicode_case_and_digits(docs_of):
    texts = {"long s": "iſſn 1234-5678", "dotless": "ıSBN 3-16-148410-0", "arabic": "ISSN ١٢٣٤-٥٦٧٨"}
    got = {(r["path"], r["value"]) for r in references(docs_of(texts)).collect()}
    assert got == {("long s", "1234-5678"), ("arabic", "١٢٣٤-٥٦٧٨")}


def test_more_kinds(docs_of):
    got = references(docs_of({"p": "é doi:10.1/x"}), {"doi": r"doi:(10\.\S+)"}).collect()
    assert [tuple(r) for r in got] == [("p", "doi", "10.1/x", 3, 13)]


def test_patterns_that_look_around(docs_of):
    texts = {"p": "é doi:10.1/x 10.2/y", "q": "doi:10.3/z"}
    got = references(docs_of(texts), {"doi": r"(?<=doi:)(10\.\S+)"}).collect()
    assert sorted(tuple(r) for r in got) == [("p", "doi", "10.1/x", 7, 13), ("q", "doi", "10.3/z", 4, 10)]


def test_equal_paths_keep_their_positions(spark):
    rows = [("a", "p", bytearray(b"see ISSN 1111-2222")), ("b", "p", bytearray(b"ISSN 1111-2222 ISSN 3333-4444"))]
    docs = spark.createDataFrame(rows + rows[:1], "remote string, path string, content binary")
    got = sorted((r["remote"], r["start"], r["end"]) for r in references(docs).collect())
    assert got == [("a", 4, 18), ("a", 4, 18), ("b", 0, 14), ("b", 15, 29)]


def test_empty_matches_are_refused(docs_of):
    with pytest.raises(Exception, match="matches the empty string"):
        references(docs_of({"p": "abc"}), {"none": "(x*)"}).collect()
