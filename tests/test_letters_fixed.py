"""Letter distances of fixed texts, from frequencies stated here once more."""

import math

import pytest

from textloom.operators.index import letter_distances
from textloom.operators.letter_table import letter_table

# English frequencies of a to z.
ENGLISH = (
    0.08167, 0.01492, 0.02782, 0.04253, 0.12702, 0.02228, 0.02015, 0.06094, 0.06966, 0.00253,
    0.01772, 0.04025, 0.02406, 0.06749, 0.07507, 0.01929, 0.00950, 0.05987, 0.06327, 0.09056,
    0.02758, 0.00978, 0.02360, 0.00250, 0.01974, 0.00074,
)


@pytest.mark.parametrize("text", ["the quick brown fox", "", "äöü ß", "E\u0301e"])
def test_english_distance(docs_of, text):
    letters = [c for c in text.lower().replace("e\u0301", "é") if "a" <= c <= "z"]
    shares = [letters.count(chr(97 + i)) / len(letters) if letters else 0 for i in range(26)]
    want = math.sqrt(sum((a - b) ** 2 for a, b in zip(shares, ENGLISH, strict=True)))
    assert letter_distances(docs_of({"p": text})).first()["dist_eng"] == pytest.approx(want)


def test_composition(docs_of):
    """Decomposed letters are composed, also where a text mixes both."""
    row = letter_table(docs_of({"p": "a\u0308 ä A\u0308 a \u00e9"})).first()
    assert (row["a"], row["ä"], row["total"]) == (1, 3, 4)
