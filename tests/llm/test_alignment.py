"""Aligned tokenizers against tokens placed byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from textloom.llm import alignment, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
FIRST, SECOND = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ALPHABET = " ▁\n\tabcTHEthe ing's 'd ÉéßİΣσ日本語ﬁ́̀\x1c\x85\xa0<s><0x0A>😀0129’.,\r“"


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def tokens(text, first, second):
    """Ids and byte ranges of either side; none where the bytes are not the text's."""
    whole = (" " + text).encode()
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
    a = [(i, bytes(of[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = [
        (i, bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode())
        for i in second.encode(text)
    ]
    sides = []
    for side in (a, b):
        at, placed = 0, []
        for i, t in side:
            placed.append((i, at, at + len(t)))
            at += len(t)
        if b"".join(t for _, t in side) != whole:
            return [], []
        sides.append(placed)
    return sides


def brute(rows):
    first, second = libraries()
    found, counts = [], Counter()
    for doc, text in rows:
        a, b = tokens(text, first, second) if text else ([], [])
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [
            "|".join(",".join(str(i) for i, _, e in side if lo < e <= hi) for side in (a, b))
            for lo, hi in zip([0, *cuts], cuts, strict=False)
        ]
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        counts.update(set(links))
        found.append((doc, a, b, groups, links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return sorted(
        str(
            (
                doc,
                len(a),
                len(b),
                len(groups),
                len(links),
                sum(counts[x] == best[x[0]] for x in links),
                sum(counts[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
            )
        )
        for doc, a, b, groups, links in found
    )


def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("eanrst") for _ in range(rng.randint(1, 8))) for _ in range(80)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(80)]
    rows += [(1000 + i, "".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 50)))) for i in range(250)]
    rows += [(None, "the end"), (7, None), (7, ""), (8, "a▁b"), (9, "<|endoftext|> </s>"), (10, "  two  spaces "), (11, "of " * 700)]
    return rows + [(12, "again and again")] * 40


@pytest.mark.parametrize("common", [0, 20, 1 << 19])
def test_query_is_brute_force(spark, tmp_path, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON", common)
    monkeypatch.setattr(alignment, "REMEMBERED", 100)
    rows = corpus()
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, keys int")
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_alignment(spark, str(tmp_path)).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows)


def test_parts_are_those_of_the_whole():
    both = alignment.pair(FIRST, SECOND)
    assert both.part is alignment._BEFORE_SPACES
    texts = [t for _, t in corpus() if t]
    for text, (n_a, n_b, n_groups, groups, links) in zip(texts, both.aligned(texts), strict=True):
        a, b = both.a.encode([" " + text])[0], both.b.encode([text])[0]
        if "▁" in text:
            assert n_a == n_b == 0
            continue
        want, all_links = both.align(a, b)
        assert (n_a, n_b, n_groups, groups) == (len(a), len(b), len(want), ";".join(want)) and links.tolist() == all_links


def test_groups_of_several_tokens_on_both_sides():
    both = alignment.pair(FIRST, SECOND)
    both_sizes = both.sizes
    try:
        both.sizes = [[0, 2, 3, 2], [0, 3, 3, 1]]
        groups, links = both.align([1, 2, 3], [1, 2, 3])
    finally:
        both.sizes = both_sizes
    # Ends 2, 5, 7 and 3, 6, 7: one group; a token meets those that its bytes overlap.
    assert groups == ["1,2,3|1,2,3"]
    assert [(x >> 32, x & 0xFFFFFFFF) for x in links] == [(1, 1), (2, 1), (2, 2), (3, 2), (3, 3)]


def test_long_text_and_no_text(spark):
    docs = spark.createDataFrame([(1, "word and number 12 " * 50_000)], "doc_id long, text string")
    row = alignment.align(docs, FIRST, SECOND).first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.count_sum == row.n_links
    assert alignment.align(docs.where("doc_id > 1"), FIRST, SECOND).collect() == []
