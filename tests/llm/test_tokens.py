"""Token ids against the libraries, records by round trip."""

import random
import struct
import zlib

import numpy as np
import pytest

from textloom.llm import crc32c, pieces, queries, records

public_tokenizers = pytest.importorskip("public_tokenizers")
ALPHABET = " ▁\n\tabcTHEthe ing's 'd ÉéßİΣσ日本語ﬁ́̀\x00\x1c\x85\xa0<s><0x0A>😀0129’.,\r“"
ODD = ["", "   ", "\n", "▁", "<s>a</s><unk>", "the" * 3000, "a" * 700 + " " * 40 + "日" * 300, "word " * 20_000]


def texts(n=1500):
    rng = random.Random(11)
    return ODD + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def ids_of(coded):
    return np.frombuffer(coded, "<i4").tolist()


def test_merges_are_the_librarys():
    words = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    for text, coded, want in zip(texts(), words.encode(texts()), words.library.encode(texts()), strict=True):
        assert ids_of(coded) == want, text
    some = [c for t in texts(200) for c in words.chunk.findall(pieces.SPACE + t.replace(" ", pieces.SPACE)) if t][:800]
    assert [ids_of(c) for c in words.agendas(some)] == [words.agenda(c) for c in some]


def test_a_difference_ends_the_job():
    words = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    words.ranks = words.ranks[::-1].copy()
    with pytest.raises(ValueError, match="another way"):
        words.encode(texts(300))


def test_piece_query(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(["", None, "A line.\nAnother  one", "日本"])] + [(0, "again", "y"), (None, "n", "z")]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op6_sentencepiece(spark, str(tmp_path)).collect()
    library = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model")).library
    import hashlib

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc, text, _ in rows:
        ids = library.encode(text or "")
        want.append((str(doc), len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(want)


def test_chunks_are_encoded_as_the_whole():
    coder = records.Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    assert coder.apart
    extra = ["x <|endoftext|>. y<|ENDOFTEXT|>", "DON'T don't rock'n'roll I'D"]
    assert coder.encode(texts() + extra) == coder._ids(texts() + extra)


def test_crc32c():
    assert crc32c.crc32c_all([b"123456789"]) == [0xE3069283]

    def slow(data):
        state = 0xFFFFFFFF
        for b in data:
            state ^= b
            for _ in range(8):
                state = state >> 1 ^ (0x82F63B78 if state & 1 else 0)
        return state ^ 0xFFFFFFFF

    rng = random.Random(1)
    parts = [rng.randbytes(n) for n in (0, 1, 2, 3, 4, 5, 511, 512, 513, 1500, 3000)]
    assert crc32c.crc32c_all(parts) == [slow(p) for p in parts]


def test_frames():
    data = [b"", b"x", b"abc" * 500]
    framed = records.frames(data)
    assert records.payloads(framed) == data
    assert struct.unpack_from("<Q", framed[2])[0] == 1500
    with pytest.raises(ValueError, match="damaged"):
        records.payloads([framed[2][:-5] + b"z" + framed[2][-4:]])
    for ids in ([], [1, 65535], [70_000, 2]):
        assert records.unpack_ids(records.pack_ids(np.array(ids, "<u4"))).tolist() == ids


def test_record_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "RANGE_DOCS", 3)
    rows = [(i * 7 % 23, f"Text number {i}. " * (i % 4), "x") for i in range(23)]
    rows += [(5, None, "y"), (5, "", "y"), (None, "first", "z"), (99, "word " * 20_000, "z")]
    spark.createDataFrame(rows, "doc_id long, text string, start string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op7_records(spark, str(tmp_path)).collect()
    library = records.Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    assert len(found) == len(rows)
    order = sorted(found, key=lambda r: (r.start, r.n_tokens))
    keys = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys)
    at = 0
    for r in order:
        assert r.start == at
        at += r.n_tokens
    want = sorted((str(d), n, zlib.crc32(c + struct.pack("<I", 2))) for d, t, _ in rows for c in [library.encode([t or ""])[0]] for n in [len(c) // 4 + 1])
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want


def test_orphans_of_lost_attempts_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    index = records.write_records(docs, str(tmp_path / "r"), public_tokenizers.path("word_bpe_49k.json"), 2)
    (tmp_path / "r/records/part-000000-00000-lost.records").write_bytes(b"half a rec")
    assert records.read_records(index, str(tmp_path / "r")).count() == 2


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    index = records.write_records(docs, str(tmp_path / "r"), public_tokenizers.path("word_bpe_49k.json"), 2)
    assert records.read_records(index, str(tmp_path / "r")).collect() == []
    assert pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")).collect() == []
