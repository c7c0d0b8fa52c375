"""Byte-level BPE against the tiktoken library, and its edge cases."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

from conftest import SF001
from tabml.llm import bpe

VOCABULARY = P.path("byte_bpe_multi_50k.tiktoken")
CASES = ["", "a" * 5000, "\x00\x1c\x1f ▁ <unk> ̀x", "😀👍🏽 שלום 日本語   x\r\n\t  y ", "it's 'sno'll we''re '",
         "½²³ ªº ÀÿĀɏɐ 12 \u0085x", "".join(f"x{chr(i)}{chr(i)} 1{chr(i)} " for i in range(0x600)), None]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})


def digest(ids):
    return hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def test_cases_as_the_library(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES + CASES[1:3])] + [(None, "a b", "y")],
                                 "doc_id long, text string, `n tokens` string")
    out = bpe.encode(docs, VOCABULARY, P.PATTERN)
    assert out.columns == ["doc_id", "n tokens", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256"]
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(CASES) + 3
    for i, t in enumerate(CASES + CASES[1:3]):
        ids = library.encode_ordinary(t or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == digest(ids)
        assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(out.filter("doc_id is not null"), VOCABULARY).collect()}
    assert all(back[i] == (t or "").encode() for i, t in enumerate(CASES))


def test_very_long_text(spark, library):
    text = "Lorem ipsüm 12's\n" * 80_000
    r = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), VOCABULARY, P.PATTERN).first()
    assert r.ids_sha256 == digest(library.encode_ordinary(text))


def test_empty_table_and_clash(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(none, VOCABULARY, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([(1, "a")], "n_tokens long, text string"), VOCABULARY, P.PATTERN)


def test_documents_as_the_library(spark, library):
    from tabml.llm.queries import op3_byte_bpe
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op3_byte_bpe(spark, SF001).collect()
    assert len(rows) == len(texts)
    assert all(r.ids_sha256 == digest(library.encode_ordinary(texts[r.doc_id])) for r in rows)


def test_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    codec = bpe.Codec(bpe.read_ranks(VOCABULARY), P.PATTERN)
    for t in ("one two three four five six seven", "eight nine ten eleven one two", "one two"):
        assert codec.encode_all([t], [True]) == [b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(t))]


def test_vocabularies_do_not_share_ids():
    """Codecs of one process: two vocabularies that differ in an early token only."""
    late = {bytes([65 + i // 26, 65 + i % 26]): 257 + i for i in range(100)}
    one = {bytes([b]): b for b in range(256)} | {b"ab": 256} | late
    two = {bytes([b]): b for b in range(256)} | {b"bx": 256} | late
    for ranks in (one, two, one):
        own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        want = b"".join(i.to_bytes(4, "little") for i in own.encode_ordinary("abxab bx"))
        assert bpe.Codec(ranks, P.PATTERN).encode("abxab bx") == want


def test_decode_edges(spark):
    none = spark.createDataFrame([], "doc_id long, token_ids binary")
    assert bpe.decode(none, VOCABULARY).count() == 0
    with pytest.raises(ValueError, match="decoded"):
        bpe.decode(none.withColumnRenamed("doc_id", "decoded"), VOCABULARY)
