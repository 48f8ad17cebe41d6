"""Byte-level BPE against the tiktoken library, and round trips."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from supportlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, n_tokens int, starts string"
TEXTS = [
    None, "", " ", "  ", " \n", "\n \n a", "Hello, world!", "don't they're I'LL we'd 'tis", "a<|endoftext|>b", "x  y   z ",
    "é Été é ́x", "日本語 の テスト", "ไทย ภาษา", "1234 ١٢ ½ Ⅻ", "a b　c d\u0085 e", "😀👨‍👩 🏳️", "\x00\x01 \x7f",
    "tab\tand \t mixed \r\n ends \n", "x" * 5000, "=" * 300 + "-" * 301, "word " * 30000, "ab" * 90000, " " * 2000 + "a",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def encoded(spark, texts, **more):
    rows = [(i, t, "ids", 1, "starts") for i, t in enumerate(texts)]
    return bpe.encode(spark.createDataFrame(rows, SCHEMA), PATH, public_tokenizers.PATTERN, **more)


def test_ids_are_the_librarys_and_decoding_gives_the_text_back(spark, library):
    got = encoded(spark, TEXTS)
    assert got.columns == ["doc_id", "n_tokens", "ids", "starts", "ends"]
    rows = {r["doc_id"]: r for r in bpe.decode(got.withColumn("kept", got.ids), PATH).collect()}
    for i, text in enumerate(TEXTS):
        text, row = text or "", rows[i]
        assert row["kept"] == library.encode_ordinary(text)
        assert row["bytes"] == text.encode() and row["decoded"] == text and "".join(row["pieces"]) == text
        assert len(row["starts"]) == len(row["ends"]) == len(row["pieces"]) == len(row["kept"])


def test_spans_cover_the_characters_a_token_has_bytes_of(spark, library):
    row = encoded(spark, ["aé日😀 " * 3 + "\U0002070e𠜎x"]).first()
    text, at = "aé日😀 " * 3 + "\U0002070e𠜎x", 0
    where = [i for i, c in enumerate(text) for _ in c.encode()]
    for token, start, end in zip(row["ids"], row["starts"], row["ends"], strict=True):
        size = len(library.decode_single_token_bytes(token))
        assert (start, end) == (where[at], where[at + size - 1] + 1)
        at += size
    assert at == len(text.encode()) and any(a == b for a, b in zip(row["starts"], row["starts"][1:], strict=False))


def test_digests(spark, library):
    got = bpe.digests(encoded(spark, TEXTS, offsets=False), PATH).collect()
    assert list(got[0].asDict()) == ["doc_id", "starts", "n_tokens", "ids_sha256", "decoded_sha256"]
    for row in got:
        text = TEXTS[row["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids) and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_random_texts_of_few_characters(library, monkeypatch):
    monkeypatch.setattr(bpe, "PART_CHARS", 40)
    draw = random.Random(3)
    encode = bpe.Pieces(bpe.bpe_model(bpe.read_ranks(PATH)), public_tokenizers.PATTERN).encoded
    for _ in range(20000):
        letters = draw.choice(["ab", "=-", "aA1 ", " \n\t", "lo'st ", "é日a ", "0123", "._- ", "  x", "re'v ,e", "the in"])
        text = "".join(draw.choices(letters, k=draw.randrange(1, 90)))
        ids = library.encode_ordinary(text)
        assert encode(text) == struct.pack(f"={len(ids)}I", *ids), text


def test_split_characters_belong_to_the_completing_token():
    assert bpe.token_texts([b"a\xe6", b"\x97", b"\xa5b", b"\xf0\x9f"]) == ["a", "", "日b", "�"]
    assert bpe.token_texts([]) == [] and [bpe.as_bytes(bpe.as_characters(bytes([b]))) for b in range(256)] == [bytes([b]) for b in range(256)]


def test_empty_table_and_null_ids(spark):
    assert bpe.digests(encoded(spark, []), PATH).count() == 0
    rows = bpe.decode(spark.createDataFrame([(1, None), (2, [])], "k long, ids array<int>"), PATH).collect()
    assert [tuple(r) for r in rows] == [(1, None, None, None), (2, b"", "", [])]


def test_unknown_id_is_an_error(spark):
    with pytest.raises(Exception):
        bpe.decode(spark.createDataFrame([(1, [50300])], "k long, ids array<int>"), PATH).collect()
