"""Token counts against encoding whole texts with the library."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from supportlens.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_bytes int, n_tokens string, word string, n int"
TEXTS = [
    None, "", " \t\r\n\x0b\x0c", "Hello, world!", "don't they're I'LL", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>",
    "é Été ́x", "İstanbul İ ΣΣ Σ", "1234 ١٢ ½", "a b c　d\u0085e\x1cf\x1dg",
    "\U0001f600\U0001f468‍\U0001f469 ﬁ Å", "x" * 5000, "a b ​ c﻿d", "\x00\x01 \x7f", "word " * 3000,
]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, 1, "z", "w", 2) for k, t in rows], SCHEMA)


@pytest.mark.parametrize("size", [tokens.CACHED, 2])
def test_counts_are_the_librarys(spark, monkeypatch, size):
    monkeypatch.setattr(tokens, "FREQUENT", 5)
    library = Tokenizer.from_file(PATH)
    rows = [*enumerate(TEXTS), (None, "Hello, world!"), (3, "Hello, world!")]
    got = tokens.token_counts(frame(spark, rows), PATH)
    assert got.columns == ["doc_id", "word", "n", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for k, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((k, "w", 2, len((t or "").encode()), n, n > 2048))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    cache = tokens.Cache(len, size)
    assert [cache["x" * i] for i in (1, 2, 3, 4, 1, 2)] == [1, 2, 3, 4, 1, 2] and len(cache) + len(cache.old) <= 2 * size


def test_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    library = Tokenizer.from_file(PATH)
    want = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs, PATH).collect()} == want


def test_empty_table(spark):
    assert tokens.token_counts(frame(spark, []), PATH).count() == 0
