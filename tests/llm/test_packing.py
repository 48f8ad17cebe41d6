"""Packing: ids are the library's, every id lies in one piece, sequences are gapless and nearly full."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from supportlens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start int, length string, key int, part int, rank int, place int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "l", 2, 3, 4, 5) for r in rows], SCHEMA)


def test_ids_are_the_librarys():
    library = Tokenizer.from_file(PATH)
    chance = random.Random(8)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "a \nb", "\n \n", "a\n ", "a b\n\n", "it's <|endoftext|> x<|endoftext|>", "é　 ü x  "]
    texts += ["".join(chance.choices(["a", "b'll", " ", "\n", "1", "é", "!", "\t", " ", "\x1c", "<|endoftext|>"], k=chance.randint(1, 12))) for _ in range(3000)]
    for text in texts:
        ids = np.frombuffer(packing.token_bytes(text, PATH), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_latin_words_are_one_match(monkeypatch):
    # Words of Latin letters, and one mark behind them, are encoded without the pattern; other letters go through it.
    library, asked = Tokenizer.from_file(PATH), []
    packing._pieces.cache_clear()
    encoder = packing._pieces(PATH)
    findall = encoder.findall
    monkeypatch.setattr(encoder, "findall", lambda piece: asked.append(piece) or findall(piece))
    for text, other in [("x ñandúes niñez, Über. ßa łódź", []), ("x ﬁn, слово ªº ɐb d'été", [" ﬁn,", " слово", " ɐb", " d'été"]), ("x é1 e\u0301t a²", [" é1", " e\u0301t", " a²"])]:
        asked.clear()
        ids = np.frombuffer(encoder.encoded(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids and [a for a in asked if a != "x"] == other
    packing._pieces.cache_clear()


def test_fill_finds_the_largest_sum():
    chance = random.Random(1)
    for _ in range(200):
        counts = {chance.randint(1, 12): chance.randint(0, 3) for _ in range(4)}
        room = chance.randint(0, 30)
        best = max(s for s in (sum(a * b for a, b in zip(counts, c, strict=True)) for c in itertools.product(*[range(n + 1) for n in counts.values()])) if s <= room)
        used = packing.fill(counts, room)
        assert sum(a * b for a, b in used.items()) == best and all(n <= counts[x] for x, n in used.items())


def test_patterns_use_every_piece_once():
    chance = random.Random(2)
    counts = {chance.randint(1, 100): chance.randint(1, 50) for _ in range(40)}
    found = packing.patterns(counts, 100)
    total = {}
    for used, times in found:
        assert sum(x * n for x, n in used.items()) <= 100
        for x, n in used.items():
            total[x] = total.get(x, 0) + n * times
    assert total == counts
    # No two pieces of more than half a window fit into one.
    tokens, large = sum(x * n for x, n in counts.items()), sum(n for x, n in counts.items() if x > 50)
    assert sum(t for _, t in found) <= max(-(-tokens // 100), large) + 1


def check(got, rows, window):
    library = Tokenizer.from_file(PATH)
    want = []
    for k, t in rows:
        want.append((k, [*library.encode(t or "", add_special_tokens=False).ids, 1]))
    docs, sequences = {}, {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    expected = {}
    for k, ids in want:
        for s in range(0, len(ids), window):
            part = np.array(ids[s : s + window], "<u4")
            expected.setdefault((k, len(ids)), []).append((s, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in docs.items()} == {k: sorted(v) for k, v in expected.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= window
    return sum(len(i) for _, i in want), len(sequences)


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTS", 2)
    chance = random.Random(3)
    rows = [(i, "ab cd " * chance.randint(0, 30)) for i in range(120)]
    rows += [(None, None), (None, ""), (7, "same"), (7, "same"), (500, "x y " * 5000)]
    got = packing.pack(frame(spark, rows), PATH, window=32).collect()
    tokens, sequences = check(got, rows, 32)
    assert sequences <= tokens / 32 * 1.03 + 1
    again = packing.pack(frame(spark, rows), PATH, window=32).collect()
    assert len(again) == len(got)


def test_documents_are_packed_with_little_padding(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    tokens, sequences = check(packing.pack(docs, PATH).collect(), rows, 2048)
    assert sequences * 2048 <= tokens * 1.03


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0
