"""Byte-level BPE encoding and decoding of whole texts, over Arrow batches.

A vocabulary of ranks (bytes -> rank) becomes a BPE model of the tokenizers library: each byte is written as the
printable character that stands for it, and every way to join two entries to a third is a merge, in the order of the
ranks. The model merges the characters of one match of the splitting pattern at a time; matches and the pieces
between single blanks are remembered by the worker.

Encoding gives ids and, per token, the characters of the text it covers: lengths in bytes come from the vocabulary,
and the places of characters from the bytes that begin one. Decoding turns the characters of the entries back into
bytes. A token may hold a part of a character; the bytes are joined before they are read as text, and token by token
a character belongs to the token that completes it.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.llm.tokens import Cache

#: Entries of each cache; longer keys aren't kept.
CACHED, KEPT_CHARS = 250_000, 48
MARKS = ".,;:!?)"
AFTER_LATIN = "\u0250"
LATIN = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
#: Bytes of text after which a batch of results is handed on, and after which a text is encoded in parts.
HANDED, PART_CHARS = 1 << 20, 1 << 16

_two_blanks = re.compile(r" \s").search
_single_blank = re.compile(r"(?<!\s) (?!\s|\Z)")


@cache
def byte_characters() -> tuple[str, ...]:
    """The printable character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return tuple(chr(b if b in own else next(spare)) for b in range(256))


def as_characters(data: bytes) -> str:
    return data.decode("latin-1").translate(byte_characters())


@cache
def _characters_as_bytes() -> dict[int, int]:
    return {ord(c): b for b, c in enumerate(byte_characters())}


def as_bytes(characters: str) -> bytes:
    return characters.translate(_characters_as_bytes()).encode("latin-1")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def bpe_model(ranks: dict[bytes, int]):
    """The ranks as a model of the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import models

    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((as_characters(token[:cut]), as_characters(token[cut:])))
    return models.BPE(vocab={as_characters(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0)


def _latin(piece: str) -> bool:
    """Whether a piece is a word of letters that every version of Unicode and of the pattern's library knows as such."""
    return piece.isalpha() and (piece.isascii() or max(piece) < AFTER_LATIN)


class _Words(Cache):
    """Pieces after a blank. A word and the one mark behind it are two matches, which aren't kept together."""

    def __missing__(self, piece: str) -> bytes:
        if piece[-1:] in self.ends and _latin(piece[:-1]):
            return self[piece[:-1]] + self.ends[piece[-1]]
        value = self.old.get(piece)
        if value is None:
            if piece.isascii() and piece.isalpha():
                # Most of what is computed: one match, of characters that stand for themselves.
                value = array("I", [t.id for t in self.tokenize(self.blank + piece)]).tobytes()
            else:
                value = self.compute(piece)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value


class Pieces:
    """Ids of texts, as 32-bit numbers, by the pieces between blanks and the matches of the pattern in them.

    The pattern begins a new match at a blank between two other characters, so a text is cut there; any other white
    space stays inside a piece. Pieces that hold one of ``special`` strings are encoded by ``whole``.
    """

    def __init__(self, model, pattern: str, special: tuple[str, ...] = (), whole: Callable[[str], list[int]] | None = None):
        self.tokenize, self.findall = model.tokenize, regex.compile(pattern).findall
        self.special, self.whole = special, whole
        self.blank = byte_characters()[32]
        self.plain = self.findall("ab cd, ef" + MARKS) == ["ab", " cd", ",", " ef", MARKS] and self.findall("a " + LATIN) == ["a", " " + LATIN] and not any(m in MARKS for m in special)
        self.matches = Cache(self._match, CACHED // 2)
        self.first = Cache(self._piece, CACHED // 8)
        self.later = (_Words if self.plain else Cache)(self._later, CACHED)
        if self.plain:
            self.later.tokenize, self.later.blank, self.later.ends = self.tokenize, self.blank, {m: self._match(m) for m in MARKS}

    def _match(self, match: str) -> bytes:
        if match.isascii() and match.isprintable():
            shown = match.replace(" ", self.blank)
        else:
            shown = as_characters(match.encode("utf-8", "replace"))
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _later(self, piece: str) -> bytes:
        """Ids of a piece with the blank before it."""
        return self._match(" " + piece) if self._is_word(piece) else self._piece(" " + piece)

    def _is_word(self, piece: str) -> bool:
        return self.plain and _latin(piece)

    def _piece(self, piece: str) -> bytes:
        if any(s in piece for s in self.special):
            return array("I", self.whole(piece)).tobytes()
        return b"".join(map(self._of_piece, self.findall(piece)))

    def _of_piece(self, match: str) -> bytes:
        if len(match) > KEPT_CHARS:
            return self._match(match)
        return self.later[match[1:]] if match[0] == " " and self._is_word(match[1:]) else self.matches[match]

    def _part(self, text: str, begins: bool) -> Iterator[bytes]:
        odd = _two_blanks(text) or text[-1:] == " " and text[-2:-1].isspace()
        pieces = _single_blank.split(text) if odd else text.split(" ")
        if begins:
            yield self.first[pieces[0]] if len(pieces[0]) <= KEPT_CHARS else self._piece(pieces[0])
            del pieces[0]
        later = self.later
        if max(map(len, pieces), default=0) <= KEPT_CHARS:
            yield from map(later.__getitem__, pieces)
        else:
            for piece in pieces:
                yield later[piece] if len(piece) <= KEPT_CHARS else self._piece(" " + piece)

    def encoded(self, text: str) -> bytes:
        """Ids of a text; a very long one is cut at single blanks first, so that its pieces aren't all held at once."""
        if len(text) <= PART_CHARS:
            return b"".join(self._part(text, True))
        out, start = [], 0
        while start < len(text):
            cut = _single_blank.search(text, start + PART_CHARS)
            stop = cut.start() if cut else len(text)
            out.append(b"".join(self._part(text[start:stop], start == 0)))
            start = stop + 1
        return b"".join(out)


@cache
def encoder(path: str, pattern: str) -> Pieces:
    """The encoder of a rank file, once in each process."""
    return Pieces(bpe_model(read_ranks(path)), pattern)


@cache
def token_table(path: str) -> tuple[list[bytes | None], np.ndarray]:
    """Bytes of every id, read back from the characters of the vocabulary, and their number."""
    entries = {rank: as_bytes(as_characters(token)) for token, rank in read_ranks(path).items()}
    table = [entries.get(i) for i in range(max(entries, default=-1) + 1)]
    return table, np.array([len(t or b"") for t in table], np.int64)


def spans(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last for tokens of these lengths in bytes.

    A token that begins or ends inside a character covers all of it.
    """
    after = np.cumsum(lengths)
    begun = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return begun[np.minimum(after - lengths + 1, len(data))] - 1, begun[after]


def token_texts(tokens: Iterable[bytes]) -> list[str]:
    """Text of each token; a character split between tokens is in the one that completes it."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    out = [decoder.decode(t) for t in tokens]
    rest = decoder.decode(b"", True)
    return [*out[:-1], out[-1] + rest] if out else []


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.array([])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32), pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = True) -> DataFrame:
    """``docs`` without its text, with ``ids`` and, if asked for, ``starts`` and ``ends``: the characters of the text
    that a token covers, the end not included.

    Null texts count as empty and have no tokens. There are no special tokens: their strings are ordinary text.
    Whole texts of any length are encoded, repeated rows each, and an empty table gives an empty result. The new
    columns replace ones of the same name.
    """
    made = ["ids", "starts", "ends"] if offsets else ["ids"]
    others = [c for c in docs.columns if c not in (text, *made)]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_llm_text"))
    schema = rows.drop("_llm_text").withColumns({c: F.array().cast("array<int>") for c in made}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, sizes = encoder(path, pattern).encoded, token_table(path)[1]
        for batch in batches:
            first, held, found = 0, 0, []
            texts = batch.column(batch.num_columns - 1)
            for i, value in enumerate(texts):
                value = value.as_py()
                ids = np.frombuffer(encoded(value), np.uint32)
                found.append((ids, *spans(value.encode("utf-8", "replace"), sizes[ids])) if offsets else (ids,))
                held += len(value)
                if held >= HANDED or i + 1 == len(texts):
                    kept = batch.slice(first, i + 1 - first).columns[:-1]
                    lists = [_lists([f[k] for f in found]) for k in range(len(made))]
                    yield pa.RecordBatch.from_arrays([*kept, *lists], [*others, *made])
                    first, held, found = i + 1, 0, []

    return rows.mapInArrow(run, schema)


def _id_lists(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The lists of an Arrow column as views of its numbers."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i, valid in enumerate(column.is_valid().to_numpy(zero_copy_only=False)):
        yield values[ends[i] : ends[i + 1]] if valid else None


def decoded(ids: np.ndarray, table: list[bytes | None]) -> bytes:
    """Bytes of a list of ids; an id that isn't in the vocabulary is an error."""
    return b"".join(map(table.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``bytes``, ``decoded`` (the bytes as UTF-8 text, what isn't UTF-8 replaced) and ``pieces`` (the
    text of each token, see ``token_texts``) instead of its ids. Null ids give nulls, no ids an empty text. The new
    columns replace ones of the same name."""
    made = ["bytes", "decoded", "pieces"]
    others = [c for c in encoded.columns if c not in (ids, *made)]
    rows = encoded.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{ids}`").cast("array<int>").alias("_llm_ids"))
    empty = F.lit("")
    schema = rows.drop("_llm_ids").withColumns(
        {"bytes": F.lit(None).cast("binary"), "decoded": F.nullif(empty, empty), "pieces": F.lit(None).cast("array<string>")}
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)[0]
        for batch in batches:
            data = [None if i is None else [table[k] for k in i.tolist()] for i in _id_lists(batch.column(batch.num_columns - 1))]
            joined = [None if d is None else b"".join(d) for d in data]
            texts = [None if d is None else d.decode("utf-8", "replace") for d in joined]
            pieces = [None if d is None else token_texts(d) for d in data]
            arrays = [pa.array(joined, pa.binary()), pa.array(texts, pa.string()), pa.array(pieces, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*others, *made])

    return rows.mapInArrow(run, schema)


def digests(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` without its ids, with their number ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned
    32-bit numbers) and ``decoded_sha256`` (the decoded bytes). Null ids count as none."""
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    others = [c for c in encoded.columns if c not in (ids, *made)]
    rows = encoded.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("_llm_ids"))
    schema = rows.drop("_llm_ids").withColumns({"n_tokens": F.lit(0).cast("long"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit("")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)[0]
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for found in _id_lists(batch.column(batch.num_columns - 1)):
                counts.append(len(found))
                of_ids.append(hashlib.sha256(found.astype("<u4").tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(decoded(found, table)).hexdigest())
            arrays = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*others, *made])

    return rows.mapInArrow(run, schema)
