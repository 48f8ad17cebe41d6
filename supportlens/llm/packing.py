"""Packing token sequences by minimum bin slack.

A document is cut into full windows and one remainder. The numbers of remainders by length, at most one for each
length, are all that decides: for the longest one that is left, a subset-sum program over a bitset of reachable
sums finds the lengths that fill the rest of the window closest to its capacity, how many of each is read back from
the bitsets, and the pattern is used as often as the numbers allow. The patterns, bounded by the window and not by
the number of documents, are broadcast; a remainder's place in them follows from its rank among those of its length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supportlens.llm.bpe import Pieces
from supportlens.llm.rows import ROW, identified
from supportlens.llm.tokens import tokenizer
from supportlens.session import written

WINDOW, END = 2048, 1
#: Ranks are counted in parts of about this size, and in so many parts at least, so that a common length isn't one task's.
PART, PARTS = 500_000, 64
ID = "<u4"


@cache
def _pieces(path: str) -> Pieces:
    """The encoder of a byte-level tokenizer, once in each process."""
    found = tokenizer(path)
    parts = json.loads(found.to_str())
    if parts["normalizer"] or (parts["pre_tokenizer"] or {}).get("type") != "ByteLevel" or parts["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError(f"not a plain byte-level tokenizer: {path}")
    special = tuple(t["content"] for t in parts["added_tokens"])
    return Pieces(found.model, public_tokenizers.PATTERN, special, lambda piece: found.encode(piece, add_special_tokens=False).ids)


def token_bytes(text: str, path: str) -> bytes:
    """Ids of a text as 32-bit little-endian numbers."""
    return _pieces(path).encoded(text)


def pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """Full windows and the remainder of each row of an ``identified`` table, with the end id at its end."""
    rows = docs.select(*ROW, F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    more = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = rows.drop("text").withColumns({c: F.lit(0).cast("long") for c in more}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = np.array([end], ID).tobytes()
        for batch in batches:
            at, found = [], []
            for i, value in enumerate(batch.column(3)):
                data = token_bytes(value.as_py(), path) + stop
                for start in range(0, len(data), 4 * window):
                    part = data[start : start + 4 * window]
                    at.append(i)
                    found.append((start // 4, len(part) // 4, zlib.crc32(part), len(data) // 4))
            numbers = np.array(found, np.int64).reshape(-1, 4).T
            columns = [batch.column(k).take(pa.array(at, pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, numbers)], [*ROW, "key", *more])

    return rows.mapInArrow(run, schema)


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length make the largest sum up to ``room``: subset sums as a bitset, read back."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left, take = left - take, 2 * take
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def patterns(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Lengths of a window's pieces, and how many windows are filled so; every piece is in one window."""
    left, out = {x: n for x, n in counts.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fill(left, window - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        out.append((used, times))
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


def places(found: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, pieces a window, first window, offset), sorted: where the ranks of a length go."""
    rows, ranks, base = [], {}, 0
    for used, times in found:
        offset = 0
        for length in sorted(used, reverse=True):
            rows.append((length, ranks.get(length, 0), used[length], base, offset))
            ranks[length] = ranks.get(length, 0) + used[length] * times
            offset += length * used[length]
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(parts: DataFrame) -> DataFrame:
    """``parts`` with ``rank``, counted from 0 among the pieces of equal length, the same on every run."""
    number = max(PARTS, -(-parts.count() // PART))
    salted = parts.withColumn("part", F.pmod(F.xxhash64(*ROW, "start"), F.lit(number)))
    sizes = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = written(sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before")), "pack-offsets")
    here = F.row_number().over(Window.partitionBy("length", "part").orderBy(*ROW, "start")) - 1
    return salted.withColumn("here", here).join(offsets, ["length", "part"]).withColumn("rank", F.col("here") + F.col("before")).drop("part", "here", "before")


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``window`` tokens.

    Returns key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset``. A null or
    empty text is a document of the end id alone. Repeated rows are documents of their own, and equal or null keys
    are no key to anything. An empty table gives an empty result. Other columns are neither read nor returned.
    """
    parts = written(pieces(identified(docs), path, key, text, window, end), "pack-pieces")
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    table = docs.sparkSession.sparkContext.broadcast(places(patterns(counts, window)))

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        rows, wide, long, number = table.value, np.int64(1) << 48, length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(rows[:, 0] * wide + rows[:, 1], long * wide + number, "right") - 1
        _, first, each, base, offset = rows[at].T
        here = number - first
        return pa.StructArray.from_arrays([pa.array(base + here // each), pa.array(offset + here % each * long)], ["sequence_id", "offset"])

    placed = ranked(parts).withColumn("place", place("length", "rank"))
    return placed.select(F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", "place.sequence_id", "place.offset")
