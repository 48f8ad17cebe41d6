"""Near-duplicates by SimHash fingerprints and pivot distance tables.

The table of a fingerprint holds its Hamming distances to many reference fingerprints, the pivots, as a whole and
within six blocks of its bits. Two fingerprints that differ in at most ``RADIUS`` = 3 bits differ in at most three
blocks, so in at least three blocks all their pivot distances are equal: the distances of every three blocks are
packed into a key, and only fingerprints that share a key are compared. Of those, pairs with a pivot distance that
differs by more than the radius are discarded (the triangle inequality), and the rest is verified bit by bit.

A key shared by very many fingerprints is divided once more, in the same way, by the bits outside its three blocks.
That fixes 48 of the 64 bits, so what is left of it is bounded for any number of documents. Equal fingerprints are
one node from the start, and a bucket emits a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.llm.components import components
from supportlens.llm.rows import ROW, identified
from supportlens.session import written

SEED, WIDTH, RADIUS = 42, 3, 3
PIVOTS = 16
#: Fingerprints of one key that are compared directly; keys with more are divided.
DIRECT = 8192
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """SimHash of the word shingles: a bit is set if it is in more than half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - width + 1
    starts, ends = starts[:count], ends[width - 1 :]
    digest, sums = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, CHUNK):
        part = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in part], "<u8")
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(identity, key, fp) of each row of an ``identified`` table, fp as a signed long."""
    rows = docs.select(*ROW, F.col(key).alias("key"), F.col(text).alias("text"))
    schema = rows.drop("text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found = np.array([fingerprint(t.as_py(), width) for t in texts], np.uint64).view(np.int64)
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [pa.array(found, pa.int64())], [*others, "fp"])

    return rows.mapInArrow(run, schema)


def pivots(count: int = PIVOTS, seed: int = SEED) -> np.ndarray:
    """Reference fingerprints, drawn with a fixed seed."""
    return np.random.default_rng(seed).integers(0, 1 << 64, count, np.uint64)


def distances(fps: np.ndarray, mask: int = (1 << 64) - 1) -> np.ndarray:
    """Pivot distance table: a row per pivot, a column per fingerprint; of the bits in ``mask`` only."""
    return np.stack([np.bitwise_count((fps ^ p) & np.uint64(mask)) for p in pivots()])


def blocks(bits: list[int], count: int = 2 * RADIUS) -> list[int]:
    """The given bits divided into ``count`` masks."""
    return [sum(1 << int(b) for b in part) for part in np.array_split(bits, count)]


def block_keys(fps: np.ndarray, above: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (a row for every three of six blocks of the bits) and which blocks they left out (as a mask)."""
    masks = blocks(bits)
    signatures = []
    for mask in masks:
        packed = np.zeros(len(fps), np.uint64)
        for row in distances(fps, mask):
            packed = packed * np.uint64(31) + row
        signatures.append(_mixed(packed))
    keys, open_ = [], []
    for number, chosen in enumerate(itertools.combinations(range(len(masks)), len(masks) - RADIUS)):
        key = _mixed(above + np.uint64(number + 1))
        for b in chosen:
            key = _mixed(key ^ signatures[b])
        keys.append(key)
        open_.append(sum(m for b, m in enumerate(masks) if b not in chosen))
    return np.stack(keys), np.array(open_, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finalizer of a public generator, splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``count`` nodes."""
    label = np.arange(count)
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def linked(key: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Label (an index) of each fingerprint; rows are sorted by key, and only rows of a key are compared."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    ends = np.repeat(np.append(starts[1:], len(key)), np.diff(np.append(starts, len(key))))
    table = distances(fps).astype(np.int8)
    label, left = np.arange(len(key)), np.arange(len(key))
    found, held = [], 0

    def close():
        nonlocal label, found, held
        a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        label, found, held = forest(len(key), np.concatenate((a, np.arange(len(key)))), np.concatenate((b, label))), [], 0

    for step in range(1, len(key)):
        left = left[left + step < ends[left]]
        if not len(left):
            break
        a, b = left, left + step
        for row in table:
            near = np.abs(row[a] - row[b]) <= RADIUS
            a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= RADIUS
        if near.any():
            found.append((a[near], b[near]))
            held += int(near.sum())
            if held > 1 << 20:
                close()
    if found:
        close()
    return label


def _compare(batches: Iterator[pa.RecordBatch], direct: int) -> Iterator[pa.RecordBatch]:
    """Links of rows (key, fp, open) that come sorted by key; rows of a key with too many come out again."""
    held = None

    def out(*columns):
        arrays = [pa.nulls(len(columns[0]), pa.int64()) if c is None else pa.array(c.view(np.int64)) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "key", "open"])

    def work(key, fps, open_):
        if not len(key):
            return
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        size = np.repeat(sizes, sizes)
        if (many := size > direct).any():
            yield out(fps[many], None, key[many], open_[many])
        some = (size > 1) & ~many
        key, fps = key[some], fps[some]
        if len(key):
            label = linked(key, fps)
            if (moved := label != np.arange(len(key))).any():
                yield out(fps[moved], fps[label[moved]], None, None)

    flushed = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3)]
        if flushed is not None and len(now[0]):
            more = now[0] == flushed
            if more.any():
                yield out(now[1][more], None, now[0][more], now[2][more])
                now = [x[~more] for x in now]
            if len(now[0]):
                flushed = None
        if held is not None:
            now = [np.concatenate((x, y)) for x, y in zip(held, now, strict=True)]
        if not len(now[0]):
            held = None
            continue
        last = int(np.searchsorted(now[0].view(np.int64), now[0].view(np.int64)[-1], "left"))
        yield from work(*[x[:last] for x in now])
        held = [x[last:] for x in now]
        if len(held[0]) > direct:
            yield out(held[1], None, held[0], held[2])
            flushed, held = held[0][-1], None
    if held is not None:
        yield from work(*held)


LINKS = "a long, b long, key long, open long"


def _bucketed(fps: DataFrame, name: str, last: bool) -> DataFrame:
    """One round: rows (fp, above, bits) get their keys, are dealt out by key and compared."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, above, bits = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3))
            for mask in np.unique(bits):
                at = bits == mask
                keys, open_ = block_keys(fp[at], above[at], [b for b in range(64) if int(mask) >> b & 1])
                columns = (keys.ravel(), np.tile(fp[at], len(keys)), np.repeat(open_, int(at.sum())))
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["key", "fp", "open"])

    direct = 1 << 62 if last else DIRECT
    keyed = fps.mapInArrow(expand, "key long, fp long, open long")
    dealt = keyed.repartition("key").sortWithinPartitions("key", "fp")
    return written(dealt.mapInArrow(lambda batches: _compare(batches, direct), LINKS), name)


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all pairs within the radius."""
    whole = fps.select("fp", F.lit(0).cast("long").alias("above"), F.lit(-1).cast("long").alias("bits"))
    first = _bucketed(whole, "simhash-links", last=False)
    many = first.filter("b IS NULL").select(F.col("a").alias("fp"), F.col("key").alias("above"), F.col("open").alias("bits"))
    second = _bucketed(many, "simhash-divided", last=True)
    return first.filter("b IS NOT NULL").select("a", "b").unionByName(second.select("a", "b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Groups of rows whose fingerprints are connected by steps of at most three bits.

    Returns, per row of ``docs``: its identity, key, ``fp`` (signed long), ``component`` (the group's smallest fp),
    ``component_id`` (its smallest key; null if it has none but null) and ``kept``, true for one row of each
    group: the one with the smallest key, nulls last, of equal keys the one stored first. A text with fewer words
    than ``width`` has one shingle of all its words; a null, empty or blank text has fingerprint 0 and is linked
    like any other. Repeated rows are members like any other. An empty table gives an empty result. Columns other
    than ``key`` and ``text`` are neither read nor returned.
    """
    rows = written(fingerprints(identified(docs), key, text, width), "fingerprints")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key"), *ROW)).alias("first")
    nodes = written(rows.groupBy("fp").agg(first), "simhash-nodes")
    found = components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    placed = written(
        nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "simhash-placed"
    )
    groups = placed.groupBy("component").agg(F.min("first").alias("best"))
    groups = written(placed.select("fp", "component").join(written(groups, "simhash-groups"), "component"), "simhash-of-fp")
    kept = F.lit(True)
    for column in ROW:
        kept &= F.col("best")[column] == F.col(column)
    return rows.join(groups, "fp").select(
        *ROW, F.col("key").alias(key), "fp", "component", F.col("best.key").alias("component_id"), kept.alias("kept")
    )
