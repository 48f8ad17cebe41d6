"""Importance resampling of documents towards a target distribution.

Runs of words are hashed into buckets, counted over all documents and all target texts. A bucket's gain is the
rounded log ratio of its shares; a document's weight is the sum of the gains of its runs, looked up in one array. With
a Gumbel number from the hash of the key added, the highest scores are a sample without replacement.

The cutoff is found by weighted medians of medians: batches give the medians of their remaining scores, each task the
median of those weighted by the sizes, and the driver that of the tasks. At least an eighth of what remains lies on
either side of such a pivot, so counting the scores up to it discards that much, until the pivot is the cutoff. One
pass counts and finds the medians of both sides; the remaining scores are written anew when they have halved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.llm.rows import ROW, identified, numbered
from supportlens.session import written

BUCKETS, SCALE, LEAST_WORDS, PERCENT, SEED = 10_000, 1000, 20, 5, 42
#: Digits, letters and all bytes of other characters; A to Z lower-cased, anything else a blank.
_ONLY_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of text whose words are held at once.
PART = 1 << 20


def word_parts(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, a part at a time."""
    data = (text or "").encode("utf-8", "replace").translate(_ONLY_WORDS)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + PART)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def features(text: str | None, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and the buckets of all runs of one to three words, a part of the text at a time.

    The hash of a longer run goes on from that of the shorter one, so no run is put together.
    """
    singles: list[int] = []
    pairs: list[int] = []
    for words in word_parts(text):
        if not words:
            continue
        after = [b" " + w for w in words]
        last, before = singles[-1:], pairs[-1:]
        singles = list(map(crc32, words))
        pairs = list(map(crc32, after if last else after[1:], last + singles))
        triples = list(map(crc32, after[len(words) - len(pairs) + (0 if before else 1) :], before + pairs))
        yield len(words), np.fromiter(singles + pairs + triples, np.int64) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of a one-column table; the tasks count before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for _, at in features(value.as_py(), buckets):
                    found += np.bincount(at, minlength=buckets)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: the log ratio of its share of the target and of the source, each bucket counted once more."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    ratio = ((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)) for a, b in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def noise(key: object, seed: int = SEED) -> int:
    """A rounded Gumbel number that the key decides; a null key counts as empty."""
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Identity, ``key``, ``n_words``, ``n_features``, ``weight`` and ``score`` of the rows of an ``identified`` table."""
    rows = docs.select(*ROW, F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    more = ["n_words", "n_features", "weight", "score"]
    schema = rows.drop("text").withColumns({c: F.lit(0).cast("long") for c in more}).schema
    table = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = table.value
        for batch in batches:
            found = np.zeros((4, batch.num_rows), np.int64)
            for i, (k, value) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                for words, at in features(value.as_py(), len(of)):
                    found[:3, i] += words, len(at), of[at].sum()
                found[3, i] = found[2, i] + noise(k.as_py(), seed)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, found)], [*ROW, "key", *more])

    return rows.mapInArrow(run, schema)


def weighted_median(found: list[tuple[tuple, int]]) -> tuple:
    """The first value up to which the values have half of the weight."""
    found = sorted(found)
    left = sum(n for _, n in found) / 2
    for value, n in found:
        left -= n
        if left <= 0:
            return value
    raise ValueError("no values")


@dataclass(frozen=True)
class Remaining:
    """Rows between two bounds, of which ``n`` are left; both bounds themselves are out."""

    rows: DataFrame
    n: int
    low: tuple | None = None
    high: tuple | None = None

    def between(self) -> DataFrame:
        """The rows themselves, compared where they are stored; the first column also by itself, for the scan."""
        columns, out = self.rows.columns, self.rows

        def bound(values: tuple):
            return F.struct(*[F.lit(v).cast(self.rows.schema[c].dataType).alias(c) for c, v in zip(columns, values, strict=True)])

        if self.low is not None:
            out = out.filter((F.col(columns[0]) >= self.low[0]) & (F.struct(*columns) > bound(self.low)))
        if self.high is not None:
            out = out.filter((F.col(columns[0]) <= self.high[0]) & (F.struct(*columns) < bound(self.high)))
        return out


def medians(left: DataFrame, pivot: tuple | None) -> tuple[int, list, list]:
    """How many rows are up to ``pivot``, and per task the weighted medians of the rows below and above it."""
    columns = left.columns
    schema = "side int, size long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles, sizes = ([], []), [0, 0]
        types = None
        for batch in batches:
            types = batch.schema.types
            rows = sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            upto = [r for r in rows if pivot is not None and r <= pivot]
            sizes[0] += len(upto)
            below, above = upto[:-1] if upto and upto[-1] == pivot else upto, rows[len(upto) :]
            for side, some in enumerate((below, above)):
                if some:
                    middles[side].append((some[(len(some) - 1) // 2], len(some)))
        out = [(side, sum(n for _, n in m), *weighted_median(m)) for side, m in enumerate(middles) if m]
        if types and (out or sizes[0]):
            # A row of its own carries the count, with any values.
            out.append((2, sizes[0], *((out[0][2:]) if out else pivot)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.int64(), *types])], ["side", "size", *columns]
            )

    got = [tuple(r) for r in left.mapInArrow(run, schema).collect()]
    return sum(r[1] for r in got if r[0] == 2), *[[(r[2:], r[1]) for r in got if r[0] == side] for side in (0, 1)]


def nth(rows: DataFrame, n: int, total: int) -> tuple:
    """The ``n``-th smallest row (from 1) of a written table of different rows without nulls, of which there are ``total``."""
    left, found = Remaining(rows, total), medians(rows, None)
    side = found[2]
    while True:
        pivot = weighted_median(side)
        upto, below, above = medians(left.between(), pivot)
        if upto == n:
            return pivot
        if upto > n:
            left, side = Remaining(left.rows, upto - 1, left.low, pivot), below
        else:
            left, side, n = Remaining(left.rows, left.n - upto, pivot, left.high), above, n - upto
        if 2 * left.n <= total:
            left, total = Remaining(written(left.between(), "resample-left"), left.n), left.n


def resampled(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_features``, ``weight``, ``score`` and ``rank``, from 1 on for those
    that are drawn: the best ``percent`` of the rows with enough words, rounded down.

    Null texts have no words. Equal scores go by key, rows without one last, then by stored row, so that repeated rows
    are rows of their own. An empty table gives an empty result. Other columns are neither read nor returned.
    """
    rows = identified(docs)
    gain = gains(bucket_counts(docs.select(F.col(f"`{text}`"))), bucket_counts(target.select(F.col(f"`{target_text}`"))))
    found = written(scored(rows, gain, key, text, seed), "resample-scored")
    kind = found.schema["key"].dataType
    order = {
        "score": -F.col("score"), "missing": F.col("key").isNull(), "key": F.coalesce("key", F.lit(0).cast(kind)),
        **{c: F.col(c) for c in ROW},
    }
    able = found.filter(F.col("n_words") >= least_words).select(*[c.alias(n) for n, c in order.items()])
    total = able.count()
    drawn = total * percent // 100
    none = F.lit(None).cast("long")
    if not drawn:
        return found.select(F.col("key").alias(key), "n_features", "weight", "score", none.alias("rank"))
    cutoff = nth(written(able, "resample-able"), drawn, total)
    upto = Remaining(able, drawn, None, cutoff[:-1] + (cutoff[-1] + 1,)).between()
    best = numbered(upto, F.lit(0), list(order), "resample-drawn").select(*ROW, (F.col("i") + 1).alias("rank"))
    return found.join(best, list(ROW), "left").select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
