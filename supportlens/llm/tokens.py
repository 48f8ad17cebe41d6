"""Token counts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens.

The tokenizer drops white space and merges nothing across it, so the tokens of a text are those of its pre-tokens,
the runs between blanks. The lengths of the most frequent ones are looked up in a compact table that is broadcast;
a miss goes to the cache of the Python worker, and what isn't there either is encoded by the tokenizer itself.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of the broadcast table, documents it is fitted on at most, entries of a worker's cache.
FREQUENT, SAMPLE, CACHED = 1 << 16, 4000, 400_000
LIMIT = 2048


@cache
def tokenizer(path: str):
    """The tokenizer of a file, once in each process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Cache(dict):
    """Computed values, of which the recently used are kept: at most twice ``size``."""

    def __init__(self, compute: Callable, size: int = CACHED):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class TwoTier(dict):
    """A table of values whose misses go to a cache."""

    def __init__(self, table: dict, behind: Cache):
        super().__init__(table)
        self.behind = behind

    def __missing__(self, key):
        return self.behind[key]


def pre_tokens(text: bytes) -> list[bytes]:
    """Runs between blanks. A to Z are lower-cased, as the tokenizer does, unless a special string may be among them."""
    return (text if b"<|" in text else text.lower()).split()


@cache
def lengths(path: str) -> Cache:
    """The worker's cache of pre-token lengths."""
    encode = tokenizer(path).encode
    return Cache(lambda word: len(encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids))


def frequent(docs: DataFrame, path: str, text: str = "text") -> dict[bytes, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample; what isn't among them only costs time."""
    total = docs.count()
    share = int((1 << 20) * min(1.0, SAMPLE / max(total, 1))) + 1
    sample = docs.filter(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share).select(F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for value in batch.column(0):
                found.update(pre_tokens((value.as_py() or "").encode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    counted = sample.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = [bytes(r["word"]) for r in counted.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    return {w: lengths(path)[w] for w in words}


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Null texts count as empty: no bytes, no tokens. Whole texts are counted, without begin and end tokens; special
    strings inside a text are handled as the tokenizer does by default. Repeated rows are counted each; an empty
    table gives an empty result. The three columns replace ones of the same name.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, path, text))
    others = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.col(text), F.lit("")).alias("_llm_text"))
    schema = rows.drop("_llm_text").withColumns(
        {"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long"), "over_limit": F.lit(False)}
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = TwoTier(table.value, lengths(path)).__getitem__
        for batch in batches:
            sizes, numbers = [], []
            for value in batch.column(batch.num_columns - 1):
                data = value.as_py().encode("utf-8", "replace")
                sizes.append(len(data))
                numbers.append(sum(map(length, pre_tokens(data))))
            over = [n > limit for n in numbers]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64()), pa.array(over, pa.bool_())],
                [*others, "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(run, schema)
