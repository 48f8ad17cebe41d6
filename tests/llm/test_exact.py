"""Exact duplicates against a dictionary of whole texts."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from supportlens.llm.exact import exact_duplicates

SCHEMA = "doc_id long, text string, name string, `n` int, kept string"


def brute(rows):
    groups = {}
    for i, (key, text) in enumerate(rows):
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(bare, []).append((-len(text or ""), key is None, key, i))
    out = []
    for bare, members in groups.items():
        best = min(members)
        for m in members:
            out.append((m[2], best[2], len(members), m == best, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, block):
    df = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in rows], SCHEMA)
    found = exact_duplicates(df, block=block).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_nulls_blanks_ties_long_texts_and_repeated_rows(spark):
    long = "".join(random.Random(1).choices("ab cé\U0001f600", k=150))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a b"), (7, "a b"), (None, "ab   c"),
        (None, "abc"), (8, long), (9, long + "x"), (10, long.replace(" ", "\u000b")), (11, "a b"), (12, "a b"),
        (13, "x" * 64), (14, "x" * 65), (15, "x" * 128), (16, "x" * 127 + "y"), (17, "x" * 128),
    ]
    got = run(spark, rows, 8)
    # Rows with a null key can't be ordered by it; which of two equal rows stays shows in nothing else.
    assert got == brute(rows)


def test_small_blocks_at_random(spark):
    chance = random.Random(7)
    rows = [(i, "".join(chance.choices("ab ", k=chance.randint(0, 9)))) for i in range(300)]
    assert run(spark, rows, 2) == brute(rows)


def test_blocks_with_equal_hashes_are_told_apart(spark, monkeypatch):
    import supportlens.llm.exact as exact

    real = F.xxhash64

    def weak(*columns):
        return F.length("block").cast("long") if isinstance(columns[0], str) and columns == ("block",) else real(*columns)

    monkeypatch.setattr(exact.F, "xxhash64", weak)
    chance = random.Random(3)
    rows = [(i, "".join(chance.choices("ab ", k=chance.randint(0, 9)))) for i in range(120)]
    assert run(spark, rows, 3) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_empty_and_null_tables(spark, rows):
    assert run(spark, rows, 4) == brute(rows)
