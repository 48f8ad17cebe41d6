"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from supportlens.llm import resample

SCHEMA = "doc_id long, text string, score string, rank int, key string, n_words double"


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def buckets(texts):
    out = [0] * 10000
    for t in texts:
        for f in features(t)[1]:
            out[zlib.crc32(f.encode()) % 10000] += 1
    return out


def brute(rows, target):
    s, t = buckets(x[1] for x in rows), buckets(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10000) / ((a + 1) * (sum(t) + 10000)))) for a, b in zip(s, t, strict=True)]
    out = []
    for key, text in rows:
        words, found = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * 5 // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "k", 0.5) for r in rows], SCHEMA)


def random_rows(n, seed):
    draw = random.Random(seed)
    words = ["the", "The", "naïve", "cat-dog", "x9", "日本", "É", "a.b", "!!", "sat", "mat", "on", "it's"]
    return [(i - 5, " ".join(draw.choices(words, k=draw.randrange(60)))) for i in range(n)]


def test_equals_brute_force(spark):
    rows = [*random_rows(900, 1), (None, None), (7, ""), (7, " \n"), (None, "one two"), (8, "w " * 5000), (9, "x" * 100000)]
    target = ["the cat sat on the mat", None, "", "naïve 日本 x9"]
    targets = spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    got = resample.resampled(frame(spark, rows).repartition(7), targets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target)
    assert all(f.dataType.simpleString() == "bigint" for f in got.schema)


def test_repeated_rows_and_null_ids_are_drawn_one_by_one(spark):
    rows = [(3, "the cat sat on the mat " * 5)] * 60 + [(None, "the cat sat on the mat " * 5)] * 41 + random_rows(40, 2)
    targets = spark.createDataFrame([("the cat sat on the mat",)], "text string")
    got = resample.resampled(frame(spark, rows), targets).collect()
    able = sum(len(features(t)[0]) >= 20 for _, t in rows)
    assert len(got) == len(rows) and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, able * 5 // 100 + 1))


@pytest.mark.parametrize("part", [1, 7, 1 << 20])
def test_long_texts_are_read_in_parts(monkeypatch, part):
    monkeypatch.setattr(resample, "PART", part)
    for text in ("a bc def ghij klmno", "one", "a b", "", None, "w " * 50, "x" * 40 + " y " + "z" * 30):
        words, found = features(text)
        got = list(resample.features(text))
        assert sum(n for n, _ in got) == len(words)
        assert sorted(b for _, bs in got for b in bs.tolist()) == sorted(zlib.crc32(f.encode()) % 10000 for f in found)


@pytest.mark.parametrize("n", [1, 2, 37, 400, 999, 1000])
def test_selection_by_medians_is_exact(spark, tmp_path, n):
    draw = random.Random(4)
    rows = [(draw.choice([1, 2, 5]), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    df.write.parquet(str(tmp_path / "rows"))
    assert resample.nth(spark.read.parquet(str(tmp_path / "rows")), n, 1000) == sorted(rows)[n - 1]


def test_weighted_median():
    assert resample.weighted_median([((3,), 1), ((1,), 5), ((2,), 1)]) == (1,)
    assert resample.weighted_median([((3,), 2), ((1,), 1), ((2,), 2)]) == (2,)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert resample.resampled(frame(spark, []), none).count() == 0
    got = resample.resampled(frame(spark, [(1, "w " * 30)]), none).first()
    assert got["n_features"] == 87 and got["rank"] is None


def test_documents(spark, small_dir):
    docs, target = (spark.read.parquet(f"{small_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = resample.resampled(docs, target)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, [r["text"] for r in target.collect()])
    assert got.filter(F.col("rank").isNotNull()).count() > 0
