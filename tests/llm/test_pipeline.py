"""The pipeline's stages against brute force, each on its own input."""

from __future__ import annotations

import math
import re

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from supportlens.llm import mixing
from tests.llm.test_packing import check
from tests.llm.test_simhash import groups, slow_fingerprint


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def stages(spark, docs, folder):
    out = [docs]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, out[-1], "").write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    ids = F.max("doc_id")
    extra = docs.limit(6).withColumn("text", F.expr("element_at(array(null, '', ' 1!', 'the same', 'the  same', 'the same'), cast(monotonically_increasing_id() as int) + 1)"))
    extra = extra.withColumn("doc_id", F.monotonically_increasing_id() + docs.agg(ids).first()[0] + 1).withColumn("lang", F.lit(None).cast("string"))
    docs.select("*").unionByName(extra).write.parquet(f"{tmp_path}/in")
    start = spark.read.parquet(f"{tmp_path}/in")
    first, told, single, distinct, mix, pieces = stages(spark, start, str(tmp_path))
    for df in (told, single, distinct, mix):
        assert df.columns == docs.columns

    assert rows(told) == [r for r in rows(first) if any(c.isalpha() for c in r[1] or "")]

    best = {}
    for r in rows(told):
        best.setdefault(bare(r[1]), []).append((-len(r[1]), r[0], r))
    assert rows(single) == sorted((min(g)[2] for g in best.values()), key=str)

    left = rows(single)
    labels = groups([slow_fingerprint(r[1]) for r in left])
    nearest = {}
    for r, label in zip(left, labels, strict=True):
        nearest[label] = min(nearest.get(label, r), r)
    assert rows(distinct) == sorted(nearest.values(), key=str)

    plan = mixing.plan_mix(distinct, F.array("source"))
    taken = {}
    for r in rows(mix):
        taken[r[0]] = taken.get(r[0], 0) + 1
    words = {r[0]: (r[3], len(re.findall(mixing.WORD, r[1]))) for r in rows(distinct)}
    longest = max(n for _, n in words.values())
    for s in plan.sources:
        got = sum(taken.get(k, 0) * n for k, (source, n) in words.items() if source == s["source"])
        assert math.isclose(got, s["target"], abs_tol=longest) and s["size"] == sum(n for source, n in words.values() if source == s["source"])
    assert max(taken.values()) <= 3

    tokens, sequences = check_copies(rows(mix), pieces.collect())
    assert sequences * 2048 <= tokens * 1.03


def check_copies(mixed, got):
    """Like ``check``; a document that was taken twice has each piece twice."""
    return check(got, [(r[0], r[1]) for r in mixed], 2048)


def test_stages_leave_columns_with_clashing_names_alone(spark, tmp_path):
    names = ["lang_pred", "score", "key", "size", "kept", "component", "name", "part", "rank", "hash", "fp"]
    rows = [(1, "the cat sat on the mat", "en", "a"), (2, "the dog ran to the park", "en", "b"), (3, "der hund lief", "de", "a"), (None, "el gato", None, None), (3, "der hund lief", "de", "a")]
    docs = spark.createDataFrame([(*r, *names) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names))
    docs.write.parquet(f"{tmp_path}/in")
    out = stages(spark, spark.read.parquet(f"{tmp_path}/in"), str(tmp_path / "out"))
    for df in out[:-1]:
        assert df.columns == docs.columns and all(tuple(r)[4:] == tuple(names) for r in df.collect())
    assert [df.count() for df in out[:4]] == [5, 5, 4, 4]


def test_run_and_an_empty_table(spark, small_dir, tmp_path):
    got = pipeline.run(spark, small_dir)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(got.columns) and got.count() > 0
    spark.read.parquet(f"{small_dir}/documents.parquet").filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
