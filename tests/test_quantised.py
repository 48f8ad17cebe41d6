"""Product quantisation: recall against brute force, exact scores, every row indexed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from supportlens.operators import quantised, vector_search
from tests.test_search import brute_neighbours, clustered, frame, pairs


def recall(found, truth):
    return len({p[:2] for p in found} & {p[:2] for p in truth}) / len(truth)


@pytest.mark.parametrize("spread", ["clustered", "random", "any length"])
def test_a_calibrated_search_reaches_its_recall(spark, tmp_path, spread):
    rng = np.random.default_rng(5)
    vectors = clustered(900, 16, 0.4, 5)[0] if spread == "clustered" else rng.normal(size=(900, 16))
    if spread == "any length":
        vectors *= rng.choice([0.5, 1.0, 2.0], size=(900, 1))
    df = frame(spark, vectors, np.zeros(900))
    index = quantised.write_index(df, "id", "v", str(tmp_path / "index"))
    assert index.total == 900 and len(index.books.centroids) == 30
    probes, candidates = quantised.calibrate(index, 5, 0.95)
    found = quantised.search(index, df, "id", "v", 5, probes, candidates, exclude_self=True)
    assert recall(pairs(found), brute_neighbours(vectors, vectors, 5, True)) >= 0.9
    for r in found.limit(50).collect():
        assert r["search_score"] == pytest.approx(float(vectors[r["query_id"]] @ vectors[r["neighbour_id"]]), abs=1e-6)
    if spread == "clustered":
        assert quantised.scored_share(index, df, "id", "v", probes) < 0.8


def test_all_lists_and_candidates_are_exact(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quantised, "CHUNK", 16)
    vectors = np.random.default_rng(6).normal(size=(120, 6))
    df = frame(spark, vectors, np.zeros(120))
    index = quantised.write_index(df, "id", "v", str(tmp_path / "index"))
    found = quantised.search(index, df, "id", "v", 4, probes=1000, candidates=1000, exclude_self=True)
    assert pairs(found) == brute_neighbours(vectors, vectors, 4, True)


def test_codes_stand_for_close_vectors():
    rows = np.random.default_rng(7).normal(size=(2000, 8))
    words = quantised.trained(rows[:, :4], 256)
    assert len(words) == 256 and np.linalg.norm(rows[:, :4] - words[quantised.nearest(rows[:, :4], words)], axis=1).mean() < 0.6
    same = quantised.trained(np.ones((50, 3)), 4)
    assert same.tolist() == [[1.0, 1.0, 1.0]]


def test_odd_rows_and_empty_tables(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [0.5, 0.5]), (5, [float("nan"), 1.0]), (6, [1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    index = quantised.write_index(df, "id", "v", str(tmp_path / "index"))
    assert index.total == 2 and pairs(quantised.search(index, df, "id", "v", 3, 5, 10, exclude_self=True)) == {(1, 4, 1), (4, 1, 1)}
    none = quantised.write_index(df.where("id > 9"), "id", "v", str(tmp_path / "none"))
    assert quantised.calibrate(none, 5, 0.9) == (1, 5)
    assert quantised.search(none, df, "id", "v").count() == 0


def test_repeated_ids_stand_for_all_their_rows(spark, tmp_path):
    vectors = np.random.default_rng(8).normal(size=(12, 6))
    df = frame(spark, vectors, np.zeros(12))
    twice = df.union(df.where("id < 6"))
    index = quantised.write_index(twice, "id", "v", str(tmp_path / "index"))
    found = quantised.search(index, twice, "id", "v", 12, probes=1000, candidates=1000, exclude_self=True).collect()
    # Rows for a pair: those of the codes and questions that met, times those that its ids stand for.
    for q in range(12):
        want = []
        for n in sorted((n for n in range(12) if n != q), key=lambda n: -round(float(vectors[q] @ vectors[n]), 6)):
            want += [n] * ((2 if q < 6 else 1) * (2 if n < 6 else 1)) ** 2
        assert [r["neighbour_id"] for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])] == want[:12]


def test_a_tile_meets_its_queries_in_batches(spark):
    tiles = vector_search.Tiles(np.array([60, 40]))
    index = spark.createDataFrame([(i, [1.0, float(i)], i // 60) for i in range(100)], "neighbour_id long, vector array<double>, cell int")
    asked = spark.createDataFrame([(i, [1.0, 1.0], 0.0, [(0, b"\xc0")]) for i in range(300)], T.StructType([
        T.StructField("query_id", T.LongType()), T.StructField("query_vector", T.ArrayType(T.DoubleType())), T.StructField("least", T.DoubleType()), T.StructField("probes", vector_search.PROBES),
    ]))

    def score(first, cells, vectors):
        def answer(queries):
            yield pa.RecordBatch.from_arrays([pa.array([queries.num_rows]), pa.array([len(vectors)])], ["queries", "vectors"])

        return answer

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "50")
    try:
        got = vector_search.in_tiles(index, asked, tiles, score, T.StructType([T.StructField("queries", T.LongType()), T.StructField("vectors", T.LongType())])).collect()
    finally:
        spark.conf.unset(name)
    assert sum(r["queries"] for r in got) == 300 and max(r["queries"] for r in got) <= 50 and {r["vectors"] for r in got} == {100}
