"""Vector links and groups against comparing all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from supportlens.llm import vectors

SCHEMA = "vec_id long, embedding array<{}>, label int, id int, n int, vector string, cell int"


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(k, v, 0, 1, 2, "v", 3) for k, v in rows], SCHEMA.format(kind))


def brute(rows, threshold=0.95):
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in good:
        for b in good:
            x, y = rows[a][1], rows[b][1]
            if a != b and len(x) == len(y):
                x, y = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links[a].add(b)
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(links[i]), least, key == least))
    return sorted(out, key=str)


def run(spark, rows, kind="double"):
    got = vectors.near_duplicates(frame(spark, rows, kind)).select("vec_id", "n_links", "component_id", "kept")
    return sorted((tuple(r) for r in got.collect()), key=str)


def crowd(rng, count, dim, noise):
    base = rng.normal(size=(max(1, count // 6), dim))
    return (base[rng.integers(0, len(base), count)] + noise * rng.normal(size=(count, dim))).tolist()


@pytest.mark.parametrize("dim", [1, 5, 64])
def test_all_links_are_found(spark, monkeypatch, dim):
    monkeypatch.setattr(vectors, "CELL", 8)
    monkeypatch.setattr(vectors, "CHUNK", 16)
    rng = np.random.default_rng(dim)
    rows = list(enumerate(crowd(rng, 240, dim, 0.15)))
    assert run(spark, rows) == brute(rows)


def test_recall_of_a_small_budget(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 2)
    rng = np.random.default_rng(5)
    rows = list(enumerate(crowd(rng, 800, 64, 0.2)))
    got, want = run(spark, rows), brute(rows)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) > 0
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("rank, noise", [(4, 0.0), (6, 0.02)])
def test_no_link_of_low_rank_vectors_is_lost(spark, monkeypatch, rank, noise):
    monkeypatch.setattr(vectors, "CELL", 12)
    rng = np.random.default_rng(rank)
    points = rng.normal(size=(3000, rank)) @ rng.normal(size=(rank, 64)) + noise * rng.normal(size=(3000, 64))
    got = dict(r[:2] for r in run(spark, list(enumerate(points.tolist()))))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    want = (points @ points.T >= 0.95).sum(axis=1) - 1
    assert want.sum() > 0 and [got[i] for i in range(len(points))] == want.tolist()


def test_unusable_equal_scaled_and_repeated_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (9, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [2e300, 4e300]), (5, [1e-300, 2e-300]),
        (6, None), (7, []), (8, [0.0, 0.0]), (10, [1.0, None]), (11, [nan, 1.0]), (12, [inf, 1.0]), (13, [-1.0, -2.0]),
        (14, [1.0, 2.0, 0.0]), (2, [1.0, 2.0, 0.0]), (None, None), (15, [-0.0, 3.0]), (16, [0.0, 3.0]),
    ]
    assert run(spark, rows) == brute(rows)


def test_floats_and_one_large_group_of_copies(spark):
    rng = np.random.default_rng(2)
    one = np.float32(rng.normal(size=8)).tolist()
    rows = [(i, one if i % 3 == 0 else np.float32(rng.normal(size=8)).tolist()) for i in range(300)]
    assert run(spark, rows, "float") == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, None)]])
def test_empty_and_null_tables(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_the_traversal_visits_cells_in_order():
    rng = np.random.default_rng(1)
    first, second = rng.random(7), rng.random(5)
    index = vectors.MultiIndex((np.zeros((7, 1)), np.zeros((5, 1))), 0.8)
    got = index.visits(first, second)
    sums = (first[:, None] + second[None]).ravel()
    assert sorted(got) == np.flatnonzero(sums <= 0.8).tolist()
    assert (np.diff(sums[got]) >= 0).all()


def test_tiles_parts_and_places(spark, monkeypatch):
    for name, value in (("CELL", 8), ("CHUNK", 4), ("TILE_LEAST", 20), ("TILE_CELLS", 3), ("VISITORS", 3), ("VISITS", 5)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(3)
    rows = list(enumerate(crowd(rng, 300, 6, 0.1) + (1.0 + 0.001 * rng.random((60, 6))).tolist()))
    # Tiles of 24 vectors, of which the sixty near copies are a cell.
    monkeypatch.setattr(vectors, "TILE_BYTES", 24 * 6 * 8)
    assert run(spark, rows) == brute(rows)


def test_a_vector_travels_once_to_a_tile_however_many_cells_it_visits(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 8)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1000, 16))
    classes = spark.createDataFrame([(i, 1, v) for i, v in enumerate(points.tolist())], "id long, n long, vector array<double>")
    sent = []
    monkeypatch.setattr(vectors, "_linked", lambda parcels, *_: sent.append(parcels) or classes.selectExpr("id", "n", "id AS label"))
    vectors.near_duplicates(classes.selectExpr("id AS vec_id", "vector AS embedding"))
    held, guests = (sent[0].filter(f).selectExpr("coalesce(sum(length(ids)), 0) / 8").first()[0] for f in ("NOT visitor", "visitor"))
    assert held == len(points) <= guests <= 2 * len(points)
    cells = sent[0].filter("NOT visitor").select("cell").distinct().count()
    assert cells > 20


def test_rows_of_large_values_are_few_in_a_batch_and_a_row_group(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from supportlens.session import ARROW_BYTES, HEAVY, written

    def run(batches):
        for batch in batches:
            assert batch.nbytes < 2 * HEAVY
            random = np.random.default_rng(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([random.bytes(640_000) for _ in range(batch.num_rows)], pa.binary())], batch.schema.names)

    rows = spark.range(0, 40, 1, 1).select("id", F.expr("cast(repeat('x', 640000) AS binary)").alias("value"))
    stored = written(rows.mapInArrow(run, rows.schema), "heavy", heavy=True)
    assert stored.count() == 40 and spark.conf.get(ARROW_BYTES, None) is None
    groups = [f.metadata.row_group(i).num_rows for path in stored.inputFiles() for f in [pq.ParquetFile(path.removeprefix("file://"))] for i in range(f.num_row_groups)]
    assert sum(groups) == 40 and max(groups) < 20
