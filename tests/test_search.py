"""Text and vector search against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from supportlens.functions.text import term_counts
from supportlens.operators import text_index, vector_search
from supportlens.plans.routing import route_questions
from supportlens.session import new_dir


def test_term_counts(spark):
    rows = [(1, "B a, b; C-a b"), (2, ""), (3, None), (4, "12 ..."), (5, "Été été")]
    df = spark.createDataFrame(rows, "id int, t string").select("id", term_counts(F.col("t")).alias("c"))
    found = {r.id: [(c.term, c.tf) for c in r.c] for r in df.collect()}
    assert found == {1: [("a", 2), ("b", 3), ("c", 1)], 2: [], 3: [], 4: [], 5: [("été", 2)]}


def brute_scores(texts: dict, query: str) -> dict:
    def counts(text):
        out = {}
        for w in re.findall(r"[a-z]+", text.lower()):
            out[w] = out.get(w, 0) + 1
        return out

    docs = {k: counts(t) for k, t in texts.items()}
    asked = counts(query)
    df = {w: sum(w in d for d in docs.values()) for w in asked}
    weights = {w: (1 + math.log(n)) * math.log(len(docs) / df[w]) for w, n in asked.items() if df[w]}
    length = math.sqrt(sum(x * x for x in weights.values()))
    result = {}
    for k, d in docs.items():
        norm = math.sqrt(sum((1 + math.log(n)) ** 2 for n in d.values()))
        shared = [w for w in weights if w in d and weights[w] > 0]
        if shared:
            result[k] = sum(weights[w] * (1 + math.log(d[w])) / norm for w in shared) / length
    return result


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    # "hot" is in every third text and "all" in each of them.
    return {i: " ".join(["all"] + (["hot"] if i % 3 == 0 else []) + rng.choices(words, k=rng.randint(1, 40))) for i in range(300)}


@pytest.fixture(scope="module")
def index(spark, corpus):
    docs = spark.createDataFrame(list(corpus.items()), "id bigint, body string")
    return text_index.write_index(docs, "id", "body", new_dir(spark, "test-index"))


@pytest.mark.parametrize("query", ["waa wab hot", "hot hot all", "wcc", "waa waa waa wbh unknown", " ".join(["wad"] * 30 + ["all"])])
def test_scores_equal_brute_force(index, corpus, query):
    found = {r.id: r.search_score for r in text_index.scores(index, query).collect()}
    expected = brute_scores(corpus, query)
    assert set(found) == set(expected)
    assert all(abs(found[k] - expected[k]) < 2e-6 for k in found)


@pytest.mark.parametrize("query", ["", "all", "unheardof", "123"])
def test_queries_without_weight_find_nothing(index, query):
    assert text_index.search(index, query, 5).count() == 0


def test_long_query_text(index, corpus):
    query = " ".join(f"none{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(700)) + " waa wab"
    found = {r.id: r.search_score for r in text_index.scores(index, query).collect()}
    assert set(found) == set(brute_scores(corpus, query))


def test_filter_applies_before_the_cut(spark, index, corpus):
    everything = spark.createDataFrame([(k,) for k in corpus], "id bigint")
    free = [tuple(r) for r in text_index.search(index, "waa hot", 7).collect()]
    assert [tuple(r) for r in text_index.search(index, "waa hot", 7, candidates=everything).collect()] == free
    odd = spark.createDataFrame([(k,) for k in corpus if k % 2], "id bigint")
    expected = sorted(((-round(s, 6), k) for k, s in brute_scores(corpus, "waa hot").items() if k % 2))[:7]
    assert [r.id for r in text_index.search(index, "waa hot", 7, candidates=odd).collect()] == [k for _, k in expected]


def test_a_text_finds_itself(spark, index, corpus):
    source = spark.createDataFrame(list(corpus.items()), "id bigint, body string")
    best = text_index.search(index, corpus[17], 1, source=source).first()
    assert best.id == 17 and best.body == corpus[17]


def test_more_results_than_fit_a_list_of_keys(spark, index, corpus, monkeypatch):
    source = spark.createDataFrame(list(corpus.items()), "id bigint, body string")
    short = [tuple(r) for r in text_index.search(index, "waa hot", 8, source=source).collect()]
    monkeypatch.setattr(text_index, "MAX_INLINE", 4)
    assert [tuple(r) for r in text_index.search(index, "waa hot", 8, source=source).collect()] == short


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def clustered(n: int, dims: int, hot_share: float, seed: int):
    """Vectors around four centres, one of which attracts ``hot_share`` of them."""
    rng = np.random.default_rng(seed)
    centres = unit(rng.normal(size=(4, dims)))
    label = np.where(rng.random(n) < hot_share, 0, rng.integers(1, 4, n))
    return unit(centres[label] + 0.15 * rng.normal(size=(n, dims))), label


def frame(spark, vectors, labels, first=0):
    rows = [(first + i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, "id bigint, v array<double>, label int")


def brute_neighbours(queries, index, k, exclude_self):
    scores = np.round(queries @ index.T, 6)
    result = set()
    for i, row in enumerate(scores):
        order = sorted((-s, j) for j, s in enumerate(row) if not (exclude_self and i == j))[:k]
        result |= {(i, j, r + 1) for r, (_, j) in enumerate(order)}
    return result


def pairs(df):
    return {(r.query_id, r.neighbour_id, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("chunk", [64, 4096])
def test_exact_neighbours_with_a_hot_list(spark, monkeypatch, chunk):
    monkeypatch.setattr(vector_search, "CHUNK", chunk)
    vectors, labels = clustered(400, 8, 0.5, 3)
    df = frame(spark, vectors, labels)
    found = vector_search.knn_exact(df, df, "id", "v", "label", k=4, exclude_self=True)
    assert pairs(found) == brute_neighbours(vectors, vectors, 4, True)


def test_exact_neighbours_of_other_vectors(spark):
    # Queries far from every list, and fewer rows in a list than asked for.
    vectors, labels = clustered(60, 6, 0.9, 4)
    queries = unit(np.random.default_rng(9).normal(size=(25, 6)))
    found = vector_search.knn_exact(frame(spark, queries, [0] * 25), frame(spark, vectors, labels), "id", "v", "label", k=10)
    assert pairs(found) == brute_neighbours(queries, vectors, 10, False)


@pytest.mark.parametrize("without", [lambda i: i % 5 == 0, lambda i: True])
def test_rows_without_a_list_are_neighbours(spark, without):
    vectors, labels = clustered(120, 8, 0.5, 5)
    rows = [(i, [float(x) for x in v], None if without(i) else int(label)) for i, (v, label) in enumerate(zip(vectors, labels, strict=True))]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    assert pairs(vector_search.knn_exact(df, df, "id", "v", "label", k=4, exclude_self=True)) == brute_neighbours(vectors, vectors, 4, True)
    found = vector_search.knn_approximate(df, df, "id", "v", "label", k=4, probes=8, exclude_self=True)
    assert pairs(found) == brute_neighbours(vectors, vectors, 4, True)


def test_second_round_skips_cells_that_are_too_far(spark):
    vectors, labels = clustered(400, 8, 0.4, 6)
    _, lists = vector_search.place_in_lists(frame(spark, vectors, labels), "id", "v", "label")
    assert lists.sizes.sum() == 400
    cosines = np.clip(vectors @ lists.centroids.T, -1, 1)
    kept = vector_search._still_possible(lists)(cosines, np.ones(400), np.full(400, 0.9))
    assert kept.sum() < kept.size / 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_neighbours_of_vectors_of_any_length(spark, seed):
    rng = np.random.default_rng(seed)
    vectors, labels = clustered(150, 5, 0.5, seed)
    vectors = vectors * rng.choice([0.01, 0.5, 1.0, 2.0, 40.0], size=(150, 1))
    queries = rng.normal(size=(40, 5)) * rng.choice([0.1, 1.0, 30.0], size=(40, 1))
    found = vector_search.knn_exact(frame(spark, queries, [0] * 40), frame(spark, vectors, labels), "id", "v", "label", k=4)
    assert pairs(found) == brute_neighbours(queries, vectors, 4, False)


def test_the_longest_vector_of_another_list_is_found(spark):
    index = spark.createDataFrame([(1, [0.6, 0.8], 0), (2, [0.0, 1.0], 0), (3, [2.0, 0.0], 1)], "id long, v array<double>, label int")
    asked = spark.createDataFrame([(9, [0.6, 0.8])], "id long, v array<double>")
    best = vector_search.knn_exact(asked, index, "id", "v", "label", k=1).first()
    assert (best["neighbour_id"], best["search_score"]) == (3, 1.2)
    # All scores negative: the shortest is the best one.
    index = spark.createDataFrame([(1, [-3.0, 0.0], 0), (2, [-1.0, 0.0], 1), (3, [-2.0, 0.0], 1)], "id long, v array<double>, label int")
    asked = spark.createDataFrame([(9, [1.0, 0.0])], "id long, v array<double>")
    assert vector_search.knn_exact(asked, index, "id", "v", "label", k=1).first()["neighbour_id"] == 2


def test_rows_that_cannot_be_compared_are_neither_asked_nor_found(spark):
    vectors, labels = clustered(60, 4, 0.5, 13)
    rows = [(i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels, strict=True))]
    odd = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan"), 0.0, 0.0, 1.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 0.0], [1.0] * 9]
    df = spark.createDataFrame(rows + [(100 + i, v, i % 3) for i, v in enumerate(odd)], "id long, v array<double>, label int")
    assert pairs(vector_search.knn_exact(df, df, "id", "v", "label", k=4, exclude_self=True)) == brute_neighbours(vectors, vectors, 4, True)
    found = vector_search.knn_approximate(df, df, "id", "v", "label", k=4, probes=9, exclude_self=True)
    assert pairs(found) == brute_neighbours(vectors, vectors, 4, True)
    assert vector_search.knn_exact(df.where("id >= 100"), df.where("id >= 100 AND v IS NULL"), "id", "v", "label").count() == 0


def test_more_lists_than_are_kept_apart(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "MAX_LISTS", 6)
    vectors, _ = clustered(80, 4, 0.5, 14)
    df = frame(spark, vectors, range(80))
    assert pairs(vector_search.knn_exact(df, df, "id", "v", "label", k=3)) == brute_neighbours(vectors, vectors, 3, False)


def test_probing_all_lists_is_exact(spark):
    vectors, labels = clustered(200, 8, 0.4, 7)
    df = frame(spark, vectors, labels)
    found = vector_search.knn_approximate(df, df, "id", "v", "label", k=3, probes=4)
    assert pairs(found) == brute_neighbours(vectors, vectors, 3, False)


def test_kmeans_lists_keep_every_row_and_the_exact_answer(spark):
    vectors, labels = clustered(150, 6, 0.4, 8)
    listed = vector_search.kmeans_lists(frame(spark, vectors, labels), "v", 5)
    assert listed.count() == 150
    found = vector_search.knn_exact(listed, listed, "id", "v", "list_id", k=3)
    assert pairs(found) == brute_neighbours(vectors, vectors, 3, False)


def test_lsh_finds_the_vector_itself(spark):
    vectors, labels = clustered(200, 8, 0.4, 10)
    found = vector_search.lsh_top_k(frame(spark, vectors, labels), "id", "v", [float(x) for x in vectors[11]], 3).collect()
    assert found[0].id == 11 and abs(found[0].search_score - 1) < 1e-6


def test_lsh_scores_are_exact_for_a_query_of_any_length(spark):
    vectors, labels = clustered(400, 16, 0.4, 12)
    df, queries = frame(spark, vectors, labels), [vectors.mean(axis=0), 3 * vectors[5], vectors[7] + vectors[9]]
    buckets = vector_search.lsh_buckets(df, "id", "v")
    assert buckets.count() == 400 * 8
    hits = 0
    for query in queries:
        scores = np.round(vectors @ query, 6)
        found = vector_search.lsh_top_k(df, "id", "v", [float(x) for x in query], 5, buckets).collect()
        assert all(abs(r.search_score - scores[r.id]) < 2e-6 for r in found)
        hits += len({r.id for r in found} & set(np.argsort(-scores, kind="stable")[:5].tolist()))
    assert hits >= 0.9 * 5 * len(queries)


def test_matching_is_not_limited(index, corpus):
    expected = {k for k, s in brute_scores(corpus, "waa hot").items() if round(s, 6) >= 0.1}
    assert len(expected) > 50
    assert {r.id for r in text_index.matching(index, "waa hot", 0.1).collect()} == expected


def test_the_manifest_describes_the_index(index, corpus):
    row = index.manifest.first()
    assert (row.documents, row.key_column, row.path) == (len(corpus), "id", index.path) and row.created_at is not None


def test_routing(spark):
    tools = spark.createDataFrame(
        [("money", "revenue of orders"), ("people", "customers and their churn"), ("both", "revenue of customers")],
        "tool string, comment string",
    )
    asked = spark.createDataFrame(
        [(1, "Show REVENUE orders orders"), (2, "which customers churn?"), (3, "hello"), (4, None)], "q int, text string"
    )
    found = {r.q: (r.tool, r.score) for r in route_questions(asked, ["q"], "text", tools).collect()}
    assert found[1][0] == "money" and found[2][0] == "people"
    assert found[3] == (None, 0.0) and found[4] == (None, 0.0)


@pytest.mark.parametrize("rows, exact", [(64, True), (8, True), (64, False)])
def test_a_query_goes_to_a_tile_once(spark, monkeypatch, rows, exact):
    # Sixteen lists, most of which each query has to probe: rows per query follow from the tiles, not from the lists.
    monkeypatch.setattr(vector_search, "TILE_MIN", rows)
    monkeypatch.setattr(vector_search, "TILE_MAX", rows)
    monkeypatch.setattr(vector_search, "STRIP", 24)
    vectors = unit(np.random.default_rng(31).normal(size=(256, 12)))
    df = frame(spark, vectors, np.arange(256) % 16)
    if exact:
        assert pairs(vector_search.knn_exact(df, df, "id", "v", "label", k=3, exclude_self=True)) == brute_neighbours(vectors, vectors, 3, True)
        return
    placed, lists = vector_search.place_in_lists(df, "id", "v", "label")
    chosen = vector_search._choose_cells(df, "id", "v", lists, vector_search._nearest(lists, 12))
    assert len(lists.tiles.cells) == 4 and max(len(r["probes"]) for r in chosen.collect()) <= 4
    assert chosen.count() == 256
