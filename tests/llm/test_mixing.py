"""The mix against its definition, and the flow against all ways to route small numbers."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from supportlens.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, _llm_size int, members int, key string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, s, 1, 2, 3, "k") for k, t, s in rows], SCHEMA)


def plan(spark, rows, **more):
    return mixing.plan_mix(frame(spark, rows), F.array("source"), **more)


def test_targets_are_capped_and_reshared():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 300, 3) == pytest.approx([187.5, 75, 37.5])
    assert mixing.targets([10, 200, 90], [5, 2, 1], 300, 3) == pytest.approx([30, 180, 90])
    assert mixing.targets([0, 10, 10], [5, 2, 1], 20, 3) == pytest.approx([0, 40 / 3, 20 / 3])
    assert mixing.targets([], [], 0, 3) == []


def test_the_flow_is_the_cheapest():
    chance = random.Random(5)
    for _ in range(30):
        patterns = [(m, chance.randint(0, 3)) for m in ([0], [1], [0, 1])]
        quotas = [chance.randint(0, 5), chance.randint(0, 5)]

        def cost(taken, patterns=patterns):
            return sum(sum(c * min(max(t - size * u, 0), size) for u, c in enumerate((0, 1, 3))) for t, (_, size) in zip(taken, patterns, strict=True))

        flows = mixing.route(patterns, quotas)
        got = [sum(f.values()) for f in flows]
        best = None
        for a, b, c0, c1 in itertools.product(*[range(3 * patterns[i][1] + 1) for i in (0, 1, 2, 2)]):
            if c0 + c1 <= 3 * patterns[2][1] and a + c0 <= quotas[0] and b + c1 <= quotas[1]:
                value = (-(a + b + c0 + c1), cost([a, b, c0 + c1]))
                best = value if best is None else min(best, value)
        assert (-sum(got), cost(got)) == best
        assert all(sum(f.get(j, 0) for f in flows) <= q for j, q in enumerate(quotas))


def test_taken_words_follow_the_seeded_order(spark):
    chance = random.Random(2)
    rows = [(i, "w " * chance.randint(0, 40), chance.choice(["a", "b", "B", None])) for i in range(400)]
    found = plan(spark, rows)
    got = found.marked.withColumn("places", F.array(*[mixing._place(k) for k in range(3)])).collect()
    sizes = {k: len(re.findall(mixing.WORD, t)) for k, t, _ in rows}
    source = {k: s for k, _, s in rows}
    assert [s["source"] for s in found.sources] == ["B", "a", "b", None]
    for s in found.sources:
        mine = sorted((tuple(r["places"]), r["doc_id"], r["_llm_copies"]) for r in got if source[r["doc_id"]] == s["source"])
        assert sum(sizes[k] for _, k, _ in mine) == s["size"] and all(r["_llm_size"] == sizes[r["doc_id"]] for r in got)
        low = min(c for *_, c in mine)
        more = [c - low for *_, c in mine]
        assert more == sorted(more, reverse=True) and set(more) <= {0, 1} and low + max(more) <= 3
        prefix = list(itertools.accumulate((sizes[k] for _, k, _ in mine), initial=0))
        rest = round(s["target"]) - low * s["size"]
        assert abs(prefix[sum(more)] - rest) <= min(abs(x - rest) for x in prefix) + 1
    again = plan(spark, rows[::-1])
    assert sorted((r["doc_id"], r["_llm_copies"]) for r in again.marked.collect()) == sorted((r["doc_id"], r["_llm_copies"]) for r in got)


def test_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, "w w w", m) for i, m in enumerate([["a"], ["a", "b"], ["b", "a", "a"], [], None, ["b"]] * 20)], "doc_id long, text string, m array<string>")
    found = mixing.plan_mix(docs, F.col("m"), {"a": 3, "b": 1}, share=0.5)
    assert found.patterns == [(), ("a",), ("a", "b"), ("b",)]
    assert [round(s["target"]) for s in found.sources] == [s["routed"] for s in found.sources]
    taken = {r["_llm_pattern"]: r["n"] for r in found.marked.groupBy("_llm_pattern").agg(F.sum(F.col("_llm_size") * F.col("_llm_copies")).alias("n")).collect()}
    assert taken[0] == 0 and abs(sum(taken.values()) - 180) <= 9


def test_repeated_rows_keep_their_columns(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "x"), (3, "c " * 50, "y")]
    docs = frame(spark, rows)
    found = plan(spark, rows)
    out = found.repeated(docs)
    assert out.columns == docs.columns
    want = {}
    for r in found.marked.collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["_llm_copies"]
    got = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: n for k, n in want.items() if n}


def test_empty_table(spark):
    found = plan(spark, [])
    assert found.marked.count() == 0 and found.repeated(frame(spark, [])).count() == 0
