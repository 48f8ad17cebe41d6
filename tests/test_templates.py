"""Learned templates against a plain tree, and planted templates found again."""

from __future__ import annotations

import random
from collections import defaultdict

from supportlens.operators.templates import SLOT, learn_templates, slot_values
from tests.conftest import as_set


def brute(texts, variety, depth):
    paths = {}
    for t in set(texts):
        words = [w for w in t.split(" ") if w]
        paths[t] = (words[:depth] + [SLOT] * (len(words) > depth), ())
    for place in range(depth + 1):
        values = defaultdict(set)
        for words, path in paths.values():
            if len(words) > place:
                values[len(words), path].add(words[place])
        for t, (words, path) in paths.items():
            if len(words) > place:
                paths[t] = (words, (*path, SLOT if len(values[len(words), path]) > variety else words[place]))
    return {t: " ".join(path) for t, (_, path) in paths.items()}


def test_like_a_plain_tree(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(6))) for _ in range(400)] + ["a  b ", "", " ", "x " * 40]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "subject string")
    for variety, depth in ((2, 3), (5, 16)):
        got = {r["text"]: (r["n"], r["template"]) for r in learn_templates(df, "subject", variety, depth).collect()}
        assert got == {t: (texts.count(t), template) for t, template in brute(texts, variety, depth).items()}


def test_planted_templates_and_their_values(spark):
    rows = [f"Order {i} is late" for i in range(30)] + [f"Refund for order {i % 20} asked by user{i}" for i in range(60)] + ["Order is lost"] * 5
    learned = learn_templates(spark.createDataFrame([(r,) for r in rows], "s string"), "s")
    assert {r["template"] for r in learned.collect()} == {"Order <*> is late", "Refund for order <*> asked by <*>", "Order is lost"}
    values = as_set(slot_values(learned))
    assert len(values) == 30 + 20 + 60 and ("Refund for order <*> asked by <*>", 4, "7", 3) in values


def test_no_texts(spark):
    assert learn_templates(spark.createDataFrame([], "s string"), "s").count() == 0
    assert learn_templates(spark.createDataFrame([(None,)], "s string"), "s").count() == 0
