"""Transcripts: Viterbi against all paths, markers, and how many roles are recovered."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from supportlens.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string, part int, style string, canonical string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "c") for r in rows], SCHEMA)


@pytest.mark.parametrize("line, want", [
    ("User: hi", ("user", "hi")), ("### Assistant", ("assistant", "")), ("[SYSTEM] be kind", ("system", "be kind")), ("**Human:** yes", ("user", "yes")),
    ("<|assistant|> x", ("assistant", "x")), ("A: 4", ("assistant", "4")), ("- so", ("unnamed", "so")), ("Note: this", ("none", "Note: this")),
    ("usual day", ("none", "usual day")), ("ai>", ("assistant", "")), ("", ("none", "")), ("A b", ("none", "A b")),
])
def test_markers(line, want):
    assert chat.marked(line) == want


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(20):
        moves = np.where(chat.allowed(), rng.random((7, 6)), 0)
        with np.errstate(divide="ignore"):
            model = chat.Hmm(np.log(moves), np.log(rng.random((6, len(chat.FEATURES)))))
        features = [rng.integers(0, len(chat.FEATURES), 4).tolist() for _ in range(4)]

        def weight(path, model=model, features=features):
            out, at = 0.0, chat.BEGIN
            for s, f in zip(path, features, strict=True):
                out, at = out + model.moves[at, s] + model.emits[s, f].sum(), s
            return out

        best = max(weight(p) for p in itertools.product(range(6), repeat=4))
        assert weight(model.viterbi(features)) == pytest.approx(best)


def test_roles_are_recovered(spark, small_dir):
    talks = chat.transcribed(spark.read.parquet(f"{small_dir}/conversations.parquet"))
    held = F.crc32(F.col("conv_id").cast("string")) % 7 == 2
    model = chat.train(talks.filter(~held))
    got = chat.parse(talks.filter(held).withColumn("want", F.array_join("turns.role", ",")), model).collect()
    assert len(got) > 5
    named = [r for r in got if r["style"] < 5]
    assert sum(r["roles"] == r["want"] for r in named) >= 0.95 * len(named)
    assert sum(r["roles"] == r["want"] for r in got) >= 0.75 * len(got)


def test_text_comes_back_in_canonical_form(spark):
    rows = [(i, t, r, x) for i in range(12) for t, (r, x) in enumerate([("system", "Be brief."), ("user", "What?\nAnd why?"), ("assistant", "Because.\n\nOf that.\nYes"), ("user", "Oh")])]
    talks = chat.transcribed(frame(spark, rows), F.lit(0))
    model = chat.train(talks)
    for r in chat.parse(talks, model).collect():
        assert r["canonical"] == "<|system|>\nBe brief.\n<|end|>\n<|user|>\nWhat?\nAnd why?\n<|end|>\n<|assistant|>\nBecause.\n\nOf that.\nYes\n<|end|>\n<|user|>\nOh\n<|end|>\n"
        assert (r["n_turns"], r["roles"]) == (4, "system,user,assistant,user")


def test_every_row_is_a_turn(spark):
    rows = [(1, None, "user", "yes"), (1, None, "user", "yes"), (1, None, "user", None), (1, None, "user", ""), (1, 4, "assistant", "yes"), (1, 4, "assistant", "yes")]
    rows += [(2, None, "user", "yes")] * 600
    found = {(r["conv_id"], r["part"]): [t["role"] for t in r["turns"]] for r in chat.transcribed(frame(spark, rows).repartition(3), F.lit(0)).collect()}
    assert found[1, 0] == ["user"] * 4 + ["assistant"] * 2
    assert [len(found[2, i]) for i in range(3)] == [256, 256, 88]


def test_turns_beside_an_unknown_role_are_learned_from(spark):
    known = [(i, t, r, x) for i in range(9) for t, (r, x) in enumerate([("user", "Hi"), ("assistant", "Yes."), ("user", "So?")])]
    odd = [(i + 50, t, r, x) for i in range(9) for t, (r, x) in enumerate([("tool", "data"), ("user", "Hi"), ("assistant", "Yes."), (None, "x"), ("user", "So?")])]
    first, both = (chat.train(chat.transcribed(frame(spark, rows), F.lit(0))) for rows in (known, known + odd))
    user, answer = (chat.STATES.index((role, True)) for role in ("user", "assistant"))

    def count(model, a, b):
        return float(np.exp(model.moves[a, b] - model.moves[a, user])) if b != user else 1.0

    # User to assistant is seen twice as often; nothing is learned of how a conversation begins or what follows a tool.
    assert both.moves[user, answer] > first.moves[user, answer] - 0.3 and count(both, chat.BEGIN, answer) == pytest.approx(count(first, chat.BEGIN, answer))


def test_canonical_text_is_read_back():
    turns = [("user", "what is <|end|> or <|user|>?\n<|end|>\n"), ("assistant", "<\\|end|> and <\\\\|x|> \\ <||>"), ("user", "")]
    assert chat.from_canonical(chat.canonical(turns)) == turns


def test_nulls_repeats_long_conversations_and_empty_tables(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, None), (None, None, "tool", "x"), (2, 0, "user", "b " * 50_000)]
    rows += [(3, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(600)]
    talks = chat.transcribed(frame(spark, rows))
    assert {(r["conv_id"], r["part"]): len(r["turns"]) for r in talks.collect()} == {(1, 0): 3, (None, 0): 1, (2, 0): 1, (3, 0): 256, (3, 1): 256, (3, 2): 88}
    model = chat.train(talks)
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "\n \n")], "id int, transcript string")
    assert [tuple(r)[1:] for r in chat.parse(texts, model).collect()] == [(0, "", "")] * 3
    got = chat.parse(talks, model)
    assert got.columns == ["conv_id", "part", "style", "turns", "n_turns", "roles", "canonical"] and got.count() == 6
    none = chat.transcribed(frame(spark, []))
    assert chat.parse(none, chat.train(none)).count() == 0
    assert chat.parse(texts, chat.train(none)).count() == 3
