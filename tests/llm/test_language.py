"""Language identification: held-out accuracy, and the model against counting by hand."""

from __future__ import annotations

import math

import numpy as np
import pytest

from supportlens.llm import language
from supportlens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score double, lang_pred string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "zz") for r in rows], SCHEMA)


def test_held_out_accuracy(spark, small_dir):
    got = QUERIES["op5_language_id"](spark, small_dir).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert len(got) == len(lang) and len(held) > 30
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_letters_only():
    text = language.code_points("Ab1 é\n\n\U0001d400!")
    assert "".join(map(chr, text.tolist())) == " ab é \U0001d400 "
    assert list(language.buckets(None)) == list(language.buckets(" 1!\n")) == []


def test_pieces_hold_the_same_n_grams(monkeypatch):
    text = "Il était une fois " * 50
    whole = np.sort(np.concatenate(list(language.buckets(text))))
    monkeypatch.setattr(language, "CHUNK", 16)
    assert (np.sort(np.concatenate(list(language.buckets(text)))) == whole).all()
    n = len(language.code_points(text))
    assert len(whole) == sum(n - k for k in range(language.ORDER))


def test_the_model_by_hand(spark):
    rows = [(1, "aab", "x"), (2, "abb!", "y"), (3, "aab", "x"), (4, None, "y"), (5, "zz", None), (6, "12", "y")]
    model = language.train(frame(spark, rows))
    assert model.languages == ["x", "y"]
    assert np.allclose(np.exp(model.priors), [2 / 3, 1 / 3])

    def likelihood(text, of):
        seen = [b for t in of for p in language.buckets(t) for b in p]
        return sum(math.log((seen.count(b) + 0.5) / (len(seen) + 0.5 * language.BUCKETS)) for p in language.buckets(text) for b in p)

    x = math.log(2 / 3) + likelihood("abb", ["aab", "aab"])
    y = math.log(1 / 3) + likelihood("abb", ["abb!"])
    names, scores = model.predict(["abb", None, "", "\x00 9"])
    assert names == ["y", "und", "und", "und"]
    assert scores == pytest.approx([1 / (1 + math.exp(x - y)), 0, 0, 0])


def test_columns_nulls_long_texts_and_empty_tables(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (2, "der hund und die katze", "de"), (None, None, None), (3, "the " * 200_000, None)]
    model = language.train(frame(spark, rows))
    got = language.identify(frame(spark, rows), model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert [r["lang_pred"] for r in got.collect()] == ["en", "de", "de", "und", "en"]
    none = language.train(frame(spark, []))
    assert none.languages == [] and language.identify(frame(spark, []), none).count() == 0
    assert language.identify(frame(spark, rows), none).select("lang_pred").distinct().collect()[0][0] == "und"
