"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and every n-gram of one to four characters is
hashed to one of ``BUCKETS`` columns. Training counts n-grams per language over all labelled rows, in the tasks
first and then by bucket; the matrix of log-probabilities (languages x buckets, so of fixed width) is broadcast,
and a batch of texts is scored by multiplying its sparse counts with it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, ORDER, SMOOTHING = 1 << 16, 4, 0.5
UNKNOWN = "und"
#: Characters whose n-grams are hashed at a time, so that memory doesn't grow with the length of a text.
CHUNK = 1 << 18
#: Buckets that a training task holds before it counts them.
HELD = 1 << 21
#: Odd multiplier that mixes a character into the hash of the characters before it.
FACTOR = 0x9E3779B97F4A7C15


def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters; those beyond it are asked for one by one."""
    return np.array([chr(c).isalpha() for c in range(0x10000)])


LETTERS = _letters()


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters, all else as spaces, a space at either end, runs of spaces as one."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = LETTERS[np.minimum(codes, 0xFFFF)]
    if (far := codes > 0xFFFF).any():
        keep[far] = [chr(c).isalpha() for c in codes[far]]
    codes = np.concatenate(([32], np.where(keep, codes, 32), [32])).astype(np.uint64)
    return codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]


def buckets(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all n-grams, in pieces of bounded size; none for a null text or one without a letter."""
    codes = code_points(text or "")
    if len(codes) < 2:
        return
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    for at in range(0, len(codes), CHUNK):
        part = codes[at : at + CHUNK + ORDER - 1]
        value, found = np.full(len(part) + 1, 1, np.uint64), []
        for order in range(ORDER):
            value = (value[:-1] ^ part[order:]) * np.uint64(FACTOR)
            value ^= value >> np.uint64(32)
            found.append((value[:CHUNK] * np.uint64(FACTOR) >> shift).astype(np.int32))
            if len(value) < 2:
                break
        yield np.concatenate(found)


def crc(value: Column) -> Column:
    """CRC-32 of a value as text; null if it is null."""
    return F.crc32(value.cast("string"))


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, log-probabilities of the buckets (a column per language) and of the languages."""

    languages: list[str]
    weights: np.ndarray
    priors: np.ndarray

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], list[float]]:
        """Most probable language of each text (the first of equal ones) and its posterior probability."""
        names, scores = [], []
        for text in texts:
            odds = None
            for found in buckets(text) if self.languages else ():
                odds = (self.priors if odds is None else odds) + self.weights[found].sum(axis=0)
            best = 0 if odds is None else int(odds.argmax())
            names.append(UNKNOWN if odds is None else self.languages[best])
            scores.append(0.0 if odds is None else float(1 / np.exp(odds - odds[best]).sum()))
        return names, scores


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from every row with a language and a text that has letters.

    The table of counts that reaches the driver has at most ``BUCKETS`` numbers for each language. Without any
    labelled row the model knows no language and predicts ``und``.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def add(key: str) -> None:
            if held[key]:
                sums[key] = sums.get(key, 0) + np.bincount(np.concatenate(held[key]), minlength=BUCKETS)
                held[key] = []

        for batch in batches:
            for name, value in zip(*batch.columns, strict=True):
                key, some = name.as_py(), False
                for found in buckets(value.as_py()):
                    some = True
                    held.setdefault(key, []).append(found)
                    size += len(found)
                    if size >= HELD:
                        size = 0
                        for other in held:
                            add(other)
                texts[key] = texts.get(key, 0) + some
        for key in held:
            add(key)
            at = np.flatnonzero(sums[key])
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(sums[key][at], texts[key]))],
                ["lang", "bucket", "n"],
            )

    table = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, places, numbers = (table.column(i).to_numpy() for i in range(3))
    languages = sorted(set(names.tolist()))
    place = np.array([languages.index(x) for x in names.tolist()], np.int64)
    total, per_text = np.zeros((len(languages), BUCKETS)), np.zeros(len(languages))
    total[place[places >= 0], places[places >= 0]] = numbers[places >= 0]
    per_text[place[places < 0]] = numbers[places < 0]
    weights = np.log(total + SMOOTHING) - np.log(total.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return LanguageModel(languages, np.ascontiguousarray(weights.T), np.log(per_text / max(per_text.sum(), 1)))


def prediction(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """A struct of ``lang_pred`` and ``score`` (0 to 1) for a text, from the text alone."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def score(texts: pa.Array) -> pa.Array:
        names, scores = shared.value.predict(t.as_py() for t in texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return score(text)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, in place of columns of these names.

    ``und`` with score 0 for a null text or one without a letter. Rows are scored one by one, so repeated rows get
    the same result and an empty table gives an empty one.
    """
    found = docs.withColumn("_llm_lang", prediction(docs.sparkSession, model, F.col(text)))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")], "_llm_lang.lang_pred", "_llm_lang.score")
