"""The training-data pipeline over the documents table: from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of documents. ``run`` writes every stage's result to the shared folder and rereads it, so a lost
executor costs a stage's tasks and no more.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens.llm import exact, language, mixing, packing, simhash
from supportlens.llm.rows import ROW, identified, without_rows
from supportlens.session import written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier, fitted on all labelled documents, can tell.

    It rejects null texts and those without a letter. Without any labelled document there is nothing to tell
    languages by, and documents with letters stay.
    """
    model = language.train(docs)
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = docs.withColumn("_llm_lang", language.prediction(spark, model, F.col("text")))
    return found.filter(F.col("_llm_lang.lang_pred") != language.UNKNOWN).drop("_llm_lang")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts."""
    rows = identified(docs)
    dropped = written(exact.exact_duplicates(docs).filter("NOT kept").select(*ROW), "exact-dropped")
    return without_rows(rows, dropped)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with near fingerprints, the one with the smallest id."""
    rows = identified(docs)
    dropped = written(simhash.near_duplicates(docs).filter("NOT kept").select(*ROW), "near-dropped")
    return without_rows(rows, dropped)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a document that is taken twice is two rows."""
    return mixing.plan_mix(docs, F.array("source")).repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in token sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language), ("exact_dedup", without_copies), ("simhash_dedup", without_near_copies),
    ("mixing", mixed), ("packing", packed),
]

#: SQL can't express the classifier, the fingerprints, the seeded order or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
