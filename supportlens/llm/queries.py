"""The registered queries of this subpackage: name -> (session, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens.llm import bpe, chat, exact, language, lm, merkle, mixing, packing, resample, simhash, tokens, vectors, warc
from supportlens.session import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_warc")
def op1(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


@query("op2_chat_roles")
def op2(spark, sf_dir):
    talks = written(chat.transcribed(table(spark, sf_dir, "conversations")), "chat-talks")
    talks = talks.withColumn("held_out", F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 7 == 2, F.lit(False)))
    model = chat.train(talks.filter("NOT held_out AND conv_id IS NOT NULL"))
    return chat.parse(talks, model).select("conv_id", "part", "style", "held_out", "n_turns", "roles", "canonical")


@query("op3_multi_index")
def op3(spark, sf_dir):
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


@query("op4_simhash")
def op4(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def with_fold(docs: DataFrame, folds: int, held: int) -> DataFrame:
    """``docs`` with ``held_out``: whether the CRC-32 of the id leaves this remainder. A null id isn't held out."""
    return docs.withColumn("held_out", F.coalesce(language.crc(F.col("doc_id")) % folds == held, F.lit(False)))


@query("op5_language_id")
def op5(spark, sf_dir):
    docs = with_fold(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), 3, 1)
    model = language.train(docs.filter("NOT held_out AND doc_id IS NOT NULL"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query("op6_token_counts")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op7_packing")
def op7(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def of_pattern(plan: mixing.Mix, name: str, kind: str):
    """A figure of a document's source, where each document has one source."""
    figures = {s["source"]: s[name] for s in plan.sources}
    return F.element_at(F.array(*[F.lit(figures[p[0]]).cast(kind) for p in plan.patterns]), F.col("_llm_pattern") + 1)


@query("op8_mixing")
def op8(spark, sf_dir):
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), F.array("source"))
    if not plan.patterns:
        return plan.marked.selectExpr("doc_id", "_llm_size AS size", "0L AS source_size", "0D AS target", "0L AS taken")
    return plan.marked.select(
        "doc_id", F.col("_llm_size").alias("size"), of_pattern(plan, "size", "long").alias("source_size"),
        of_pattern(plan, "target", "double").alias("target"), (F.col("_llm_size") * F.col("_llm_copies")).alias("taken"),
    )


@query("op9_lm_scoring")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trained = (language.crc(F.col("doc_id")) % 7 != 2) & F.col("doc_id").isNotNull()
    return with_fold(lm.score(docs, trained), 7, 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op10_exact_dedup")
def op10(spark, sf_dir):
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op11_byte_bpe")
def op11(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return bpe.digests(found.select("doc_id", "ids"), path)


def tampered(docs: DataFrame, depth: int = merkle.DEPTH) -> DataFrame:
    """The manifest of documents, checked against texts of which a third has been changed: A to Z lower-cased where 3
    divides the CRC-32 of the id. Null texts and ids aren't changed."""

    def other(rows: DataFrame):
        changed = [merkle.lowered(F.col(f)) if f == "text" else F.col(f) for f in merkle.FIELDS]
        return F.when((language.crc(F.col("doc_id")) % 3 == 0) & F.col("text").isNotNull(), merkle.record_hash(*changed))

    found = merkle.verified(merkle.manifest(docs, also=other, depth=depth)).withColumn("proof_sha256", merkle.proof_hash(F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op12_merkle_manifest")
def op12(spark, sf_dir):
    return tampered(table(spark, sf_dir, "documents"))


@query("op13_importance_resampling")
def op13(spark, sf_dir):
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
