"""Inverted text index on parquet, and top-k search over it.

An index folder holds four tables: ``vectors`` (one row per document, with its term
counts and length), ``postings`` (one row per document and term, with the document's
unit-length weight), ``terms`` (how many documents hold a term) and ``manifest`` (one
row: what was indexed, how many documents, when). Each task writes the postings of its own documents,
sorted by term and key, in small row groups: none is shuffled, a search reads the row groups and pages of
its terms in every file, and a term that occurs in a third of all documents spreads over all files.

Documents are matched by word, not by meaning. The score is the cosine between the
document's log-tf vector and the query's log-tf times ln(N / document frequency).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens.functions.params import MAX_INLINE
from supportlens.functions.text import counts_norm, log_tf, term_counts, token_total
from supportlens.session import spread
from supportlens.sources.storage import manifest_row

DIGITS = 6
#: Bytes of a row group of postings; a search skips those without its terms.
ROW_GROUP = 16 << 20


def text_vectors(docs: DataFrame, text: str) -> DataFrame:
    """Per document: tokens, distinct terms, vector length and term counts, next to its other columns."""
    others = [c for c in docs.columns if c != text]
    counted = docs.select(*others, term_counts(F.col(text)).alias("counts"))
    return counted.select(
        *others,
        token_total(F.col("counts")).alias("n_tokens"),
        F.size("counts").alias("n_terms"),
        counts_norm(F.col("counts")).alias("norm"),
        "counts",
    )


def postings_of(vectors: DataFrame, key: str, *more: Column) -> DataFrame:
    """One row per document and term, with more columns of the document. ``vectors`` should be a stored table."""
    exploded = vectors.select(key, "norm", F.explode("counts").alias("c"), *more)
    kept = [c for c in exploded.columns if c not in (key, "norm", "c")]
    return exploded.select(F.col("c.term").alias("term"), key, (log_tf(F.col("c.tf")) / F.col("norm")).alias("weight"), *kept)


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    path: str
    key: str

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    @property
    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest")

    def documents(self) -> int:
        return self.manifest.first()["documents"]

    def frequencies(self, terms: list[str]) -> dict[str, int]:
        """In how many documents each of the terms occurs; never larger than the list."""
        table = self.spark.read.parquet(f"{self.path}/terms")
        return {r["term"]: r["n"] for r in _among(table, terms).collect()}


def write_postings(vectors: DataFrame, key: str, path: str, target: str = "postings") -> None:
    """Write the postings of stored vectors, sorted where the vectors are read."""
    sorted_rows = postings_of(vectors, key).sortWithinPartitions("term", key)
    sorted_rows.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(f"{path}/{target}")


def finish_index(index: TextIndex, name: str, text: str) -> TextIndex:
    """Write everything that follows from the stored vectors; the manifest comes last."""
    write_postings(index.vectors, index.key, index.path)
    counted = index.vectors.select(F.explode("counts.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counted.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{index.path}/terms")
    manifest_row(index.vectors, name, index.key, text, index.path).write.parquet(f"{index.path}/manifest")
    return index


def write_index(docs: DataFrame, key: str, text: str, path: str, name: str = "index") -> TextIndex:
    """Build the index of ``docs[text]`` under ``path``."""
    index = TextIndex(docs.sparkSession, path, key)
    text_vectors(spread(docs), text).write.parquet(f"{path}/vectors")
    return finish_index(index, name, text)


def query_terms(spark: SparkSession, text: str) -> dict[str, int]:
    """Term counts of one query text; never larger than the text itself."""
    row = spark.range(1).select(term_counts(F.lit(text)).alias("counts")).first()
    return {c["term"]: c["tf"] for c in row["counts"]}


def query_weights(index: TextIndex, text: str) -> dict[str, float]:
    """Unit-length weights of the query's terms that occur in the index."""
    terms = query_terms(index.spark, text)
    frequency = index.frequencies(list(terms))
    documents = index.documents()
    raw = {t: (1 + math.log(terms[t])) * math.log(documents / n) for t, n in frequency.items()}
    length = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / length for t, w in raw.items() if w > 0}


def _among(table: DataFrame, terms: list[str]) -> DataFrame:
    """Rows of a table of terms that hold one of the given ones."""
    if len(terms) <= MAX_INLINE:
        return table.where(F.col("term").isin(terms))
    wanted = table.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    return table.join(wanted, "term", "left_semi")


def scores(index: TextIndex, text: str, candidates: DataFrame | None = None) -> DataFrame:
    """``(key, search_score)`` of every document that shares a weighted term with the text.

    ``candidates`` restricts the documents before they are scored; document
    frequencies are those of the whole index.
    """
    weights = query_weights(index, text)
    if not weights:
        return index.vectors.select(index.key, F.lit(0.0).alias("search_score")).where(F.lit(False))
    # One row per query term: bounded by the query text.
    table = index.spark.createDataFrame(list(weights.items()), "term string, query_weight double")
    matched = _among(index.postings, list(weights)).join(F.broadcast(table), "term")
    if candidates is not None:
        matched = matched.join(candidates.select(index.key), index.key, "left_semi")
    return matched.groupBy(index.key).agg(
        F.round(F.sum(F.col("weight") * F.col("query_weight")), DIGITS).alias("search_score")
    )


def top_k(scored: DataFrame, key: str, k: int) -> DataFrame:
    return scored.orderBy(F.desc("search_score"), key).limit(k)


def search(
    index: TextIndex, text: str, num_results: int = 5, source: DataFrame | None = None, candidates: DataFrame | None = None
) -> DataFrame:
    """The best ``num_results`` documents for a text.

    ``candidates`` (a table holding the key) restricts the search before the cut;
    ``source`` adds its columns to the hits.
    """
    found = scores(index, text, candidates)
    hits = top_k(found, index.key, num_results)
    if source is None:
        return hits
    if num_results <= MAX_INLINE:
        # A bounded list of keys: the scan of the source prunes with it.
        best = hits.collect()
        hits = F.broadcast(index.spark.createDataFrame(best, found.schema))
        source = source.where(F.col(index.key).isin([row[index.key] for row in best]))
    with_columns = source.join(hits, index.key)
    return with_columns.select("search_score", *source.columns).orderBy(F.desc("search_score"), index.key)


def matching(
    index: TextIndex, text: str, min_score: float, source: DataFrame | None = None, candidates: DataFrame | None = None
) -> DataFrame:
    """Every document whose score for a text is ``min_score`` or more, however many they are."""
    found = scores(index, text, candidates).where(F.col("search_score") >= min_score)
    return found if source is None else source.join(found, index.key).select("search_score", *source.columns)
