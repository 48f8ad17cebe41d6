"""Approximate nearest neighbours by trained lists and product quantisation, with a recall that was measured.

Vectors are put into lists around trained centroids, about as many lists as the square root of their number, and each
is stored as a code: the nearest of 256 codewords for each of several groups of dimensions. A search scores the codes
of the closest lists by inner products with the vectors they stand for, and the best candidates again with their own
vectors. Lists next to each other make up tiles (see ``vector_search``), so a question is sent to each tile once, however
many lists it probes there, and a tile returns its best candidates only.
How many lists and candidates that takes is found by questions whose true neighbours are known.

Centroids and codewords are fitted on a bounded sample and decide cost and recall only; every row is in the index.
Rows whose vector can't be compared (see ``vector_search``) are neither asked nor found.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens.functions.vectors import dot
from supportlens.operators.vector_search import BLOCK, CHUNK, DIGITS, PROBES, Tiles, _best_places, _matrix, best_in_tile, best_per_query, in_tiles, strips_of, usable
from supportlens.session import written

#: Rows that centroids and codewords are fitted on at most, and of them for each list; questions that calibrate a search.
SAMPLE, PER_LIST, QUESTIONS = 1 << 18, 64, 100
CODEWORDS, PART_DIMS, ROUNDS = 256, 4, 8

# Tasks get these functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Place of the closest centroid of each row, in blocks of bounded size."""
    half = (centroids * centroids).sum(axis=1) / 2
    step = max(1, (1 << 22) // len(centroids))
    return np.concatenate([np.argmax(rows[i : i + step] @ centroids.T - half, axis=1) for i in range(0, len(rows), step)] or [np.zeros(0, int)])


def trained(rows: np.ndarray, k: int, seed: int = 42) -> np.ndarray:
    """``k`` centroids at most by Lloyd's rounds; a centroid without rows is put on a random one."""
    random = np.random.default_rng(seed)
    different = np.unique(rows, axis=0)
    if len(different) <= k:
        return different
    found = different[random.choice(len(different), k, replace=False)]
    for _ in range(ROUNDS):
        place = nearest(rows, found)
        sizes = np.bincount(place, minlength=k)
        sums = np.zeros_like(found)
        np.add.at(sums, place, rows)
        found = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], rows[random.integers(len(rows), size=k)])
    return found


@dataclass(frozen=True)
class Codebooks:
    """Centroids of the lists, and the codewords of each group of dimensions."""

    centroids: np.ndarray
    words: list[np.ndarray]
    groups: list[slice]

    def codes(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([nearest(rows[:, g], w) for g, w in zip(self.groups, self.words, strict=True)], axis=1).astype(np.uint8)

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        return np.concatenate([w[codes[:, i]] for i, w in enumerate(self.words)], axis=1)


@dataclass(frozen=True)
class QuantisedIndex:
    """``vectors``: neighbour_id and vector; ``codes``: these with list and code of every vector."""

    spark: SparkSession
    vectors: DataFrame
    codes: DataFrame
    books: Codebooks
    sizes: np.ndarray

    @property
    def total(self) -> int:
        return int(self.sizes.sum())


def fit(vectors: DataFrame, vector: str, total: int, dims: int) -> Codebooks:
    """Codebooks from at most ``SAMPLE`` rows of a table, drawn by the hash of their vectors."""
    lists = max(1, min(math.isqrt(total), SAMPLE // PER_LIST))
    wanted = min(SAMPLE, max(lists * PER_LIST, 4 * CODEWORDS))
    share = F.pmod(F.xxhash64(vector), F.lit(1 << 20)) < int((1 << 20) * min(1.0, wanted / max(total, 1))) + 1
    rows = np.array([r[0] for r in vectors.where(share).select(vector).limit(SAMPLE).collect()]).reshape(-1, dims)
    if not len(rows):
        rows = np.zeros((1, dims))
    groups = [slice(i, i + PART_DIMS) for i in range(0, dims, PART_DIMS)]
    return Codebooks(trained(rows, lists), [trained(np.ascontiguousarray(rows[:, g]), CODEWORDS) for g in groups], groups)


def write_index(vectors: DataFrame, key: str, vector: str, path: str) -> QuantisedIndex:
    """Train, encode and store ``vectors``."""
    spark = vectors.sparkSession
    rows, dims = usable(vectors.select(F.col(key).alias("neighbour_id"), F.col(vector).alias("vector")), "vector")
    rows.write.parquet(f"{path}/vectors")
    stored = spark.read.parquet(f"{path}/vectors")
    books = fit(stored, "vector", stored.count(), max(dims, 1))
    schema = T.StructType([stored.schema["neighbour_id"], stored.schema["vector"], T.StructField("list", T.IntegerType()), T.StructField("code", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column("vector"), dims)
            codes = [c.tobytes() for c in books.codes(found)]
            columns = [batch.column("neighbour_id"), batch.column("vector"), pa.array(nearest(found, books.centroids).astype(np.int32)), pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    stored.mapInArrow(encode, schema).write.parquet(f"{path}/codes")
    codes = spark.read.parquet(f"{path}/codes")
    sizes = np.zeros(len(books.centroids), int)
    for r in codes.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    return QuantisedIndex(spark, stored, codes, books, sizes)


def _probes(index: QuantisedIndex, tiles: Tiles, queries: DataFrame, key: str, vector: str, probes: int) -> DataFrame:
    """Rows (query_id, query_vector, least, codes, probes): the lists whose centroids score best, by tile, and the number
    of codes in them."""
    dims = index.books.centroids.shape[1]
    asked = usable(queries.select(F.col(key).alias("query_id"), F.col(vector).alias("query_vector")), "query_vector", dims)[0]
    asked = asked.withColumn("least", F.lit(float("-inf")))
    centroids, sizes = index.books.centroids, index.sizes

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                scores = _matrix(batch.column("query_vector"), dims) @ centroids.T
                order = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
                chosen = np.zeros(scores.shape, bool)
                np.put_along_axis(chosen, order, True, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen @ sizes), tiles.probed(chosen & (sizes > 0))], [*batch.schema.names, "codes", "probes"])

    return asked.mapInArrow(choose, T.StructType([*asked.schema, T.StructField("codes", T.LongType()), T.StructField("probes", PROBES)]))


def _candidates(index: QuantisedIndex, tiles: Tiles, probed: DataFrame, candidates: int, exclude_self: bool) -> DataFrame:
    """The best ``candidates`` by code of each question and tile: (query_id, neighbour_id, code_score, search_score)."""
    books, dims = index.books, index.books.centroids.shape[1]
    doubles = [T.StructField(name, T.DoubleType()) for name in ("code_score", "search_score")]
    schema = T.StructType([probed.schema["query_id"], index.codes.schema["neighbour_id"], *doubles])

    def score(first: int, cells: int, coded: pa.Table):
        keys, vectors = coded.column("neighbour_id").combine_chunks(), _matrix(coded.column("vector"), dims)
        codes = np.frombuffer(b"".join(coded.column("code").to_pylist()), np.uint8).reshape(len(keys), -1)
        strips = strips_of(coded.column("cell").to_numpy() - first, books.decoded(codes))

        def answer(asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, row, place, value in best_in_tile(asked, keys, strips, dims, cells, candidates, exclude_self, None):
                questions, values = _matrix(part.column("query_vector"), dims), [np.zeros(0)]
                # So many pairs at a time.
                for i in range(0, len(row), CHUNK):
                    values.append(np.einsum("ij,ij->i", questions[row[i : i + CHUNK]], vectors[place[i : i + CHUNK]]))
                exact = np.round(np.concatenate(values), DIGITS)
                columns = [part.column("query_id").take(pa.array(row)), keys.take(pa.array(place)), pa.array(value), pa.array(exact)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return answer

    return in_tiles(index.codes.withColumnRenamed("list", "cell"), probed.drop("codes"), tiles, score, schema)


def search(
    index: QuantisedIndex, queries: DataFrame, key: str, vector: str, k: int = 5, probes: int = 8, candidates: int = 40, exclude_self: bool = False
) -> DataFrame:
    """``(query_id, neighbour_id, search_score, rank)`` with exact inner products of the best ``candidates`` by code
    from the ``probes`` closest lists. Equal scores go by key."""
    tiles = Tiles(index.sizes)
    probed = written(_probes(index, tiles, queries, key, vector, probes), "quantised-probes")
    found = _candidates(index, tiles, probed, candidates, exclude_self)
    order = Window.partitionBy("query_id").orderBy(F.desc("code_score"), "neighbour_id")
    kept = found.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= candidates).drop("_place", "code_score")
    return best_per_query(_by_rows(index, kept.where("query_id IS NOT NULL AND neighbour_id IS NOT NULL"), probed), k)


def _by_rows(index: QuantisedIndex, kept: DataFrame, probed: DataFrame) -> DataFrame:
    """Scored pairs; one whose ids stand for several rows is compared once more for each of these."""
    repeated = {}
    for key, rows in (("query_id", probed), ("neighbour_id", index.codes)):
        counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        repeated[key] = written(counted.select(key), "repeated-ids")
    some = {key: ids for key, ids in repeated.items() if not ids.isEmpty()}
    if not some:
        return kept
    for key, ids in some.items():
        kept = kept.join(ids.withColumn(f"_{key}", F.lit(True)), key, "left")
    # No null: a pair is on one side or the other.
    several = F.coalesce(*[F.col(f"_{key}") for key in some], F.lit(False))
    asked = probed.select("query_id", "query_vector")
    met = kept.where(several).select("query_id", "neighbour_id").join(index.vectors, "neighbour_id").join(asked, "query_id")
    scored = met.select("query_id", "neighbour_id", F.round(dot(F.col("query_vector"), F.col("vector")), DIGITS).alias("search_score"))
    return kept.where(~several).select(*scored.columns).unionByName(scored)


def _truth(index: QuantisedIndex, asked: list, k: int) -> DataFrame:
    """The ``k`` best rows of a bounded number of questions, which every task compares with its vectors."""
    ids, matrix, dims = [i for i, _ in asked], np.array([v for _, v in asked]), index.books.centroids.shape[1]
    schema = T.StructType([T.StructField("query_id", index.vectors.schema["neighbour_id"].dataType), index.vectors.schema["neighbour_id"], T.StructField("search_score", T.DoubleType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("neighbour_id")
            found = np.round(matrix @ _matrix(batch.column("vector"), dims).T, DIGITS)
            listed = keys.to_pylist()
            at = {k: i for i, k in enumerate(listed)}
            for i, own in enumerate(ids):
                if own in at:
                    found[i, at[own]] = -np.inf
            row, place, value = _best_places(found, k)
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in row.tolist()], batch.schema.field("neighbour_id").type), keys.take(pa.array(place)), pa.array(value)], schema.names)

    return best_per_query(index.vectors.mapInArrow(compare, schema), k)


def calibrate(index: QuantisedIndex, k: int, target: float) -> tuple[int, int]:
    """Lists to probe and candidates to compare for a share of ``target`` of the true neighbours, measured on at most
    ``QUESTIONS`` vectors of the index, each without itself."""
    lists = len(index.books.centroids)
    if not index.total:
        return 1, k
    drawn = index.vectors.orderBy(F.xxhash64("neighbour_id"), "neighbour_id").limit(QUESTIONS)
    asked = [(r["neighbour_id"], r["vector"]) for r in drawn.collect()]
    truth = written(_truth(index, asked, k), "quantised-truth")
    homes = truth.join(index.codes.select("neighbour_id", "list"), "neighbour_id").select("query_id", "neighbour_id", "list").collect()
    if not homes:
        return 1, k
    order = {i: {int(c): r for r, c in enumerate(np.argsort(-(index.books.centroids @ np.array(v)), kind="stable"))} for i, v in asked}
    ranks = sorted(order[r["query_id"]][r["list"]] for r in homes)
    # Half of what may be missing is left for the codes.
    probes = min(lists, ranks[min(len(ranks) - 1, math.ceil(len(ranks) * (1 + target) / 2) - 1)] + 1)
    questions = index.spark.createDataFrame(asked, T.StructType([T.StructField("query_id", index.vectors.schema["neighbour_id"].dataType), T.StructField("vector", T.ArrayType(T.DoubleType()))]))
    candidates = 4 * k
    while True:
        found = search(index, questions, "query_id", "vector", k, probes, candidates, exclude_self=True)
        hits = found.join(truth.select("query_id", "neighbour_id"), ["query_id", "neighbour_id"]).count()
        if hits >= target * len(homes) or candidates >= index.total:
            return probes, candidates
        candidates *= 2


def scored_share(index: QuantisedIndex, queries: DataFrame, key: str, vector: str, probes: int) -> float:
    """Share of all codes that a search looks at for these questions."""
    row = _probes(index, Tiles(index.sizes), queries, key, vector, probes).agg(F.sum("codes").alias("codes")).first()
    return (row["codes"] or 0) / max(1, index.total * queries.count())
