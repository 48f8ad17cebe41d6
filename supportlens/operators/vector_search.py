"""Nearest neighbours by inner product: one query, all queries, exact or approximate. Vectors may have any length.

The index is split into lists around centroids, and large lists into rings by the
angle to their centroid. Neighbouring cells make up tiles of bounded size, and a larger
cell is cut into parts; queries are cut likewise. A query goes to each tile once, with a
bit for each cell that it probes there, so that what is shuffled follows from the
numbers of vectors and tiles, not of cells. A tile and a part of its queries are scored by matrix
products and keep only the k best per query.

The exact join probes each query's nearest list first. The k-th score found there
rules out every cell whose best possible score, from the triangle inequality on
angles and the lengths of its vectors, is lower; the remaining cells are probed in
a second round.

Rows whose vector is null, zero, holds a null or a value that isn't finite, or has
another number of dimensions than most of the index, are neither asked nor found.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens.functions.vectors import dot
from supportlens.session import new_dir, written

CHUNK = 4096
# Queries and vectors of the index scored at a time, which bounds the memory of a task.
BLOCK, STRIP = 256, 4096
# Vectors in a tile, and tiles that a table is cut into while they are no larger and no smaller than that.
TILE_MIN, TILE_MAX, TILES = 1024, 65536, 8
MAX_LISTS = 1024
RINGS = 32
DIGITS = 6
# Scores are compared after rounding; bounds get this much slack.
SLACK = 2e-6

# Tasks get these functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def mean_vector(vectors: DataFrame, vector: str) -> list[float]:
    """Mean of all vectors: as many numbers as the vector has dimensions."""
    summary = vectors.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vector)))).alias("mean"))
    return list(summary.first()["mean"])


def vector_top_k(vectors: DataFrame, key: str, vector: str, query: list[float], k: int = 5) -> DataFrame:
    """The ``k`` rows closest to one query vector, by inner product."""
    literal = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.withColumn("search_score", F.round(dot(F.col(vector), literal), DIGITS)).drop(vector)
    return scored.orderBy(F.desc("search_score"), key).limit(k)


class Tiles:
    """Cells in a row as tiles: ``of[c]`` is the tile of cell ``c``, ``first[t]`` and ``cells[t]`` are the first cell of
    a tile and their number, and ``parts[t]`` says in how many parts it is cut, which is one but for a single large cell."""

    def __init__(self, sizes: np.ndarray):
        self.rows = max(TILE_MIN, min(TILE_MAX, -(-int(sizes.sum()) // TILES)))
        of, totals = [], []
        for size in sizes.tolist():
            if not totals or totals[-1] + size > self.rows:
                totals.append(0)
            totals[-1] += size
            of.append(len(totals) - 1)
        self.of, self.parts = np.array(of, int), -(-np.maximum(np.array(totals, int), 1) // self.rows)
        self.cells = np.bincount(self.of, minlength=len(totals))
        self.first = np.cumsum(self.cells) - self.cells

    def probed(self, chosen: np.ndarray) -> pa.Array:
        """For each row of a matrix of queries by cells, the tiles that it needs and the bits of their cells."""
        wide = -(-self.cells // 8)
        begins = np.cumsum(wide) - wide
        padded = np.zeros((len(chosen), 8 * int(wide.sum())), bool)
        padded[:, 8 * begins[self.of] + np.arange(len(self.of)) - self.first[self.of]] = chosen
        packed = np.packbits(padded, axis=1)
        if not len(self.cells):
            return pa.array([[]] * len(chosen), pa.list_(pa.struct([("tile", pa.int32()), ("bits", pa.binary())])))
        row, tile = np.nonzero(np.logical_or.reduceat(chosen, self.first, axis=1))
        bits = [packed[r, b : b + w].tobytes() for r, b, w in zip(row.tolist(), begins[tile].tolist(), wide[tile].tolist())]
        entries = pa.StructArray.from_arrays([pa.array(tile.astype(np.int32)), pa.array(bits, pa.binary())], ["tile", "bits"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(chosen) + 1)).astype(np.int32)), entries)


#: What ``Tiles.probed`` returns.
PROBES = T.ArrayType(T.StructType([T.StructField("tile", T.IntegerType()), T.StructField("bits", T.BinaryType())]))


class Lists:
    """Centroids of the lists, and reach and size of their cells.

    Cell ``c`` belongs to list ``list_of[c]`` and holds ``sizes[c]`` vectors whose
    angle to the centroid is between ``inner[c]`` and ``outer[c]`` and whose length
    is between ``short[c]`` and ``long[c]``.
    """

    def __init__(self, centroids: np.ndarray, list_of: np.ndarray, inner: np.ndarray, outer: np.ndarray, sizes: np.ndarray, short: np.ndarray, long: np.ndarray):
        self.centroids, self.list_of, self.inner, self.outer, self.sizes = centroids, list_of, inner, outer, sizes
        self.short, self.long = short, long
        self.tiles = Tiles(sizes)


def usable(vectors: DataFrame, vector: str, dims: int | None = None) -> tuple[DataFrame, int]:
    """The rows that can be compared, their vectors as doubles, and the number of dimensions: the most frequent one."""
    cast = vectors.withColumn(vector, F.col(vector).cast("array<double>"))
    sums = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + F.abs(x))
    # Null if a component is; not below infinity if one isn't finite.
    finite = cast.where((sums > 0) & (sums < float("inf")))
    if dims is None:
        counted = finite.groupBy(F.size(vector).alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
        dims = counted["dims"] if counted else 0
    return finite.where(F.size(vector) == dims), dims


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; zero rows at the first axis."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    out = rows / np.where(length > 0, length, 1.0)
    out[length[:, 0] == 0, :1] = 1.0
    return out


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _centroids(index: DataFrame, vector: str, list_id: str, dims: int) -> tuple[list, np.ndarray]:
    doubles = F.col(vector).cast("array<double>")
    means = index.groupBy(list_id).agg(vector_to_array(Summarizer.mean(array_to_vector(doubles))).alias("mean"))
    found = means.orderBy(list_id).collect()
    return [r[list_id] for r in found], _unit(np.array([r["mean"] for r in found]).reshape(len(found), max(dims, 1)))


def bounded_lists(index: DataFrame, list_id: str) -> DataFrame:
    """``index`` with at most ``MAX_LISTS`` lists and one for rows without: of more, some are put together by hash."""
    if index.select(list_id).distinct().limit(MAX_LISTS + 2).count() <= MAX_LISTS + 1:
        return index
    return index.withColumn(list_id, F.when(F.col(list_id).isNotNull(), F.pmod(F.xxhash64(list_id), F.lit(MAX_LISTS))))


def _angles(centroids: np.ndarray):
    """Adds each vector's angle to the centroid of its list."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), centroids.shape[1])
            place = batch.column("place").to_numpy(zero_copy_only=False)
            angle = np.arccos(np.clip(np.einsum("ij,ij->i", _unit(vectors), centroids[place]), -1.0, 1.0))
            length = np.linalg.norm(vectors, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(angle), pa.array(length)], names=[*batch.schema.names, "angle", "length"])

    return measure


def place_in_lists(index: DataFrame, key: str, vector: str, list_id: str) -> tuple[DataFrame, Lists]:
    """The index as ``(neighbour_id, vector, cell)`` with the measures of its lists.

    The vectors are stored with list and angle once; what is measured afterwards
    reads only those two columns.
    """
    spark = index.sparkSession
    index, dims = usable(index, vector)
    index = bounded_lists(index, list_id)
    ids, centroids = _centroids(index, vector, list_id, dims)
    schema = T.StructType([T.StructField("_list", index.schema[list_id].dataType), T.StructField("place", T.IntegerType())])
    # At most MAX_LISTS + 1 rows.
    places = F.broadcast(spark.createDataFrame([(v, i) for i, v in enumerate(ids)], schema))
    listed = index.select(F.col(key).alias("neighbour_id"), F.col(vector).cast("array<double>").alias("vector"), list_id)
    # Rows without a list are a list of their own.
    listed = listed.join(places, F.col(list_id).eqNullSafe(F.col("_list"))).select("neighbour_id", "vector", "place")
    angled = written(
        listed.mapInArrow(_angles(centroids), T.StructType([*listed.schema, T.StructField("angle", T.DoubleType()), T.StructField("length", T.DoubleType())])),
        "knn-index",
    )
    reach = angled.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    slices, list_of, inner, outer = [], [], [], []
    for r in sorted(reach.collect(), key=lambda r: r["place"]):
        rings = max(1, min(RINGS, -(-r["n"] // CHUNK)))
        width = (r["high"] - r["low"]) / rings
        slices.append((r["place"], r["low"], width if width > 0 else 1.0, rings, len(list_of)))
        list_of += [r["place"]] * rings
        inner += [r["low"] + i * width for i in range(rings)]
        outer += [r["low"] + (i + 1) * width for i in range(rings)]
    # One row per list again.
    cuts = F.broadcast(spark.createDataFrame(slices, "place int, low double, width double, rings int, first int"))
    ring = F.least(F.floor((F.col("angle") - F.col("low")) / F.col("width")).cast("int"), F.col("rings") - 1)
    placed = angled.join(cuts, "place").select("neighbour_id", "vector", "length", (F.col("first") + ring).alias("cell"))
    sizes, short, long = np.zeros(len(list_of), dtype=np.int64), *np.zeros((2, len(list_of)))
    measured = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("short"), F.max("length").alias("long"))
    for r in measured.collect():
        sizes[r["cell"]], short[r["cell"]], long[r["cell"]] = r["n"], r["short"], r["long"]
    return placed.drop("length"), Lists(centroids, np.array(list_of, int), np.array(inner), np.array(outer), sizes, short, long)


def _choose_cells(queries: DataFrame, key: str, vector: str, lists: Lists, choose, extra: str = "") -> DataFrame:
    """Stored rows ``(query_id, query_vector, least, probes)``: the tiles each query needs, and its cells there.

    ``choose(cosines, lengths, found)`` returns a boolean matrix of queries by cells;
    ``lengths`` are those of the query vectors, ``found`` holds the values of the
    extra column, a score that an answer has to reach.
    """
    centroids, filled, tiles = lists.centroids, lists.sizes > 0, lists.tiles
    queries = usable(queries, vector, centroids.shape[1])[0]
    least = F.col(extra) if extra else F.lit(float("-inf"))
    asked = queries.select(F.col(key).alias("query_id"), F.col(vector).cast("array<double>").alias("query_vector"), least.alias("least"))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                asked = _matrix(batch.column("query_vector"), centroids.shape[1])
                cosines = np.clip(_unit(asked) @ centroids.T, -1.0, 1.0)
                found = batch.column("least").to_numpy(zero_copy_only=False)
                chosen = choose(cosines, np.linalg.norm(asked, axis=1), found) & filled
                yield pa.RecordBatch.from_arrays([*batch.columns, tiles.probed(chosen)], names=[*batch.schema.names, "probes"])

    return written(asked.mapInArrow(probes, T.StructType([*asked.schema, T.StructField("probes", PROBES)])), "knn-probes")


def _nearest(lists: Lists, n: int):
    """All cells of the ``n`` lists with the closest centroids; earlier lists win ties."""

    def choose(cosines: np.ndarray, lengths: np.ndarray, found) -> np.ndarray:
        order = np.argsort(-cosines, axis=1, kind="stable")[:, :n]
        chosen = np.zeros(cosines.shape, dtype=bool)
        np.put_along_axis(chosen, order, True, axis=1)
        return chosen[:, lists.list_of]

    return choose


def _still_possible(lists: Lists):
    """Cells outside the nearest list that could hold a score of at least the k-th one found."""
    nearest = _nearest(lists, 1)

    def choose(cosines: np.ndarray, lengths: np.ndarray, found: np.ndarray) -> np.ndarray:
        angle = np.arccos(cosines)[:, lists.list_of]
        gap = np.maximum(np.maximum(angle - lists.outer, lists.inner - angle), 0.0)
        cosine = np.cos(gap)
        # The longest vector scores best, or the shortest where all scores are negative.
        best = cosine * np.where(cosine >= 0, lists.long, lists.short) * lengths[:, None]
        slack = SLACK * np.maximum(1.0, lists.long * lengths[:, None])
        return (best >= found[:, None] - slack) & ~nearest(cosines, lengths, found)

    return choose


def _best_places(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the ``k`` largest finite scores of each row; left columns win ties."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        row, place = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
    else:
        row, place = np.nonzero(np.isfinite(scores))
    value = scores[row, place]
    order = np.lexsort((place, -value, row))
    row, place, value = row[order], place[order], value[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    kept = rank < k
    return row[kept], place[kept], value[kept]


def strips_of(cell: np.ndarray, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Vectors of neighbouring cells of a tile: their places, themselves as columns, and their cells."""
    order = np.argsort(cell, kind="stable")
    places = [np.sort(order[i : i + STRIP]) for i in range(0, len(order), STRIP)]
    return [(at, np.ascontiguousarray(vectors[at].T), cell[at]) for at in places]


def best_in_tile(
    asked: pa.RecordBatch, keys: pa.Array, strips: list, dims: int, cells: int, k: int, exclude_self: bool, digits: int | None = DIGITS
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """The ``k`` best vectors of a tile for its queries, by blocks: a block, places in it, places in ``keys`` and scores.

    ``keys`` are in order, so that equal scores go by key; cells of ``strips`` count from the first one of the tile. A row
    of ``asked`` has its id, vector, the bits of its cells and ``least``, below which no score is wanted.
    """
    names = keys.to_numpy(zero_copy_only=False)
    for start in range(0, asked.num_rows, BLOCK):
        part = asked.slice(start, BLOCK)
        ids, matrix = part.column("query_id").to_numpy(zero_copy_only=False), _matrix(part.column("query_vector"), dims)
        bits = np.frombuffer(b"".join(part.column("bits").to_pylist()), np.uint8).reshape(len(part), -1)
        wanted, least = np.unpackbits(bits, axis=1, count=cells).astype(bool), part.column("least").to_numpy(zero_copy_only=False).copy()
        best = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for at, strip, place in strips:
            low, high = place.min(), place.max() + 1
            rows = np.flatnonzero(wanted[:, low:high].any(axis=1))
            for kind in (np.isneginf(least[rows]), ~np.isneginf(least[rows])):
                some = rows[kind]
                if not len(some):
                    continue
                scores, bound = matrix[some] @ strip, least[some]
                if np.isneginf(bound[0]):
                    # Nothing is known of these yet: the best of the strip.
                    scores[~wanted[some][:, place]] = -np.inf
                    if exclude_self:
                        scores[ids[some][:, None] == names[at][None, :]] = -np.inf
                    row, column, value = _best_places(scores if digits is None else np.round(scores, digits), k)
                else:
                    row, column = np.nonzero(scores >= (bound - SLACK * np.maximum(1.0, np.abs(bound)))[:, None])
                    kept = wanted[some[row], place[column]]
                    if exclude_self:
                        kept &= ids[some[row]] != names[at[column]]
                    row, column = row[kept], column[kept]
                    value = scores[row, column] if digits is None else np.round(scores[row, column], digits)
                best = _merged([best, (some[row], at[column], value)], k)
            # Rows with k results need no lower ones.
            full = np.bincount(best[0], minlength=len(part)) >= k
            last = np.searchsorted(best[0], np.flatnonzero(full), "right") - 1
            least[full] = np.maximum(least[full], best[2][last])
        yield part, *best


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each row of several results; earlier places win ties."""
    row, place, value = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((place, -value, row))
    row, place, value = row[order], place[order], value[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], place[kept], value[kept]


def best_per_query(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query. Groups hold k rows per scored tile at most."""
    order = Window.partitionBy("query_id").orderBy(F.desc("search_score"), "neighbour_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def in_tiles(index: DataFrame, chosen: DataFrame, tiles: Tiles, score, schema: T.StructType) -> DataFrame:
    """What ``score(first cell, cells, vectors)(queries)`` yields for each tile of the index and some of its queries at a time.

    ``index`` has ``neighbour_id``, ``cell`` and more, ``chosen`` is a stored table with ``query_id``, ``probes`` and more.
    """
    spark = index.sparkSession
    asked = {r["tile"]: r["n"] for r in chosen.select(F.explode("probes.tile").alias("tile")).groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect()}
    # One row per cell, and one per tile that is needed.
    of = F.broadcast(spark.createDataFrame([(cell, tile) for cell, tile in enumerate(tiles.of.tolist())], "cell int, tile int"))
    cuts = F.broadcast(spark.createDataFrame([(tile, int(tiles.parts[tile]), -(-n // tiles.rows)) for tile, n in asked.items()], "tile int, parts int, query_parts int"))

    def part(column: str, parts: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(parts)).cast("int")

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    sent = chosen.select(*[c for c in chosen.columns if c != "probes"], F.explode("probes").alias("_probe")).select("*", "_probe.*").drop("_probe")
    left = sent.join(cuts, "tile").withColumn("query_part", part("query_id", "query_parts")).withColumn("part", every("parts")).drop("parts", "query_parts")
    right = index.join(of, "cell").join(cuts, "tile").withColumn("part", part("neighbour_id", "parts")).withColumn("query_part", every("query_parts")).drop("parts", "query_parts")
    first, cells = tiles.first, tiles.cells
    # One table of both, so that a task holds the vectors of a tile and some of its queries at a time: vectors come first.
    keys = ["tile", "query_part", "part"]
    asks, has = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    sides = [
        side.select(*keys, F.lit(name == "asks").alias("asks"), F.struct(*asks).alias("query") if name == "asks" else F.lit(None).cast(left.select(F.struct(*asks)).schema[0].dataType).alias("query"),
                    F.struct(*has).alias("row") if name == "has" else F.lit(None).cast(right.select(F.struct(*has)).schema[0].dataType).alias("row"))
        for name, side in (("has", right), ("asks", left))
    ]
    dealt = sides[0].unionByName(sides[1]).repartition(*keys).sortWithinPartitions(*keys, "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, answer = None, [], None
        for batch in batches:
            places = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*keys, "asks")], axis=1)
            for i, j in pairwise([0, *(np.flatnonzero((np.diff(places, axis=0) != 0).any(axis=1)) + 1).tolist(), len(places)]):
                if i == j:
                    continue
                *now, asking = places[i].tolist()
                if at != now:
                    at, held, answer = now, [], None
                some = batch.slice(i, j - i)
                if not asking:
                    # A copy, for a slice would keep its whole batch in memory.
                    held.append(pa.Table.from_struct_array(some.column("row").take(pa.array(np.arange(j - i)))))
                    continue
                if answer is None and held:
                    answer, held = score(int(first[at[0]]), int(cells[at[0]]), pa.concat_tables(held).sort_by("neighbour_id")), []
                if answer is not None:
                    yield from answer(pa.RecordBatch.from_struct_array(some.column("query")))

    return dealt.mapInArrow(run, schema)


def _scored(placed: DataFrame, chosen: DataFrame, lists: Lists, k: int, exclude_self: bool) -> DataFrame:
    """k best neighbours per query and tile, for the cells each query probes."""
    dims = lists.centroids.shape[1]
    schema = T.StructType([chosen.schema["query_id"], placed.schema["neighbour_id"], T.StructField("search_score", T.DoubleType())])

    def score(first: int, cells: int, vectors: pa.Table):
        keys = vectors.column("neighbour_id").combine_chunks()
        strips = strips_of(vectors.column("cell").to_numpy() - first, _matrix(vectors.column("vector"), dims))

        def answer(asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, row, place, value in best_in_tile(asked, keys, strips, dims, cells, k, exclude_self):
                columns = [part.column("query_id").take(pa.array(row)), keys.take(pa.array(place)), pa.array(value)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return answer

    return in_tiles(placed, chosen, lists.tiles, score, schema)


def knn_approximate(
    queries: DataFrame, index: DataFrame, key: str, vector: str, list_id: str,
    k: int = 5, probes: int = 3, exclude_self: bool = False,
) -> DataFrame:
    """``(query_id, neighbour_id, search_score, rank)`` from the ``probes`` closest lists of each query.

    Rows of the closest lists are all scored exactly; what lies in other lists is missed.
    """
    placed, lists = place_in_lists(index, key, vector, list_id)
    chosen = _choose_cells(queries, key, vector, lists, _nearest(lists, probes))
    return best_per_query(_scored(placed, chosen, lists, k, exclude_self), k)


def knn_exact(
    queries: DataFrame, index: DataFrame, key: str, vector: str, list_id: str, k: int = 5, exclude_self: bool = False
) -> DataFrame:
    """``(query_id, neighbour_id, search_score, rank)``: the true ``k`` best rows of each query."""
    placed, lists = place_in_lists(index, key, vector, list_id)
    near = _choose_cells(queries, key, vector, lists, _nearest(lists, 1))
    first = written(best_per_query(_scored(placed, near, lists, k, exclude_self), k).drop("rank"), "knn-first")
    kth = first.groupBy(F.col("query_id").alias(key)).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("search_score")).otherwise(float("-inf")).alias("kth")
    )
    bounded = queries.join(kth, key, "left").select(key, vector, F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))
    far = _choose_cells(bounded, key, vector, lists, _still_possible(lists), extra="kth")
    second = _scored(placed, far, lists, k, exclude_self)
    return best_per_query(first.unionByName(second), k)


def kmeans_lists(vectors: DataFrame, vector: str, n_lists: int, seed: int = 42) -> DataFrame:
    """``vectors`` with a ``list_id`` from k-means, for tables without a label to split by."""
    from pyspark.ml.clustering import KMeans

    prepared = vectors.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=n_lists, seed=seed, featuresCol="_features", predictionCol="list_id").fit(prepared)
    return model.transform(prepared).drop("_features")


def lsh_buckets(vectors: DataFrame, key: str, vector: str, bits: int = 6, tables: int = 8, seed: int = 42) -> DataFrame:
    """Rows ``(hash_table, bucket, key)``, stored: on which side of ``bits`` random planes a vector lies, per table."""
    spark = vectors.sparkSession
    schema = T.StructType([T.StructField("hash_table", T.IntegerType()), T.StructField("bucket", T.IntegerType()), vectors.schema[key]])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = lsh_signatures(_matrix(batch.column(vector), len(batch.column(vector)[0])), bits, tables, seed)
            table = np.repeat(np.arange(tables, dtype=np.int32), batch.num_rows)
            keys = batch.column(key).take(pa.array(np.tile(np.arange(batch.num_rows), tables)))
            yield pa.RecordBatch.from_arrays([pa.array(table), pa.array(found.T.ravel()), keys], names=schema.names)

    wanted = vectors.select(key, F.col(vector).cast("array<double>").alias(vector))
    path = new_dir(spark, "lsh-buckets")
    sorted_rows = wanted.mapInArrow(hashed, schema).repartitionByRange("hash_table", "bucket", key).sortWithinPartitions("hash_table", "bucket")
    sorted_rows.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def lsh_signatures(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Bucket of each vector (rows) in each table (columns)."""
    planes = np.random.default_rng(seed).normal(size=(vectors.shape[1], tables * bits))
    sides = (vectors @ planes > 0).reshape(-1, tables, bits)
    return (sides << np.arange(bits)).sum(axis=2).astype(np.int32)


def lsh_top_k(
    vectors: DataFrame, key: str, vector: str, query: list[float], k: int = 5, buckets: DataFrame | None = None,
    bits: int = 6, tables: int = 8, radius: int = 2, seed: int = 42,
) -> DataFrame:
    """Approximate top-k: exact scores of the rows whose bucket differs from the query's in ``radius`` planes at most.

    ``buckets`` is the stored table of ``lsh_buckets`` with the same parameters. Only its probed buckets are read;
    their number depends on the parameters alone.
    """
    buckets = lsh_buckets(vectors, key, vector, bits, tables, seed) if buckets is None else buckets
    own = lsh_signatures(np.array([query]), bits, tables, seed)[0]
    near = [m for m in range(1 << bits) if m.bit_count() <= radius]
    probed = F.lit(False)
    for table, bucket in enumerate(own.tolist()):
        probed |= (F.col("hash_table") == table) & F.col("bucket").isin([bucket ^ m for m in near])
    found = vectors.join(buckets.where(probed).select(key).distinct(), key, "left_semi")
    return vector_top_k(found.select(key, vector), key, vector, query, k)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Per query: how many of the true neighbours were found."""
    hit = found.select("query_id", "neighbour_id", F.lit(1).alias("hit"))
    return (
        truth.join(hit, ["query_id", "neighbour_id"], "left")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("expected"), F.count("hit").alias("found"))
    )
