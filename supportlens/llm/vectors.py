"""Near-duplicate embeddings by an inverted multi-index.

Two independent codebooks, one for each half of a vector, form a product grid; a vector lies in the cell of its
nearest centroid pair. From a vector, cells are visited in the order of a multi-sequence: by the sum of the two
halves' distances to the cell (squared distance to the boundary of the half's own region). That sum is never more
than the squared distance to a vector in the cell, which is 2 - 2 * cosine; the traversal stops above this value for
the threshold, so that no link is lost. All candidates are verified by their cosine in double precision.

Equal vectors are one class from the start. Cells are cut into chunks of bounded size, and neighbouring cells make up
tiles of bounded size; a larger cell is cut into parts. From each chunk, the vectors that visit a tile travel there
together and once, with a bit for each cell of the tile that they visit; of two cells only the lower one visits the
other. A task holds the chunks of a tile and compares what visits them: it emits how many links each vector has and a
spanning forest of the links.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.llm.components import components
from supportlens.llm.rows import ROW, identified
from supportlens.llm.simhash import forest
from supportlens.session import written

THRESHOLD, SEED = 0.95, 42
#: Room for rounding at the stop of the traversal; centroids that are closer than this aren't told apart by it.
SLACK = 1e-6
#: Vectors that the codebooks are fitted on, at most; everything else sees all vectors.
SAMPLE = 8192
#: Vectors per cell aimed at, centroids per half at most, rounds of k-means, vectors per chunk at most.
CELL, CENTROIDS, ROUNDS, CHUNK = 2048, 256, 10, 2048
#: Visitors compared with a chunk at a time.
BLOCK = 512
#: Groups of visitors that meet a tile in one place; more are dealt out to copies of the tile.
VISITORS = 64
#: Bytes of a chunk at most, of a tile at most, vectors and cells of a tile, tiles of a small table.
CHUNK_BYTES, TILE_BYTES, TILE_LEAST, TILE_CELLS, TILES = 1 << 20, 1 << 24, 2048, 256, 8
#: Visits that a task holds at a time.
VISITS = 1 << 18
#: Partitions that tiles are dealt to at most, if the session has fewer.
PARTITIONS = 4096


def usable(vector: Column) -> Column:
    """Whether a vector can be linked: not null, no null or non-finite component, not zero."""
    value = F.transform(vector, lambda x: x.cast("double"))
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(good & F.exists(value, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that very long and very short ones neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def kmeans(points: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), min(count, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = squares(points, centres).argmin(axis=1)
        for k in range(len(centres)):
            if (mine := near == k).any():
                centres[k] = points[mine].mean(axis=0)
    return centres


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", points, points)[:, None] - 2 * points @ centres.T + np.einsum("ij,ij->i", centres, centres)


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the two halves and the sum at which the traversal stops."""

    books: tuple[np.ndarray, np.ndarray]
    stop: float

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = vectors.shape[1] // 2
        return vectors[:, :cut], vectors[:, cut:]

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The cell of each vector; for each half, the squared distance to the region of every centroid."""
        cell, out = np.zeros(len(vectors), np.int64), []
        for half, book in zip(self.halves(vectors), self.books, strict=True):
            square = squares(half, book)
            own = square.argmin(axis=1)
            gap = np.array([np.sqrt(((book - centre) ** 2).sum(axis=1)) for centre in book])
            gap[gap < SLACK] = np.inf
            out.append((np.maximum(square - square.min(axis=1, keepdims=True), 0) / (2 * gap[own])) ** 2)
            cell = cell * len(book) + own
        return cell, out

    def visits(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Multi-sequence traversal: cells by increasing sum of the two halves' distances, up to the stop."""
        rows, columns = first.argsort(kind="stable"), second.argsort(kind="stable")
        heap, out = [(first[rows[0]] + second[columns[0]], 0, 0)], []
        while heap and heap[0][0] <= self.stop:
            _, i, j = heapq.heappop(heap)
            out.append(int(rows[i]) * len(second) + int(columns[j]))
            if j + 1 < len(columns):
                heapq.heappush(heap, (first[rows[i]] + second[columns[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(rows):
                heapq.heappush(heap, (first[rows[i + 1]] + second[columns[0]], i + 1, 0))
        return out


def fit(sample: np.ndarray, count: int, threshold: float = THRESHOLD, seed: int = SEED) -> MultiIndex:
    """Codebooks for ``count`` vectors, and the stop that no neighbour at the threshold lies beyond."""
    rng = np.random.default_rng(seed)
    wide = int(np.clip(2 ** round(np.log2(max(1.0, (count / CELL) ** 0.5))), 2, CENTROIDS))
    empty = MultiIndex((sample[:0], sample[:0]), 2 - 2 * threshold + SLACK)
    return MultiIndex(tuple(kmeans(half, wide, rng) for half in empty.halves(sample)), empty.stop)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _assigned(classes: DataFrame, index: MultiIndex, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(2), dim)
            cell = index.distances(units(vectors.astype(np.float64)))[0] if len(vectors) else np.zeros(0, np.int64)
            blobs = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(0), batch.column(1), blobs], ["cell", "id", "n", "vector"])

    return written(classes.select("id", "n", "vector").mapInArrow(run, "cell long, id long, n long, vector binary"), "vector-cells")


@dataclass(frozen=True)
class Tiles:
    """Neighbouring cells: the tile of each cell, and of each tile its first cell and the parts that it is cut into."""

    filled: np.ndarray
    of: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    @staticmethod
    def cut(sizes: np.ndarray, most: int) -> Tiles:
        """Tiles of ``most`` vectors at most, but for single larger cells."""
        rows = min(most, max(TILE_LEAST, -(-int(sizes.sum()) // TILES)))
        of, first, totals = [], [], []
        for cell, size in enumerate(sizes.tolist()):
            if not totals or totals[-1] + size > rows or cell - first[-1] == TILE_CELLS:
                first.append(cell)
                totals.append(0)
            totals[-1] += size
            of.append(len(totals) - 1)
        return Tiles(sizes > 0, np.array(of), np.array(first), -(-np.maximum(np.array(totals), 1) // rows))


def _tiles(assigned: DataFrame, index: MultiIndex, width: int) -> Tiles:
    """Tiles of the cells of a table whose vectors have ``width`` bytes."""
    sizes = np.zeros(len(index.books[0]) * len(index.books[1]), np.int64)
    # A row per cell, of which there are CENTROIDS squared at most.
    for cell, n in assigned.groupBy("cell").count().collect():
        sizes[cell] = n
    return Tiles.cut(sizes, max(1, TILE_BYTES // width))


PARCEL = "visitor boolean, chunk long, cell long, tile int, ids binary, ns binary, vectors binary, bits binary"


def _parcels(assigned: DataFrame, index: MultiIndex, tiles: Tiles, kind: str, width: int) -> DataFrame:
    """The chunks of all cells, and for each chunk and tile the vectors of it that visit its own or a higher cell there."""
    binary = ("ids", "ns", "vectors", "bits")
    schema = pa.schema([("visitor", pa.bool_()), ("chunk", pa.int64()), ("cell", pa.int64()), ("tile", pa.int32()), *[(c, pa.binary()) for c in binary]])
    most, many = max(1, min(CHUNK, CHUNK_BYTES // width)), VISITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, at = TaskContext.get().partitionId() << 32, [], None

        def row(*values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            ids, ns, blobs = zip(*held, strict=True)
            ids, ns, vectors = np.array(ids, np.int64), np.array(ns, np.int64), np.frombuffer(b"".join(blobs), kind).reshape(len(ids), -1)
            yield row(False, number, at, int(tiles.of[at]), ids.tobytes(), ns.tobytes(), vectors.tobytes(), None)

            def sent(visits: list[np.ndarray], end: int) -> Iterator[pa.RecordBatch]:
                guest, cell = np.repeat(np.arange(end - len(visits), end), [len(v) for v in visits]), np.concatenate(visits)
                by_tile = np.argsort(tiles.of[cell], kind="stable")
                for some in np.split(by_tile, np.flatnonzero(np.diff(tiles.of[cell[by_tile]])) + 1):
                    tile = int(tiles.of[cell[some[0]]])
                    mine, place = np.unique(guest[some], return_inverse=True)
                    inner = cell[some] - tiles.first[tile]
                    bits = np.zeros((len(mine), int(inner.max()) + 1), bool)
                    bits[place, inner] = True
                    yield row(True, number, at, tile, ids[mine].tobytes(), ns[mine].tobytes(), vectors[mine].tobytes(), np.packbits(bits, axis=1).tobytes())

            _, (first, second) = index.distances(units(vectors.astype(np.float64)))
            visits, total = [], 0
            for i, (a, b) in enumerate(zip(first, second, strict=True)):
                met = np.array(index.visits(a, b), np.int64)
                visits.append(met[(met >= at) & tiles.filled[met]])
                total += len(visits[-1])
                if total >= many or i + 1 == len(ids):
                    yield from sent(visits, i + 1)
                    visits, total = [], 0
            number, held = number + 1, []

        for batch in batches:
            for cell, *rest in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if held and (cell != at or len(held) == most):
                    yield from out()
                at = cell
                held.append(rest)
        if held:
            yield from out()

    dealt = assigned.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
    return written(dealt.mapInArrow(run, PARCEL), "vector-parcels", heavy=True)


def linked(vectors: np.ndarray, others: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of unit vectors whose product reaches the threshold.

    Products in single precision, with room for their largest possible error, choose the rows to be computed in double.
    """
    single, least = others.astype(np.float32).T, threshold - (vectors.shape[1] + 8) * 2.0**-23
    x, y = [], []
    for start in range(0, len(vectors), BLOCK):
        block = vectors[start : start + BLOCK]
        rows = np.flatnonzero((block.astype(np.float32) @ single).max(axis=1) >= least)
        if len(rows):
            row, column = np.nonzero(block[rows] @ others.T >= threshold)
            x.append(start + rows[row])
            y.append(column)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *x]), np.concatenate([none, *y])


def _linked(parcels: DataFrame, tiles: Tiles, kind: str, threshold: float) -> DataFrame:
    """(id, n, label): how many vectors a class is linked to outside itself, and a smaller class it is connected to."""
    # A row per tile.
    visitors = parcels.filter("visitor").groupBy("tile").count().collect()
    places = [(tile, int(tiles.parts[tile]), -(-n // VISITORS)) for tile, n in visitors]
    spark = parcels.sparkSession
    cuts = F.broadcast(spark.createDataFrame(places, "tile int, parts long, places long"))
    blobs = ["ids", "ns", "vectors", "bits"]
    met = parcels.join(cuts, "tile")
    hashed = F.xxhash64("chunk")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    own = met.filter("NOT visitor").select("tile", F.pmod(hashed, F.col("parts")).alias("part"), every("places").alias("place"), "visitor", "cell", *blobs)
    guests = met.filter("visitor").select("tile", every("parts").alias("part"), F.pmod(hashed, F.col("places")).alias("place"), "visitor", "cell", *blobs)
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(sum(p * q for _, p, q in places), PARTITIONS))
    unit = ["tile", "part", "place"]
    dealt = own.unionByName(guests).repartition(count, *unit).sortWithinPartitions(*unit, "visitor")
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("label", pa.int64())])
    first = tiles.first

    def unpacked(row):
        ids = np.frombuffer(row["ids"], np.int64)
        return ids, np.frombuffer(row["ns"], np.int64), units(np.frombuffer(row["vectors"], kind).reshape(len(ids), -1).astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, at = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in (*unit, "visitor", "cell", *blobs)}
                if at != (now := [row[c] for c in unit]):
                    host, at = [], now
                some = unpacked(row)
                if not row["visitor"]:
                    host.append((row["cell"], some))
                    continue
                bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8).reshape(len(some[0]), -1), axis=1)
                for cell, (others, n_others, there) in host:
                    inner = cell - first[row["tile"]]
                    mine = np.flatnonzero(bits[:, inner]) if inner < bits.shape[1] else []
                    if not len(mine):
                        continue
                    ids, ns, vectors = (c[mine] for c in some)
                    x, y = linked(vectors, there, threshold)
                    if row["cell"] == cell:
                        # Both are of one cell: of two vectors, the one with the lower number visits the other.
                        lower = ids[x] < others[y]
                        x, y = x[lower], y[lower]
                    if not len(x):
                        continue
                    names = np.concatenate((ids, others))
                    # Sums of whole numbers, exact in double precision.
                    degree = np.concatenate((np.bincount(x, n_others[y], len(ids)), np.bincount(y, ns[x], len(others)))).astype(np.int64)
                    label = forest(len(names), x, y + len(ids))
                    met = np.flatnonzero(degree)
                    yield pa.RecordBatch.from_arrays([pa.array(names[met]), pa.array(degree[met]), pa.array(names[label[met]])], schema=schema)

    return written(dealt.mapInArrow(run, "id long, n long, label long"), "vector-links", heavy=True)


def _sample(classes: DataFrame, count: int) -> np.ndarray:
    """About ``SAMPLE`` vectors, the same ones on every run: those with a small hash."""
    share = min(1.0, SAMPLE / count)
    place = F.pmod(F.xxhash64("vector"), F.lit(1 << 20))
    rows = classes.filter(place < int(share * (1 << 20)) + 1).select("vector", place.alias("place")).toArrow()
    vectors = _matrix(rows.column(0).combine_chunks(), len(rows.column(0)[0])).astype(np.float64)
    order = np.lexsort((*vectors.T[::-1], rows.column(1).to_numpy()))
    return units(vectors[order][:SAMPLE])


def near_duplicates(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
) -> DataFrame:
    """Links between vectors whose cosine is ``threshold`` or more, and their groups.

    Returns, per row of ``table``: its identity, key, ``n_links`` (rows it is directly linked to, without itself),
    ``component_id`` (smallest key reachable by links, null if it has none but null) and ``kept`` (the key is the
    component's; false for a null key in a group with another). Vectors that are null, empty, zero or hold a null or
    non-finite component are linked with nothing; vectors of different length aren't linked. Rows with equal
    vectors are linked; repeated rows are rows like any other. An empty table gives an empty result. Columns other
    than ``key`` and ``vector`` are neither read nor returned.
    """
    value = F.col(vector)
    rows = identified(table).select(*ROW, F.col(key).alias("key"), F.when(usable(value), value).alias("vector"))
    kind = "<f4" if rows.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
    if kind == "<f8":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    good = rows.filter("vector IS NOT NULL")
    classes = written(
        good.groupBy("vector").agg(F.count("*").alias("n"), F.min("key").alias("least"))
        .select(F.monotonically_increasing_id().alias("id"), "n", "least", "vector", F.size("vector").alias("dim")),
        "vector-classes",
    )
    found = None
    for dim, count in sorted(tuple(r) for r in classes.groupBy("dim").count().collect()):
        mine = classes.filter(F.col("dim") == dim)
        index = fit(_sample(mine, count), count, threshold)
        assigned, width = _assigned(mine, index, dim), dim * int(kind[-1])
        tiles = _tiles(assigned, index, width)
        some = _linked(_parcels(assigned, index, tiles, kind, width), tiles, kind, threshold)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = classes.select("id", "n", F.col("id").alias("label"))
    degree = found.groupBy("id").agg(F.sum("n").alias("more"))
    group = components(found.select(F.col("id").alias("a"), F.col("label").alias("b"))).withColumnRenamed("node", "id")
    placed = written(
        classes.join(degree, "id", "left").join(group, "id", "left").select(
            "vector", "least", F.coalesce("component", "id").alias("component"),
            (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"),
        ),
        "vector-placed",
    )
    least = written(placed.groupBy("component").agg(F.min("least").alias("component_id")), "vector-groups")
    result = placed.drop("least").join(least, "component").select("vector", "n_links", "component_id")
    linked = good.join(written(result, "vector-result"), "vector").select(*ROW, "key", "n_links", "component_id")
    alone = rows.filter("vector IS NULL").select(*ROW, "key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.unionByName(alone).select(
        *ROW, F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )
