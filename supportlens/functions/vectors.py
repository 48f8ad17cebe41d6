"""Vector expressions: hashed text vectors and similarity."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supportlens.functions.text import bind, log_tf, term_counts

DIMENSIONS = 256

# Tasks get these functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _scatter(places: pa.Array, weights: pa.Array) -> pa.Array:
    """Sum weights by place and scale each row to unit length."""
    n = len(places)
    lengths = pc.list_value_length(places).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.repeat(np.arange(n, dtype=np.int64) * DIMENSIONS, lengths)
    flat += places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    values = weights.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dense = np.bincount(flat, weights=values, minlength=n * DIMENSIONS).astype(np.float64).reshape(n, DIMENSIONS)
    length = np.linalg.norm(dense, axis=1, keepdims=True)
    dense /= np.where(length > 0, length, 1.0)
    offsets = np.arange(0, (n + 1) * DIMENSIONS, DIMENSIONS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(dense.ravel()))


def with_hashed_vector(df: DataFrame, text: str, out: str = "vector") -> DataFrame:
    """Replace a text column by its unit vector.

    Each term adds its log count at a hashed place, with a hashed sign. Words are
    matched, not meanings; any other ``array<double>`` column can stand in.
    """

    def digits(term: Column, first: int, count: int) -> Column:
        return F.conv(F.substring(F.md5(term), first, count), 16, 10).cast("int")

    def scattered(counts: Column) -> Column:
        places = F.transform(counts, lambda c: digits(c["term"], 1, 6) % DIMENSIONS)
        weights = F.transform(
            counts, lambda c: F.when(digits(c["term"], 7, 1) < 8, log_tf(c["tf"])).otherwise(-log_tf(c["tf"]))
        )
        return F.struct(places.alias("places"), weights.alias("weights"))

    others = [c for c in df.columns if c != text]
    parts = df.select(*others, bind(term_counts(F.col(text)), scattered).alias("_parts"))
    parts = parts.select(*others, F.col("_parts.places").alias("_places"), F.col("_parts.weights").alias("_weights"))
    return parts.select(*others, _scatter("_places", "_weights").alias(out))


def dot(left: Column, right: Column) -> Column:
    """Inner product of two vectors of equal length, in double precision."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
