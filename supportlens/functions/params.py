"""List parameters: a JSON array in text form, a Python list, or a DataFrame of keys."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Longer lists go through a semi-join instead of a literal IN list.
MAX_INLINE = 500

ListParam = str | Iterable | DataFrame | None


# How a JSON array given as text is read, in Python calls and in SQL functions alike.
LIST_TYPE = "ARRAY<STRING>"
INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def parse_list(spark: SparkSession, param: str | Iterable | None) -> list[str]:
    """Elements of a list parameter as text; anything but a list has no elements.

    A text is read by ``from_json``, as the SQL functions read it.
    """
    if isinstance(param, str):
        param = spark.range(1).select(F.from_json(F.lit(param), LIST_TYPE).alias("found")).first()["found"]
    if param is None:
        return []
    return [v if isinstance(v, str) else json.dumps(v, separators=(",", ":")) for v in param if v is not None]


def in_type(values: list[str], dtype: T.DataType) -> list:
    """Values that are the canonical text of a value of the key column's type, in that type."""
    if not isinstance(dtype, T.IntegralType):
        return values
    most = 1 << INTEGER_BITS[type(dtype)] - 1
    numbers = [int(v) for v in values if v.isascii() and v.removeprefix("-").isdecimal() and str(int(v)) == v]
    return [n for n in numbers if -most <= n < most]


def keep_listed(df: DataFrame, column: str, param: ListParam) -> DataFrame:
    """Rows whose ``column`` is in the list.

    A short list becomes ``IN``, which the parquet reader prunes with; a
    DataFrame (its first column) or a long list becomes a left-semi join.
    """
    if isinstance(param, DataFrame):
        keys = param.select(param[param.columns[0]].alias(column)).distinct()
        return df.join(keys, column, "left_semi")
    dtype = df.schema[column].dataType
    values = in_type(parse_list(df.sparkSession, param), dtype)
    if len(values) > MAX_INLINE:
        schema = T.StructType([T.StructField(column, dtype)])
        keys = df.sparkSession.createDataFrame([(v,) for v in values], schema).distinct()
        return df.join(keys, column, "left_semi")
    return df.where(F.col(column).isin(values))


def unknown_values(params: DataFrame, valid: DataFrame) -> DataFrame:
    """Requested ``(parameter, value)`` rows that the list of valid values does not hold."""
    return params.join(valid, ["parameter", "value"], "left_anti").distinct()


def listed(json_param: str, column: str) -> str:
    """SQL predicate: ``column`` is an element of a JSON array given as text."""
    return f"array_contains(from_json({json_param}, '{LIST_TYPE}'), CAST({column} AS STRING))"
