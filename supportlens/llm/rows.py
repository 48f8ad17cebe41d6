"""Physical row identity, so that decisions about rows can be joined back to whole rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supportlens.session import written

#: Name prefix of internal columns; input columns are renamed away from it by selecting only what is needed.
FILE, AT = "_llm_file", "_llm_at"
ROW = (FILE, AT)


def identified(df: DataFrame) -> DataFrame:
    """``df`` with two columns that identify each stored row: its file and its index in the file.

    Both are properties of the stored data, so they stay the same when a lost task is run again or when
    the files are split otherwise. A DataFrame that doesn't come straight from Parquet files is written
    to the shared folder first. Rows that are equal in every column get different identities.
    """
    try:
        return _with_metadata(df)
    except AnalysisException:
        return _with_metadata(written(df, "rows"))


def _with_metadata(df: DataFrame) -> DataFrame:
    meta = df.metadataColumn("_metadata")
    return df.select("*", F.xxhash64(meta["file_path"]).alias(FILE), meta["row_index"].alias(AT))


def without_rows(docs: DataFrame, drop: DataFrame) -> DataFrame:
    """The rows of an ``identified`` table whose identity isn't in ``drop``, with the input's own columns."""
    return docs.join(drop.select(*ROW), list(ROW), "left_anti").drop(*ROW)


def numbered(df: DataFrame, group: Column, order: list[str], name: str) -> DataFrame:
    """``df`` with ``i``, the place of a row in its group from 0 on, and ``n``, the rows of the group.

    Rows are sorted by (group, order) over all partitions and written; a file then holds a run of each of its
    groups, and the places at which the runs begin follow from their sizes. So no task holds a whole group. ``order``
    should tell all rows apart. Null groups and values come first.
    """
    keyed = df.withColumn("_llm_group", group)
    stored = written(keyed.orderBy("_llm_group", *order), name)
    meta = stored.metadataColumn("_metadata")
    placed = stored.select("*", meta["file_path"].alias("_llm_path"), meta["row_index"].alias("_llm_index"))
    runs = placed.groupBy("_llm_group", "_llm_path").agg(
        F.min("_llm_index").alias("begin"), F.count("*").alias("size"), F.min(F.struct(*order)).alias("first")
    )
    whole = Window.partitionBy("_llm_group")
    before = whole.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col("_llm_group").alias("_llm_of"), F.col("_llm_path").alias("_llm_in"),
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("begin")).alias("_llm_shift"), F.sum("size").over(whole).alias("n"),
    )
    met = placed.join(starts, F.col("_llm_group").eqNullSafe(F.col("_llm_of")) & (F.col("_llm_path") == F.col("_llm_in")))
    return met.withColumn("i", F.col("_llm_index") + F.col("_llm_shift")).select(*df.columns, "i", "n")
