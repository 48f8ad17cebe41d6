"""Derived tables on disk: snapshots, namespaces and the index manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens.session import new_dir


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """A full copy of a table in a folder of its own."""
    return overwrite(df, new_dir(df.sparkSession, f"snapshot-{name}"))


def save_table(df: DataFrame, database: str, name: str) -> DataFrame:
    """Replace a managed table, creating its database if need be."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def manifest_row(source: DataFrame, index_name: str, key: str, text: str, path: str = "") -> DataFrame:
    """One row that describes an index, where it lies and the table it was built from."""
    return source.agg(
        F.lit(index_name).alias("index_name"),
        F.lit(path).alias("path"),
        F.lit(key).alias("key_column"),
        F.lit(text).alias("text_column"),
        F.count(key).alias("documents"),
        F.max(key).alias("last_key"),
    ).withColumn("created_at", F.current_timestamp())


def latest(manifest: DataFrame, per: str, by: str) -> DataFrame:
    """The newest row of each group. The running maximum keeps one row per group and task."""
    others = [c for c in manifest.columns if c not in (per, by)]
    newest = manifest.groupBy(per).agg(F.max(F.struct(by, *others)).alias("_row"))
    return newest.select(per, "_row.*")
