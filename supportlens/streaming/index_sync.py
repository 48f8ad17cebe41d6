"""Incremental text index: versions are appended, the newest per key counts.

Parquet has no merge, so each increment goes to its own folder, numbered by the
streaming batch. A replayed batch overwrites the folder it wrote before. Every row keeps
its sequence, so an older state that arrives later doesn't replace a newer one. Each increment
has its postings beside it, so that it can be searched at once: postings of versions
that were replaced or deleted are left out when they are read, and gone after
``compact`` or ``publish``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructType, TimestampType

from supportlens.operators.change_feed import AFTER, DELETE, INSERT
from supportlens.operators.text_index import TextIndex, finish_index, text_vectors, write_postings
from supportlens.session import spread, written


def write_version(
    rows: DataFrame, key: str, text: str, path: str, version: int, deleted: str | None = None, sequence: str | None = None,
    few_tasks: bool = True,
) -> None:
    """Index the rows as one version.

    ``deleted`` names a boolean column of tombstones. ``sequence`` names the column, a
    number or a time, whose largest value is the newest state of a key, in this and in
    all other increments. Rows without one are older than those with one; of equally
    new rows the later increment counts, and in one increment the largest row. Only rows
    whose key repeats are moved to each other; all are spread where ``few_tasks`` hold them.
    """
    order = _as_long(rows, sequence) if sequence else F.lit(None).cast("long")
    others = [c for c in rows.columns if c not in (key, sequence, "sequence")]
    rows = rows.select(key, *others, order.alias("sequence"))
    rows = _newest(rows, key, others)
    marked = rows.withColumnRenamed(deleted, "deleted") if deleted else rows.withColumn("deleted", F.lit(False))
    target = f"{path}/version={version}"
    text_vectors(spread(marked) if few_tasks else marked, text).write.mode("overwrite").parquet(target)
    write_postings(rows.sparkSession.read.parquet(target), key, postings_of_versions(path), f"version={version}")


def _newest(rows: DataFrame, key: str, others: list[str]) -> DataFrame:
    """One row of each key, the largest by sequence and other columns."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = written(counted.select(F.col(key).alias("_repeated")), "repeated-keys")
    if repeated.isEmpty():
        return rows.select(key, *others, "sequence")
    # Null is a key as well.
    same = F.col(key).eqNullSafe(F.col("_repeated"))
    newest = rows.join(repeated, same, "left_semi").groupBy(key).agg(F.max(F.struct("sequence", *others)).alias("_newest"))
    return rows.join(repeated, same, "left_anti").select(key, *others, "sequence").union(
        newest.select(key, *[f"_newest.{c}" for c in (*others, "sequence")])
    )


def _as_long(rows: DataFrame, column: str) -> Column:
    if isinstance(rows.schema[column].dataType, TimestampType):
        return F.unix_micros(column)
    return F.unix_date(column).cast("long") if isinstance(rows.schema[column].dataType, DateType) else F.col(column).cast("long")


def postings_of_versions(path: str) -> str:
    return f"{path.rstrip('/')}.postings"


def live(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Key and newest version of every document that isn't deleted."""
    newest = spark.read.parquet(path).groupBy(key).agg(F.max(F.struct("sequence", "version", "deleted")).alias("newest"))
    return newest.where(~F.col("newest.deleted")).select(key, "newest.version")


@dataclass(frozen=True)
class LiveIndex:
    """The versions under a path as one index for ``text_index.search``."""

    spark: SparkSession
    path: str
    key: str

    @property
    def vectors(self) -> DataFrame:
        return current(self.spark, self.path, self.key)

    @property
    def postings(self) -> DataFrame:
        every = self.spark.read.parquet(postings_of_versions(self.path))
        return every.join(live(self.spark, self.path, self.key), [self.key, "version"], "left_semi").drop("version")

    def documents(self) -> int:
        return live(self.spark, self.path, self.key).count()

    def frequencies(self, terms: list[str]) -> dict[str, int]:
        counted = self.postings.where(F.col("term").isin(terms)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        return {r["term"]: r["n"] for r in counted.collect()}


def current(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Newest version of every key, without the deleted ones.

    Only key, sequence and version are aggregated; the wide rows are moved once, by the join.
    """
    return spark.read.parquet(path).join(live(spark, path, key), [key, "version"]).drop("deleted", "sequence")


def compact(spark: SparkSession, path: str, key: str, target: str) -> None:
    """Write the current state as the only version of a new folder."""
    newest = spark.read.parquet(path).join(live(spark, path, key), [key, "version"])
    rows = newest.drop("version")
    rows.write.mode("overwrite").parquet(f"{target}/version=0")
    write_postings(spark.read.parquet(f"{target}/version=0"), key, postings_of_versions(target), "version=0")


def publish(spark: SparkSession, path: str, key: str, target: str) -> TextIndex:
    """Make the current state searchable: an index folder for ``text_index.search``."""
    index = TextIndex(spark, target, key)
    current(spark, path, key).drop("version").write.parquet(f"{target}/vectors")
    return finish_index(index, "published", "text")


def write_changes(feed: DataFrame, key: str, text: str, path: str, version: int) -> None:
    """Index a change feed: new states become rows, deletions become tombstones."""
    changes = feed.where(F.col("_change_type").isin(INSERT, AFTER, DELETE))
    marked = changes.withColumn("_gone", F.col("_change_type") == DELETE).drop("_change_type")
    write_version(marked, key, text, path, version, deleted="_gone")


def first_version(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Version of the first batch of a checkpoint, kept beside it: the next free one when the checkpoint is new."""
    kept = f"{checkpoint.rstrip('/')}.first-version"
    try:
        return spark.read.parquet(kept).first()["version"]
    except AnalysisException:
        pass
    try:
        version = (spark.read.parquet(path).agg(F.max("version")).first()[0] or 0) + 1
    except AnalysisException:
        version = 0
    spark.createDataFrame([(version,)], "version long").write.parquet(kept)
    return version


def start_sync(
    spark: SparkSession, folder: str, pattern: str, schema: StructType, key: str, text: str, path: str, checkpoint: str,
    continuous: str | None = None, max_files: int | None = None, sequence: str | None = None,
) -> StreamingQuery:
    """Index the files of a folder that match ``pattern``, as they arrive.

    By default everything new is processed and the query stops; ``continuous`` gives
    an interval such as ``"30 seconds"`` to keep it running.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(folder).select(key, text, *([sequence] if sequence else []))

    first = first_version(spark, path, checkpoint)

    def index_batch(batch: DataFrame, batch_id: int) -> None:
        few = batch.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
        write_version(batch, key, text, path, first + batch_id, sequence=sequence, few_tasks=few)

    writer = rows.writeStream.foreachBatch(index_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def sync_now(
    spark: SparkSession, folder: str, pattern: str, schema: StructType, key: str, text: str, path: str, checkpoint: str, **options
) -> None:
    """Process everything new and wait for it."""
    start_sync(spark, folder, pattern, schema, key, text, path, checkpoint, **options).awaitTermination()
