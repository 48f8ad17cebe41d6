"""Session settings and the shared folder that derived tables are written to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Term lists of a search are pushed to the index files as IN, not as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_base: dict[str, str] = {}
_stored: dict[tuple[str, ...], str] = {}


def build_session(app: str = "supportlens", **extra: str) -> SparkSession:
    """A session with the settings the jobs expect; ``extra`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master, where driver and executors share one machine, may fall
    back to a temporary folder, which goes when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="supportlens-")
        atexit.register(shutil.rmtree, _local_base[app], ignore_errors=True)
    return _local_base[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A folder name under the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Where single rows are large: bytes of an Arrow batch and of a Parquet row group, about. Both go through memory whole.
HEAVY = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = HEAVY) -> Iterator[None]:
    """Jobs that run meanwhile pass rows to Python in batches of about ``size`` bytes."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


def write_heavy(df: DataFrame, path: str) -> None:
    """Write rows that are large, or are made of large ones, in small batches and row groups."""
    # Parquet would look at the size of a row group after 100 rows only.
    with small_batches(df.sparkSession):
        df.write.option("parquet.block.size", HEAVY).option("parquet.page.size.row.check.min", 1).parquet(path)


def written(df: DataFrame, name: str, heavy: bool = False) -> DataFrame:
    """Cut the lineage by writing ``df`` to the shared folder and reading it back. ``heavy`` says that its rows, or
    those that Python gets on the way, may have some 100 KB or more each: a task then holds few of them at a time."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    if heavy:
        write_heavy(df, path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, key: tuple[str, ...], build: Callable[[str], None]) -> str:
    """Path of a derived table, built once per application and input folder.

    The path is remembered only after ``build`` returned, so a failed build is
    never read.
    """
    full = (spark.sparkContext.applicationId, *key)
    if full not in _stored:
        path = new_dir(spark, key[-1])
        build(path)
        _stored[full] = path
    return _stored[full]


def state_of(df: DataFrame) -> str:
    """Changes when the files behind ``df`` do: their paths, sizes and times, summed up where they are read."""
    meta = df.metadataColumn("_metadata")
    files = df.select(meta["file_path"].alias("p"), meta["file_size"].alias("s"), meta["file_modification_time"].alias("t")).distinct()
    found = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("p", "s", "t").cast("decimal(38,0)")).alias("h")).first()
    return f"{found['n']}-{found['h']}"


FEW_FILES = 16


def spread(df: DataFrame) -> DataFrame:
    """Spread rows that come from a handful of files over all cores.

    For heavy per-row work only: a small file is often one row group, hence one task.
    A table of many files already fills the cluster and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < min(cores, FEW_FILES) else df
