"""Change feed between two snapshots whose unchanged parts never meet.

Rows are summed up per bucket of their key: a signed sum of two independent row hashes and a signed count, which don't
depend on the order of rows. A bucket whose sums cancel out holds the same rows in both snapshots. The buckets that
differ are divided once more by other bits of the key's hash, and only rows of parts that still differ are compared
as whole rows. Sums are formed before the shuffle, so what is shuffled grows with the changes, not with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.operators.change_feed import change_feed
from supportlens.session import written

#: Buckets of the first level, and parts of each of them on the second.
BUCKETS = 1 << 16

# Seeds of the two row hashes.
SEEDS = (11, 29)


def row_hash(columns: list[str], seed: int) -> Column:
    """64 bits of a row. Hashes pass over nulls, so each column is preceded by whether it is one."""
    values = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *values)


def _bucket(key: str, level: int, buckets: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(F.lit(level), F.col(f"`{key}`")), 8), F.lit(buckets)).cast("int")


def _signed(df: DataFrame, key: str, columns: list[str], sign: int, buckets: int) -> DataFrame:
    hashes = [(F.lit(sign) * row_hash(columns, seed).cast("decimal(38,0)")).alias(f"h{seed}") for seed in SEEDS]
    return df.select(_bucket(key, 0, buckets).alias("bucket"), _bucket(key, 1, buckets).alias("part"), F.lit(sign).alias("n"), *hashes)


def _differing(rows: DataFrame, *by: str) -> DataFrame:
    sums = rows.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(f"h{s}").alias(f"h{s}") for s in SEEDS])
    return sums.where((F.col("n") != 0) | (F.col(f"h{SEEDS[0]}") != 0) | (F.col(f"h{SEEDS[1]}") != 0)).select(*by)


def differing_rows(old: DataFrame, new: DataFrame, key: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots that lie in parts which differ: all changed ones, and few others."""
    columns = new.columns
    sides = [(old.select(*columns), 1), (new.select(*columns), -1)]
    signed = [_signed(df, key, columns, sign, buckets) for df, sign in sides]
    # At most ``buckets`` rows of four bytes.
    coarse = F.broadcast(written(_differing(signed[0].unionByName(signed[1]), "bucket"), "feed-buckets"))
    within = [s.join(coarse, "bucket", "left_semi") for s in signed]
    # At most as many parts as there are changed keys; Spark decides how they meet the rows.
    fine = written(_differing(within[0].unionByName(within[1]), "bucket", "part"), "feed-parts")

    def kept(df: DataFrame) -> DataFrame:
        placed = df.select("*", _bucket(key, 0, buckets).alias("_bucket"), _bucket(key, 1, buckets).alias("_part"))
        some = placed.join(coarse.withColumnRenamed("bucket", "_bucket"), "_bucket", "left_semi")
        parts = fine.select(F.col("bucket").alias("_bucket"), F.col("part").alias("_part"))
        return some.join(parts, ["_bucket", "_part"], "left_semi").select(*columns)

    return kept(sides[0][0]), kept(sides[1][0])


def change_feed_by_digest(old: DataFrame, new: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows that ``change_feed`` gives. Both snapshots should be stored tables: each is read twice or three times.

    The key must not be null and must be unique in a snapshot. A change is missed only if both 64-bit sums of its part,
    and the number of its rows, come out equal.
    """
    before, after = differing_rows(old, new, key, buckets)
    return change_feed(before, after, key)
