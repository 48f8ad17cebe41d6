"""Mergeable distinct counts: a sketch per day and group is stored once, any span of days is a union of sketches.

A sketch has a bounded size whatever it has seen, so a group with a third of all rows costs as much as any other, and
rows are reduced to sketches before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a sketch as a power of two, and three standard errors of its estimate.
LG_BUCKETS = 12
BOUND = 3 * 1.04 / (1 << LG_BUCKETS) ** 0.5


def daily_sketches(rows: DataFrame, day: Column, groups: list[str], value: str) -> DataFrame:
    """A sketch of the different values per day and group. Null values don't count."""
    return rows.groupBy(day.cast("date").alias("day"), *groups).agg(F.hll_sketch_agg(value, LG_BUCKETS).alias("sketch"))


def distinct_estimates(sketches: DataFrame, groups: list[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """Estimated number of different values per group over the days from ``first`` to ``last``, both included.

    Rows without a day count only where no bound is given. No sketch read means no row.
    """
    if first is not None:
        sketches = sketches.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        sketches = sketches.where(F.col("day") <= F.lit(last).cast("date"))
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def within_bound(estimate: Column, exact: Column) -> Column:
    """Whether an estimate is as close as sketches promise, and at least to the nearest whole number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * BOUND)
